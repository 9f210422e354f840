import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from conftest_llm import EDGES, corpus, prose, table
from profilespark.llm import quality, toxicity
from profilespark.llm.sampling import labelled_sample
from profilespark.llm.text import encoded


def statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    threes = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if threes[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated)]


def test_base_statistics_equal_brute_force():
    draw = random.Random(8)
    texts = [t for _, t in corpus() + EDGES]
    texts += ["".join(draw.choice(["a ", "b ", "a b c ", "\n", "#é ", "$$", "\x0b"]) for _ in range(draw.randint(0, 30))) for _ in range(300)]
    got = quality.statistics(encoded(texts))
    assert got.to_numpy().tolist() == [statistics(t) for t in texts]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, prose(i, 120)) for i in range(200)] + [(200 + i, prose(i + 300, 80).upper().replace(" ", "!! %%% ")) for i in range(30)]
    rows += [(300, prose(7, 200)), (301, prose(8, 30)), (302, "again and again " * 40), (303, None), (304, "")]
    docs = table(spark, rows)
    labels = spark.createDataFrame([(i, 1) for i in range(100)] + [(200 + i, 0) for i in range(10)], "doc_id bigint, quality int")
    return {r.doc_id: r for r in quality.judge(docs, quality.fit(docs, labels)).collect()}


def test_clean_documents_are_kept_and_junk_is_not(judged):
    assert all(judged[i].kept for i in [*range(200), 300])
    assert not any(judged[200 + i].kept for i in range(30))
    assert [judged[i].base_failed for i in (300, 301, 302, 303, 304)] == [False, True, True, True, True]


def test_the_ratio_equals_brute_force(spark):
    docs = [(i, prose(i, 20)) for i in range(6)]
    raw, target = quality.gram_counts(table(spark, docs), spark.createDataFrame([(0,), (3,)], "doc_id bigint"))
    assert raw.sum() == 6 * (20 + 19) and target.sum() == 2 * (20 + 19) and (target <= raw).all()
    ratio = quality.log_ratio(raw, target)
    words = quality.Words(encoded([docs[0][1]]))
    buckets = quality._grams(words)[0]
    assert quality._scores(encoded([docs[0][1]]), ratio)[0] == pytest.approx(ratio[buckets].mean(), abs=1e-8)


def test_every_trusted_document_takes_part(spark):
    """Those beyond the first 20,000 too, in whichever order; the threshold is the exact lower quantile."""
    ids = spark.range(20_400).withColumnRenamed("id", "doc_id")
    last = {r.doc_id for r in ids.orderBy(quality.F.xxhash64("doc_id")).collect()[20_000:]}
    docs = spark.createDataFrame([(i, "zebra" if i in last else f"plain {i % 50}") for i in range(20_400)], "doc_id bigint, text string")
    model = quality.fit(docs, ids.withColumn("quality", quality.F.lit(1)))
    assert model.ratio[quality._grams(quality.Words(encoded(["zebra"])))[0][0]] > -2
    for n in (0, 1, 499, 501, 1001):
        scores = np.round(np.random.default_rng(n).normal(size=n), 3)
        found = quality.lower_quantile(spark.createDataFrame([(float(x),) for x in scores], "score double"), 0.002)
        assert found == (np.quantile(scores, 0.002, method="lower") if n else -np.inf)


def test_edge_rows(spark, documents, edges, empty, labels):
    model = quality.fit(edges, labels)
    assert quality.judge(edges, model).count() == len(EDGES) and quality.judge(empty, model).count() == 0
    assert quality.fit(empty, labels.limit(0)).threshold == -np.inf
    with pytest.raises(ValueError, match="both kinds"):  # none of the texts that are labelled once is toxic
        toxicity.fit(documents, labels)
    assert toxicity.fit(documents, labels.limit(0)) is None
    scored = toxicity.score(edges, None).collect()
    assert len(scored) == len(EDGES) and {r.score for r in scored} == {0.0}
    assert toxicity.score(empty, toxicity.fit(empty, labels.limit(0))).count() == 0


def test_a_sample_is_bounded_and_the_same_each_time(labels):
    first = [r.doc_id for r in labelled_sample(labels, 10).collect()]
    assert len(first) == 10 and None not in first and 3 not in first
    assert first == [r.doc_id for r in labelled_sample(labels.repartition(7), 10).collect()]


def toxic_text(seed, n=120):
    draw = random.Random(seed)
    words = prose(seed, n).split()
    for _ in range(max(3, n // 25)):
        words.insert(draw.randrange(len(words)), draw.choice(["grobblefink", "snarkwaddle", "muckspout", "drivelhound"]))
    return " ".join(words)


def test_windows_are_the_whole_text():
    for text in (b"", b"x", b"a b " * 100, b"y" * 1000, prose(3, 500).encode()):
        cut = toxicity.windows(text)
        assert b"".join(cut) == text and all(0 < len(w) <= toxicity.WINDOW for w in cut)


def test_held_out_accuracy(spark):
    rows = [(i, toxic_text(i) if i % 4 == 0 else prose(i, 60 + i % 100)) for i in range(400)]
    docs = table(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model).collect()
    held = [(r.predicted, int(r.doc_id % 4 == 0)) for r in scored if r.held_out]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in scored)
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    left = {r.doc_id for r in toxicity.without_toxic(docs, model).collect()}
    assert left == {r.doc_id for r in scored if not r.predicted}


def test_labels_of_the_held_out_fold_have_no_influence(spark):
    rows = [(i, toxic_text(i) if i % 4 == 0 else prose(i, 80)) for i in range(120)]
    docs = table(spark, rows)
    true = [(i, int(i % 4 == 0)) for i in range(120)]
    flipped = [(i, 1 - y if toxicity.crc_fold(i, 3) == 1 else y) for i, y in true]
    models = [toxicity.fit(docs, spark.createDataFrame(x, "doc_id bigint, toxic int")) for x in (true, flipped)]
    assert models[0] == models[1]


def test_long_texts_take_no_other_rows_from_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 200_000)
    rows = [(i, toxic_text(i) if i % 4 == 0 else prose(i, 80)) for i in range(400)]
    label = {i: int(i % 4 == 0) for i in range(400)}
    # each is longer than the bound of all texts together; among them the first ids in hash order
    first = sorted((i for i in label if toxicity.crc_fold(i, 3) != 1), key=lambda i: zlib.crc32(str(i).encode()))[:5]
    docs = table(spark, [(i, prose(i, 60_000) if i in first else t) for i, t in rows])
    labels = spark.createDataFrame(list(label.items()), "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    assert model is not None
    scored = toxicity.score(docs, model).filter("held_out").collect()
    assert sum(r.predicted == label[r.doc_id] for r in scored) >= 0.95 * len(scored)


def test_size_bounds_and_spread_pieces():
    assert toxicity._longest(np.array([10, 20, 30]), 60) == 30 and toxicity._longest(np.array([10, 500, 30]), 100) == 60
    assert toxicity._longest(np.array([500, 500]), 100) == 50
    text = prose(1, 5000).encode()
    cut = toxicity.spread_pieces(text, 4000)
    assert 3000 < len(cut) <= 4000 and cut[:300] == text[:300] and cut[-50:] == text[-50:]
    assert toxicity.spread_pieces(text, len(text)) == text


def test_one_row_for_each_id_and_a_failure_that_is_seen(spark):
    rows = [(i, toxic_text(i) if i % 4 == 0 else prose(i, 80)) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)], "doc_id bigint, toxic int")
    again = [(1, rows[1][1])] * 300
    assert toxicity.fit(table(spark, rows + again), labels) == toxicity.fit(table(spark, rows), labels)
    few = [i for i in range(120) if toxicity.crc_fold(i, 3) != 1]
    toxic, ordinary = next(i for i in few if i % 4 == 0), [i for i in few if i % 4][:20]
    with pytest.raises(ValueError, match="too few"):
        toxicity.fit(table(spark, rows), labels.filter(labels.doc_id.isin([toxic, *ordinary])))


def plain_score(model, text):
    """The score worked out window by window, with compressors made here."""
    parameters = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_LAZY2, min_match=4, search_log=4, target_length=32, window_log=17, hash_log=15, chain_log=16,
        write_content_size=False, write_checksum=False, write_dict_id=False)

    def compressed(content, window):
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters).compress(window))

    data, cut, start = (text or "").lower().encode(), [], 0
    while len(data) - start > toxicity.WINDOW:
        at = data.rfind(b" ", start + 1, start + toxicity.WINDOW + 1)
        at = at if at > start else start + toxicity.WINDOW
        cut.append(data[start:at])
        start = at
    cut += [data[start:]] if start < len(data) else []
    saved = [compressed(model.ordinary, w) - compressed(model.toxic + model.ordinary, w) for w in cut]
    n = max(1, len(saved))
    above = [sum(max(0, s - least) for s in saved) for least in range(3)]
    x = [above[0] / n, above[1] / n, above[2] / n, sum(s > 2 for s in saved) / n, sum(s > 3 for s in saved) / n, above[1] / (n + 10), above[1] / (n + 30)]
    total = model.bias + sum(w * (v - m) / s for w, v, m, s in zip(model.weights, x, model.mean, model.scale))
    return 1 / (1 + np.exp(-total))


def test_scores_equal_a_serial_scorer(spark):
    rows = [(i, toxic_text(i) if i % 4 == 0 else prose(i, 20 + i % 60)) for i in range(120)] + [(500, None), (501, ""), (502, "Ünï " * 40), (503, "x" * 300)]
    docs = table(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)], "doc_id bigint, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert got == {i: pytest.approx(plain_score(model, t), abs=1e-8) for i, t in rows}
