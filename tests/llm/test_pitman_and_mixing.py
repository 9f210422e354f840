import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest_llm import EDGES, corpus, table
from profilespark.llm import mixing, pitman


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def training(rows):
    return [(i, t) for i, t in rows if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2]


def base(rows):
    counts = Counter(w for _, t in training(rows) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return n, sorted(((i, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)),
                       round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows), key=str)


@pytest.fixture(scope="module")
def fitted(spark, documents):
    model = pitman.fit(documents)
    return model, pitman.score(documents, model).collect()


def test_counts_and_base_scores_equal_brute_force(fitted):
    n, want = base(corpus())
    _, rows = fitted
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows), key=str) == want
    assert {r.train_tokens for r in rows} == {n}


def test_words_that_only_a_join_knows(spark, documents, fitted, monkeypatch):
    monkeypatch.setattr(pitman, "COMMON_SHARE", 0.01)
    monkeypatch.setattr(pitman, "CLASS_SHARE", 0.02)
    model = pitman.fit(documents)
    rows = pitman.score(documents, model).collect()
    assert model.words.count() > len(model.common) and len(model.vocabulary.classes) < len(fitted[0].vocabulary.classes)
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows), key=str) == base(corpus())[1]


def test_probabilities_sum_to_one(spark, documents, monkeypatch):
    monkeypatch.setattr(pitman, "CLASS_SHARE", 0.02)
    model = pitman.fit(documents)
    assert np.allclose((10.0 ** model.pair.astype(float)).sum(axis=1), 1, atol=1e-5)
    words = model.words.toPandas()
    unseen = 10**model.unseen_log * (model.vocabulary.words + 1 - len(words))
    assert (10 ** words["log_p"]).sum() + unseen == pytest.approx(1, abs=0.01)


def pairs_of(rows):
    return Counter((b, w) for _, t in training(rows) for b, w in zip([None, *tokens(t)[:-1]], tokens(t)))


@pytest.mark.parametrize("class_share, common_share", [(2.0**-11, 2.0**-22), (0.02, 0.01)])
def test_every_pair_of_words_is_a_context_and_a_dish(spark, documents, monkeypatch, class_share, common_share):
    monkeypatch.setattr(pitman, "CLASS_SHARE", class_share)
    monkeypatch.setattr(pitman, "COMMON_SHARE", common_share)
    model = pitman.fit(documents)
    want, after = pairs_of(corpus()), defaultdict(Counter)
    for (b, w), n in want.items():
        after[b][w] = n
    assert sorted((r.customers) for r in model.contexts.collect()) == sorted(sum(c.values()) for c in after.values())
    size = model.vocabulary.other
    hot = np.isfinite(model.pair[:size, :size]).all() and size
    assert hot and model.pairs.count() >= len(want) - size * size
    assert model.shared.agg({"p": "sum"}).first()[0] + model.unseen == pytest.approx(1, abs=1e-6)


@pytest.mark.parametrize("class_share", [2.0**-11, 0.2])
def test_the_order_of_rare_words_counts(spark, monkeypatch, class_share):
    # a1 is always before b1, a2 before b2, ...; each word is far too rare to be a class at 0.2
    monkeypatch.setattr(pitman, "CLASS_SHARE", class_share)
    rows = [(i, " ".join(f"a{(i * 7 + k) % 40} b{(i * 7 + k) % 40}" for k in range(20))) for i in range(200)]
    probe = next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 7 == 2)
    swapped = next(i for i in range(probe + 1, 2000) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows += [(probe, "a1 b1 a2 b2 a3 b3"), (swapped, "a1 b2 a2 b3 a3 b1")]
    docs = table(spark, rows)
    model = pitman.fit(docs)
    found = {r.doc_id: r.score for r in pitman.score(docs, model).collect()}
    assert found[probe] > found[swapped] + 3
    again = {r.doc_id: r.score for r in pitman.score(docs, model, fitted=False).collect()}
    assert all(again[i] == pytest.approx(found[i]) for i in found)
    other = table(spark, [(1, "a1 b2 never met"), (2, "b1")])
    assert pitman.score(other, model, fitted=False).count() == 2


def test_held_out_scores_beat_the_base(fitted):
    held = [r for r in fitted[1] if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for r in held)


def test_seating_counts():
    random = np.random.default_rng(1)
    customers = np.array([0, 1, 2, 50, 100_000])
    t = pitman.seat(customers, np.full(5, 0.2), 0, 0.5, random)
    assert t[0] == 0 and t[1] == 1 and (t <= customers).all() and (t[1:] >= 1).all()
    # one restaurant, one dish that its parent always gives: the known mean number of tables of a Pitman-Yor process
    d, n = 0.5, 200
    mean = np.mean([pitman.seat(np.array([n]), np.array([1.0]), 0, d, random)[0] for _ in range(400)])
    want = math.exp(math.lgamma(1 + d + n) + math.lgamma(2) - math.lgamma(1 + n) - math.lgamma(1 + d) - math.log(d)) * 1.0 - 1 / d
    assert mean == pytest.approx(want, rel=0.15)


def test_edge_rows(spark, edges, empty):
    n, want = base(EDGES)
    rows = pitman.score(edges, pitman.fit(edges)).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows), key=str) == want
    assert pitman.score(empty, pitman.fit(empty)).count() == 0
    assert mixing.mixed(empty).count() == 0 and mixing.repeated_rows(empty).count() == 0


def test_bisected_exponents():
    shares = np.array([0.7, 0.2, 0.1, 0.0])
    a = mixing.exponent_for_entropy(shares, 1.0)
    assert mixing.entropy(mixing.tempered(shares, a)) == pytest.approx(1.0, abs=1e-9)
    b = mixing.exponent_for_repeats(shares, 2.0)
    assert mixing.most_epochs(shares, b) == pytest.approx(2.0, abs=1e-9) and 7 ** (1 - b) == pytest.approx(2.0)
    assert mixing.tempered(shares, 0.0)[3] == 0 and mixing.exponent_for_repeats(np.array([0.5, 0.5]), 2.0) == 0.0


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("block_rows", [4096, 5])
def test_draws_equal_brute_force(spark, documents, block_rows):
    rows = mixing.with_tokens(documents)
    assert sorted((r.doc_id, r.n_tokens) for r in rows.collect()) == sorted((i, size_of(t)) for i, t in corpus())
    mix = mixing.plan(mixing.counts_of(rows), repeats=2.5)
    drawn = mixing.realise(rows, mix, block_rows=block_rows).collect()
    budgets = dict(zip(mix.sources, mix.budgets))
    totals = dict(zip(mix.sources, mix.tokens))
    per = defaultdict(list)
    for r in drawn:
        per[r.source, r.epoch].append(r)
    for source, budget in budgets.items():
        whole, rest = divmod(budget, totals[source])
        assert whole >= 1 and [e for s, e in sorted(per) if s == source] == list(range(1, whole + 1 + (rest > 0)))
        for epoch in range(1, whole + 1):
            assert len({r.doc_id for r in per[source, epoch]}) == len(per[source, epoch]) == mix.rows[mix.sources.index(source)]
        if rest:  # a prefix of the permutation, that reaches the budget with its last document
            last = sorted(per[source, whole + 1], key=lambda r: (r.block, r.place, r.doc_id))
            taken = sum(r.n_tokens for r in last)
            assert taken >= rest > taken - max(r.n_tokens for r in last)
            if block_rows == 4096:
                assert taken - last[-1].n_tokens < rest
    assert max(b / t for b, t in zip(mix.budgets, mix.tokens)) <= 2.5 + 1e-3


def test_a_smaller_budget_and_a_target_entropy(spark, documents):
    rows = mixing.with_tokens(documents)
    counts = mixing.counts_of(rows)
    mix = mixing.plan(counts, target_entropy=math.log(3) * 0.999, budget=3000)
    assert mixing.entropy(np.array(mix.weights)) == pytest.approx(math.log(3) * 0.999, abs=1e-6) or mix.exponent == 1.0
    drawn = mixing.realise(rows, mix).groupBy("source").sum("n_tokens").collect()
    assert all(r[1] >= dict(zip(mix.sources, mix.budgets))[r[0]] for r in drawn)


def test_null_sources_and_repeated_rows(spark):
    rows = [(1, "a b", None, None, 3), (2, None, None, None, None), (3, "c", "x", "x", 1), (3, "c", "x", "x", 1), (None, "d e", "x", "x", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    drawn = mixing.mixed(docs).collect()
    assert Counter(r.source for r in drawn if r.epoch == 1) == {"": 2, "x": 3}
    again = mixing.repeated_rows(docs)
    assert again.columns == docs.columns and again.count() >= len(rows)
    assert {r.doc_id for r in again.collect()} == {1, 2, 3, None}


def test_columns_of_any_name_pass_through(spark, edges):
    docs = edges.withColumn("place 2", edges["place"])
    again = mixing.repeated_rows(docs)
    assert again.columns == docs.columns and again.count() >= len(EDGES)
    assert {r["copy"] for r in again.collect()} == {"copy"} and {r.times for r in again.collect()} == {"times"}


@pytest.mark.parametrize("repeats", [1.3, 2.0, 100.0])
def test_more_sources_than_are_listed(spark, monkeypatch, repeats):
    """Forty sources, one of them with a third of all rows, one without a word: the plan as a table draws what the list draws."""
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "en", "hot" if i % 3 == 0 else "mute" if i % 41 == 1 else f"s{i % 38}", 9) for i in range(900)]
    rows = [(i, "" if s == "mute" else t, a, s, n) for i, t, a, s, n in rows] + [(5000, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4)

    def drawn():
        return sorted(map(tuple, mixing.mixed(docs, repeats).select("doc_id", "source", "n_tokens", "epoch", "block", "place").collect()))

    listed = drawn()
    monkeypatch.setattr(mixing, "MOST_SOURCES", 5)
    assert mixing.counts_of(mixing.with_tokens(docs)) is None
    assert drawn() == listed
    assert mixing.mixed(docs.filter("source = 'mute'")).count() == sum(r[3] == "mute" for r in rows)
