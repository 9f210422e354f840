"""Weights, scores and ranks against plain Python; the cutoff under ties and wide brackets."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from profilespark.llm import resample
from conftest_llm import prose, table

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def buckets(text):
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % 10000 for f in features(text)[1]]


def plain(rows, targets, percent=25):
    source, target = Counter(b for _, t in rows for b in buckets(t)), Counter(b for t in targets for b in buckets(t))
    s_all, t_all = sum(source.values()), sum(target.values())
    gain = {b: math.floor(1000 * math.log((target[b] + 1) * (s_all + 10000) / ((source[b] + 1) * (t_all + 10000)))) for b in source}
    out = []
    for doc_id, text in rows:
        found = buckets(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    eligible = [i for i, (_, t) in enumerate(rows) if features(t)[0] >= 20]
    eligible.sort(key=lambda i: (-out[i][3], out[i][0] is None, out[i][0] or 0))
    for rank, i in enumerate(eligible[:percent * len(eligible) // 100], 1):
        out[i][4] = rank
    return out


def as_text(rows):
    return sorted(tuple(map(str, r)) for r in rows)


@pytest.fixture(scope="module")
def targets():
    return [prose(900, 60), None, "", prose(77, 300), "Ünï cödé W1 w2 W3"]


def test_every_column_against_plain_python(spark, documents, edges, targets):
    extra = table(spark, [(i, "X" * (60 + i % 9) + " " + prose(i, 25)) for i in range(300)] + [(None, prose(1, 40))] * 3)
    target = spark.createDataFrame([(i, t) for i, t in enumerate(targets)], "item_id bigint, text string")
    for docs in (documents, edges, extra):
        got = resample.resample(docs, target).drop("n_words").collect()
        assert as_text(got) == as_text(plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], targets))


def test_empty_tables(spark, documents, empty, targets):
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    assert resample.resample(empty, target).count() == 0
    got = resample.resample(documents, target.limit(0)).drop("n_words").collect()
    assert as_text(got) == as_text(plain([(r.doc_id, r.text) for r in documents.collect()], []))


def test_pairs_of_words_by_tables():
    words = [b"a" * n for n in (1, 2, 63, 64, 65, 200, 3)] + ["ñandú".encode()]
    random.Random(1).shuffle(words)
    _, found, _ = resample.feature_buckets([b" ".join(words)], 1 << 31)
    wanted = [*words, *(a + b" " + b for a, b in zip(words, words[1:]))]
    assert found.tolist() == [zlib.crc32(w) % (1 << 31) for w in wanted]


def test_cutoff_and_ranks_with_ties_and_copies(spark):
    """A third of the rows are copies of one, half share one score; the bracket starts too narrow and has to widen."""
    draw = random.Random(4)
    rows = [(draw.choice((7, 7, draw.randrange(50))) * 100, draw.choice((draw.randrange(900), None)), i) for i in range(3000)]
    rows += [(700, 5, 3000 + i) for i in range(1500)]
    df = spark.createDataFrame(rows, "score bigint, id bigint, row bigint").repartition(5)
    order = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))
    for wanted in (1, 2, 700, 1125, 2000, 4499, 4500):
        last = resample.cutoff(df, len(rows), wanted, margin=1e-9)
        assert last == order[wanted - 1]
        assert df.filter(resample.at_or_before(last)).count() == wanted
    ranks = resample.ranked(df, len(rows)).orderBy("rank").collect()
    assert [(r.score, r.id, r.row) for r in ranks] == order
    assert [r["rank"] for r in ranks] == list(range(1, len(rows) + 1))


def test_drawn_documents_are_closer_to_the_target(spark):
    """Not a matter of the contract: documents written like the target are drawn more often."""
    like = [(i, " ".join(f"t{random.Random(i).randrange(50)}x{k % 7}" for k in range(60))) for i in range(200)]
    other = [(1000 + i, prose(i, 60)) for i in range(800)]
    target = spark.createDataFrame([(" ".join(f"t{i}x{k}" for k in range(7)),) for i in range(50)] * 100, "text string")
    drawn = resample.resample(table(spark, like + other), target).filter("rank is not null")
    assert drawn.count() == 250
    assert drawn.filter(F.col("doc_id") < 1000).count() > 150
