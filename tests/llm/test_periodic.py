"""Runs against every period tried at every place; digests against a plain rebuild of the words."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from profilespark.llm import periodic
from conftest_llm import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """Every stretch in which words q apart are equal, for every q, that no smaller period covers."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        start = None
        for i in range(n - q + 1):
            if i < n - q and words[i] == words[i + q]:
                start = i if start is None else start
            elif start is not None:
                end = i + q
                if end - start >= max(24, 3 * q) and not any(s <= start and end <= s + k for (s, k, p) in found.values() if p < q and q % p == 0):
                    found[start, q] = (start, end - start, q)
                start = None
    return sorted((s, k, p) for s, k, p in found.values())


def plain(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    listed = "".join(f"{s},{k},{q}\n" for s, k, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest(),
    )


def texts(seed, count):
    """Texts of few different words, of repeated stretches with and without errors, and of runs inside runs."""
    draw = random.Random(seed)
    for _ in range(count):
        words = []
        for _ in range(draw.randint(1, 5)):
            kind = draw.random()
            base = [f"w{draw.randrange(draw.choice((1, 2, 3, 40)))}" for _ in range(draw.randint(1, 14))]
            if kind < 0.6:
                base = (base * draw.randint(2, 9))[:draw.randint(1, 120)]
            if kind > 0.5:
                base = base * draw.randint(1, 4)
            if kind > 0.9 and base:
                base[draw.randrange(len(base))] = "x"
            words += base
        yield words


def test_runs_are_those_of_every_period_tried_everywhere():
    for words in texts(1, 600):
        values = np.unique(np.array(words), return_inverse=True)[1].astype(np.uint64)
        assert periodic.runs(values) == plain_runs(words), words


def test_a_long_run_of_one_word_and_blocks_of_places():
    values = np.zeros(9000, dtype=np.uint64)
    assert periodic.runs(values) == [(0, 9000, 1)]
    fibonacci = ["a", "b"]
    while len(fibonacci[-1]) < 1500:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    word = fibonacci[-1][:1500]
    assert periodic.runs(np.array([ord(c) for c in word], dtype=np.uint64)) == plain_runs(word)


def test_ordered_places():
    draw = random.Random(3)
    places, held = periodic.Places(500), [500]
    for x in draw.sample(range(501, 100000), 9000):
        places.add(x)
        held.append(x)
    held.sort()
    assert places.ordered() == held and places.size == len(held)
    for x in range(1, 100000, 997):
        if x not in held:
            lower, upper = [p for p in held if p < x], [p for p in held if p > x]
            assert places.around(x) == (lower[-1] if lower else -1, upper[0] if upper else -1)


def test_query_against_plain_words(spark, documents, edges):
    extra = table(spark, [(1000 + i, " ".join(words)) for i, words in enumerate(texts(5, 150))])
    for docs in (documents, edges, extra):
        got = periodic.detect(docs, change=periodic.planted).drop("n_words", "n_dropped").collect()
        # long texts are held against brute force only where that ends
        texts_of = [(r.doc_id, r.text) for r in docs.collect()]
        wanted = sorted((str(i), *map(str, plain(i, t))) for i, t in texts_of if len(t or "") < 20000)
        assert len(got) == len(texts_of)
        have = sorted(tuple(map(str, r)) for r in got)
        long = {str(i) for i, t in texts_of if len(t or "") >= 20000}
        assert [r for r in have if r[0] not in long] == wanted


def test_empty_table_and_schema(empty):
    out = periodic.detect(empty, change=periodic.planted)
    assert out.count() == 0
    assert out.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_nothing_is_planted_unless_asked(documents):
    assert periodic.detect(documents.filter("doc_id = 64")).first().period == 2
