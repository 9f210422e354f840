import hashlib
import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest

from conftest_llm import EDGES, corpus, prose, table
from profilespark.llm import anchors, relative, substring, suffix
from profilespark.llm import text as text_tools


def test_suffix_array_and_common_prefixes_equal_brute_force(monkeypatch):
    draw = random.Random(3)
    texts = [bytes(draw.choice(b"ab" if k % 2 else b"abcd") for _ in range(draw.randint(0, 60))) for k in range(400)]
    texts += [t * 3 + t[:7] + b"\xff" + t for t in texts[:60]] + [b"a" * 300, b""]
    for alphabet, refined in ((1024, 256), (0, 256), (0, 3), (0, 0)):  # whole arrays; one by one, substrings value by value or induced
        monkeypatch.setattr(suffix, "WAVE_ALPHABET", alphabet)
        monkeypatch.setattr(suffix, "REFINED", refined)
        for t in texts:
            order = suffix.suffix_array(np.append(np.frombuffer(t, np.uint8).astype(np.int64) + 1, 0), 257)
            assert order.tolist() == sorted(range(len(t) + 1), key=lambda i: t[i:])
            if t:
                plcp, neighbour = suffix.common_prefixes(np.frombuffer(t, np.uint8), order[1:])
                for i in range(len(t)):
                    k, j = 0, neighbour[i]
                    while j >= 0 and max(i, j) + k < len(t) and t[i + k] == t[j + k]:
                        k += 1
                    assert plcp[i] == (k if j >= 0 else 0)


@pytest.mark.parametrize("doubled", [12, 0])
def test_names_by_doubled_ranks_or_by_recursion(monkeypatch, doubled):
    """Both ways give the order of all suffixes; text that repeats for long is sorted in whole arrays, without a loop over its places."""
    monkeypatch.setattr(suffix, "DOUBLED", doubled)
    singly, induced = suffix._induce_singly, []
    monkeypatch.setattr(suffix, "_induce_singly", lambda *a: induced.append(len(a[0])) or singly(*a))
    draw = random.Random(4)
    for k in range(40):
        part = bytes(draw.choice(b"abcd") for _ in range(draw.randint(1, 200)))
        t = part * draw.randint(1, 4) + b"\xff" + part[:50] + bytes([97 + k % 3]) + part
        order = suffix.suffix_array(np.append(np.frombuffer(t, np.uint8).astype(np.int64) + 1, 0), 257)
        assert order.tolist() == sorted(range(len(t) + 1), key=lambda i: t[i:])
    t = bytes(draw.randint(0, 254) for _ in range(6000)) * 2
    order = suffix.suffix_array(np.append(np.frombuffer(t, np.uint8).astype(np.int64) + 1, 0), 257)
    assert order.tolist() == sorted(range(len(t) + 1), key=lambda i: t[i:])
    assert bool(induced) == (not doubled)


def test_shared_bytes_of_two_places_up_to_the_end():
    draw = np.random.default_rng(5)
    for n in (2, 7, 8, 9, 15, 16, 17, 40, 300):
        data = np.repeat(draw.choice([0, 1, 128, 255], n), draw.integers(1, 20, n))[:n].astype(np.uint8)
        a, b = draw.integers(0, n, (2, 80))
        a, b = a[a != b], b[a != b]
        plain = [next((k for k in range(n - max(x, y)) if data[x + k] != data[y + k]), n - max(x, y)) for x, y in zip(a, b)]
        assert suffix._shared(data, a, b).tolist() == plain
    data = np.zeros(1 << 20, dtype=np.uint8)
    tracemalloc.start()
    assert suffix._shared(data, np.array([0]), np.array([len(data) - 5])).tolist() == [5]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 2 * len(data)  # one copy of the bytes, not eight bytes for each


def brute_bytes(rows, window, passage=None):
    passage = min(200, window // 2) if passage is None else passage
    starts = defaultdict(set)
    for k, (_, text) in enumerate(rows):  # equal rows are documents of their own
        data = (text or "").encode()
        for size in {window, passage}:
            for i in range(len(data) - size + 1):
                starts[data[i:i + size]].add((k, i))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone, shared = bytearray(len(data)), bytearray(len(data))
        for i in range(len(data) - window + 1):
            if len(starts[data[i:i + window]]) > 1:
                gone[i:i + window] = b"\x01" * window
        for i in range(len(data) - passage + 1):
            if len({k for k, _ in starts[data[i:i + passage]]}) > 1:
                shared[i:i + passage] = b"\x01" * passage
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(data)))
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest(), sum(shared)))
    return sorted(out, key=str)


def found_bytes(docs, window):
    return sorted(map(tuple, substring.dedup(docs, window).collect()), key=str)


@pytest.mark.parametrize("window", [48, 400])
def test_bytes_removed_equal_brute_force(spark, documents, window):
    rows = [r for r in corpus() if r[0] != 68]
    assert found_bytes(documents.filter("doc_id <> 68"), window) == brute_bytes(rows, window)


@pytest.mark.parametrize("bits", [1 << 12, 32 * 12345, 1 << 20])
def test_a_bitmap_reaches_the_driver_in_few_rows(spark, monkeypatch, bits):
    places = np.unique(np.concatenate((np.random.default_rng(bits).integers(0, bits, 3000), [0, 31, bits - 1])))
    rows = spark.createDataFrame([(int(b),) for b in [*places, *places[:50]]], "bit bigint")
    bitmap = anchors.bitmap_of(rows, bits)
    assert bitmap.dtype == np.uint32 and len(bitmap) == bits // 32
    assert np.array_equal(np.flatnonzero((bitmap[np.arange(bits) >> 5] >> (np.arange(bits) & 31).astype(np.uint32)) & 1), places)
    # a bitmap at the bound comes in 512 rows; one of its words a row were 4,194,304
    assert anchors.BITMAP_BITS // anchors.PIECE_BITS == 512


def test_bytes_of_hot_anchors_in_parts(spark, monkeypatch):
    monkeypatch.setattr(anchors, "HOT_LEAST", 2)
    monkeypatch.setattr(anchors, "HOT_SHARE", 0.0)
    shared = prose(5, 40)
    rows = [(i, prose(i, 12) + " " + shared + " " + prose(100 + i // 2, 14)) for i in range(30)] + [(90 + i, "ab" * (60 + i)) for i in range(4)]
    assert found_bytes(table(spark, rows), 96) == brute_bytes(rows, 96)


def test_a_stretch_holds_the_windows_that_choose_its_anchor_and_little_else():
    """Every window is whole in a stretch around its lowest anchor; windows that hold an anchor without choosing it are left out."""
    sizes = substring.Sizes(400, 200, 32)
    texts = [prose(k, 150 + 20 * k).encode() for k in range(12)] + [b"ab" * 700, b"x" * 450, prose(3, 90).encode() + b"-" * 500 + prose(3, 90).encode(), b"y" * 200]
    seeds, document, places, starts, ends = substring._anchored(texts, sizes)
    for d, text in enumerate(texts):
        hashes = text_tools.run_hash(text_tools.byte_values(np.frombuffer(text, np.uint8)), sizes.seed, mixed=True)
        own = np.flatnonzero(document == d)
        assert (hashes[places[own]] == seeds[own]).all() and (starts[own] >= 0).all()
        for size in (sizes.window, sizes.passage):
            for x in range(len(text) - size + 1):
                whole = own[(starts[own] <= x) & (ends[own] >= x + size) & (places[own] >= x) & (places[own] + sizes.seed <= x + size)]
                assert hashes[x:x + size - sizes.seed + 1].min() in seeds[whole]
    plain = np.flatnonzero(document < 12)
    ends = np.minimum(ends, np.array([len(t) for t in texts])[document])
    # about 84 windows of 200 bytes choose an anchor, or 185 of 400; all that hold it are 168 and 368
    assert np.median((ends - starts)[plain]) < 320


def test_passages_that_repeat_in_one_document_alone_and_in_two(spark):
    """A passage of over 50 words, shorter than a window, in several documents, once or twice in each; another one twice in one document."""
    passage, own = prose(71, 55), prose(72, 55)
    assert 200 < len(passage.encode()) < 400
    rows = [(1, f"{prose(1, 60)} {passage} {prose(2, 60)} {passage} {prose(3, 30)}"), (2, f"{prose(4, 70)} {passage}"), (3, f"{passage} {prose(5, 80)}"),
            (4, f"{own} {prose(6, 60)} {own} {prose(7, 9)}"), (5, prose(8, 200))]
    got = found_bytes(table(spark, rows), 400)
    assert got == brute_bytes(rows, 400)
    shared = {r[0]: r[5] for r in got}
    assert shared[1] >= 2 * 200 <= 2 * shared[2] and shared[3] >= 200 and shared[4] == shared[5] == 0


def test_bytes_of_edge_rows(spark, edges, empty):
    assert found_bytes(edges, 48) == brute_bytes(EDGES, 48)
    assert substring.dedup(edges).count() == len(EDGES) and substring.dedup(empty).count() == 0
    assert substring.removed(empty).count() == 0


def brute_words(rows, window):
    seen, out = {}, []
    for k, (doc_id, text) in enumerate(sorted(rows, key=lambda r: -(1 << 63) if r[0] is None else r[0])):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if seen.setdefault(tuple(words[i:i + window]), (k, i)) != (k, i):
                gone[i:i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found_words(docs, window):
    return sorted(map(tuple, relative.dedup(docs, window).collect()), key=str)


@pytest.mark.parametrize("window", [6, 20])
def test_words_removed_equal_brute_force(spark, documents, window):
    assert found_words(documents, window) == brute_words(corpus(), window)


def test_words_of_edge_rows(spark, edges, empty):
    assert found_words(edges, 6) == brute_words(EDGES, 6)
    assert relative.dedup(edges).count() == len(EDGES) and relative.dedup(empty).count() == 0


def test_text_left_over(spark):
    rows = [(1, "a b c d e f g"), (2, "x a b c d e f y"), (3, None)]
    got = {r.doc_id: r.text for r in relative.removed(table(spark, rows), 5).collect()}
    assert got == {1: "a b c d e f g", 2: "x y", 3: ""}


def test_equal_rows_repeat_each_other(spark):
    """With and without an id; of equal rows op1 removes all, op9 all but the first; short ones keep everything."""
    long, other = prose(41, 90), prose(42, 90)
    rows = [(1, long)] * 3 + [(None, other)] * 2 + [(2, other), (3, "too short"), (3, "too short"), (None, None), (None, None)]
    assert found_bytes(table(spark, rows), 48) == brute_bytes(rows, 48)
    got = found_words(table(spark, rows), 20)
    assert got == brute_words(rows, 20)
    assert sum(r[2] == 0 for r in got if r[1] > 20) == 2


def plain_factors(docs, window):
    """The greedy parse, word by word, of each document against all text that starts earlier, the earliest place first."""
    out = []
    for d, words in enumerate(docs):
        i = 0
        while i + window <= len(words):
            found = next(((e, j) for e in range(d + 1) for j in range(len(docs[e]) - window + 1)
                          if (e, j) < (d, i) and docs[e][j:j + window] == words[i:i + window]), None)
            if found is None:
                i += 1
                continue
            e, j = found
            k = window
            while i + k < len(words) and j + k < len(docs[e]) and docs[e][j + k] == words[i + k]:
                k += 1
            out.append((d, i, k, e, j))
            i += k - window + 1  # the runs across the factor's end are looked up
    return out


def test_factors_equal_the_greedy_parse():
    draw = random.Random(8)
    for _ in range(200):
        docs = [[draw.randrange(3) for _ in range(draw.randint(0, 40))] for _ in range(3)]
        docs += [draw.choice(docs)[draw.randrange(3):] * draw.choice((1, 1, 2)) for _ in range(3)]
        window = draw.choice((2, 4, 7))
        runs = [(d, i, tuple(w[i:i + window])) for d, w in enumerate(docs) for i in range(len(w) - window + 1)]
        draw.shuffle(runs)
        names = {r: k for k, r in enumerate(dict.fromkeys(r[2] for r in runs))}
        hashes = np.array([names[r[2]] for r in runs], dtype=np.uint64)
        place = [np.array([r[0] for r in runs], dtype=np.int64), np.zeros(len(runs), dtype=np.int64), np.array([r[1] for r in runs], dtype=np.int64)]
        found, length, reference = relative.factors([hashes, np.zeros(len(runs), dtype=np.uint16)], place, window)
        got = [(runs[f][0], runs[f][1], n, runs[r][0], runs[r][1]) for f, n, r in zip(found.tolist(), length.tolist(), reference.tolist())]
        assert sorted(got) == plain_factors(docs, window)
