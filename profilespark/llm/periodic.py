"""Maximal periodic runs of words, found by uniting suffix classes in the order of falling LCP.

The suffixes of a text are sorted, and the places that are neighbours in that order are united with
union-find from the longest common prefix down to MIN_SHARED words. Each class keeps its places in order. Two places
i < j that become neighbours in place when classes unite at length L share exactly L words, so if their distance
p = j - i is at most L, the words from i to j + L have period p. Were p not the smallest period of that
stretch, a place of the same class would lie between them; so a seed's period is the smallest. All seeds of one run end at the
same word, and the run's own start is the first of them: (period, end) names a run and the smallest i is its start.

Whole texts; words are `[^\\x20\\x09-\\x0D]+`, compared by 64-bit hashes. A text in which no MIN_SHARED words recur
has no run and is not sorted. Null and empty texts have no words and no runs; copies of a row
each give their own row; a null id counts as an empty id text; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from profilespark.llm.text import Words, chunks, encoded, inside, mix, per_text, run_hash

#: a run is at least this long, and at least this many periods
MIN_WORDS = 24
MIN_PERIODS = 3
#: so the first two places of a run, a period apart, share at least this many words
MIN_SHARED = MIN_WORDS * (MIN_PERIODS - 1) // MIN_PERIODS
#: places in one block of an ordered set
BLOCK = 1024

COLUMNS = (
    "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string, n_words bigint, n_dropped bigint"
)


class Places:
    """An ordered set of places, in blocks, so that adding one moves few others."""

    def __init__(self, place: int) -> None:
        self.blocks = [[place]]
        self.firsts = [place]
        self.size = 1

    def around(self, place: int) -> tuple[int, int]:
        """The places of the set before and after one that is not in it; -1 where there is none."""
        at = bisect_right(self.firsts, place) - 1
        if at < 0:
            return -1, self.firsts[0]
        block = self.blocks[at]
        k = bisect_left(block, place)
        if k < len(block):
            return block[k - 1], block[k]
        return block[-1], self.firsts[at + 1] if at + 1 < len(self.firsts) else -1

    def add(self, place: int) -> None:
        at = max(bisect_right(self.firsts, place) - 1, 0)
        block = self.blocks[at]
        insort(block, place)
        self.firsts[at] = block[0]
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[at:at + 1] = block[:BLOCK], block[BLOCK:]
            self.firsts.insert(at + 1, block[BLOCK])

    def ordered(self) -> list[int]:
        return [place for block in self.blocks for place in block]


def suffixes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, shared): the suffixes in order, and how many values each shares with the one before it.

    Ranks of 1, 2, 4, ... values are sorted until all differ; the same ranks then give the shared lengths.
    """
    n = len(values)
    rank = np.unique(values, return_inverse=True)[1].astype(np.int64) + 1  # 0 stands for the end
    levels, width = [], 1
    while True:
        padded = np.zeros(n + 1, dtype=np.int32)
        padded[:n] = rank
        levels.append(padded)
        if rank.max(initial=0) == n or width >= n:
            break
        after = np.zeros(n, dtype=np.int64)
        after[:n - width] = rank[width:]
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
        width *= 2
    order = np.argsort(rank, kind="stable")
    shared = np.zeros(n, dtype=np.int64)
    a, b = order[:-1], order[1:]
    length = np.zeros(max(n - 1, 0), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + length, b + length
        fits = np.maximum(x, y) + (1 << k) <= n
        equal = fits & (levels[k][np.minimum(x, n)] == levels[k][np.minimum(y, n)])
        length[equal] += 1 << k
    shared[1:] = length
    return order, shared


def runs(values: np.ndarray) -> list[tuple[int, int, int]]:
    """All maximal runs (start, length, smallest period) of the required length, by start, then period."""
    n = len(values)
    if n < MIN_WORDS:
        return []
    order, shared = suffixes(values)
    edges = np.flatnonzero(shared >= MIN_SHARED)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    parent: dict[int, int] = {}
    sets: dict[int, Places] = {}
    found: dict[tuple[int, int], int] = {}

    def root(place: int) -> int:
        if place not in parent:
            parent[place] = place
            sets[place] = Places(place)
            return place
        top = place
        while parent[top] != top:
            top = parent[top]
        while parent[place] != top:
            parent[place], place = top, parent[place]
        return top

    def seed(i: int, j: int, length: int) -> None:
        period = j - i
        # the run reaches from i to j + length: at least MIN_PERIODS periods of it
        if period * (MIN_PERIODS - 1) <= length and period + length >= MIN_WORDS:
            key = (period, j + length)
            if found.get(key, n) > i:
                found[key] = i

    for a, b, length in zip(order[edges - 1].tolist(), order[edges].tolist(), shared[edges].tolist(), strict=True):
        one, other = root(a), root(b)
        if sets[one].size < sets[other].size:
            one, other = other, one
        large, small = sets[one], sets.pop(other).ordered()
        parent[other] = one
        for k, place in enumerate(small):
            before, after = large.around(place)
            if before >= 0 and (k == 0 or small[k - 1] < before):
                seed(before, place, length)
            if after >= 0 and (k + 1 == len(small) or small[k + 1] > after):
                seed(place, after, length)
        for place in small:
            large.add(place)
    return sorted((start, end - start, period) for (period, end), start in found.items())


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, compared exactly; ties: smallest start, then period."""
    best = None
    for run in found:  # by start, then period: the first of equal ones stays
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def dropped_words(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each word lies in a run, after that run's first period."""
    steps = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in found:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps)[:n] > 0


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each place of a document whose tail is made periodic; None if it is left as it is."""
    h = zlib.crc32(b"" if doc_id is None else str(int(doc_id)).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


def _recurring(words: Words) -> np.ndarray:
    """Whether any MIN_SHARED consecutive words of a document stand in it twice."""
    out = np.zeros(len(words.first) - 1, dtype=bool)
    document = words.document()
    hashes = run_hash(words.hash, MIN_SHARED)
    at = inside(words.first, MIN_SHARED)
    keys = hashes[at] ^ mix(document[at].astype(np.uint64))
    order = np.argsort(keys)
    twice = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    out[document[at[order[twice]]]] = True
    return out


def _collapsed(words: Words, place: np.ndarray) -> bytes:
    buffer, start, end = words.buffer, words.start, words.end
    return b" ".join([buffer[s:e] for s, e in zip(start[place].tolist(), end[place].tolist(), strict=True)])


def _start(change: Callable[[int | None, int], np.ndarray | None]) -> Callable:
    def function(texts: list[str | None], ids: list) -> list[list]:
        rows = []
        docs = encoded(texts)
        for a, b in chunks(docs):
            words = Words(docs[a:b])
            recurring = _recurring(words)
            for d in range(b - a):
                first, last = int(words.first[d]), int(words.first[d + 1])
                n = last - first
                place = change(ids[a + d], n)
                found = []
                if place is not None or recurring[d]:
                    values = words.hash[first:last]
                    found = runs(values if place is None else values[place])
                place = np.arange(n) if place is None else place
                dropped = dropped_words(n, found)
                best = strongest(found)
                listed = "".join(f"{s},{length},{p}\n" for s, length, p in found)
                rows.append((
                    len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
                    hashlib.sha256(listed.encode()).hexdigest(),
                    hashlib.sha256(_collapsed(words, first + place[~dropped])).hexdigest(), n, int(dropped.sum()),
                ))
        return list(zip(*rows, strict=True))

    return function


def _as_they_are(doc_id: int | None, n: int) -> None:
    return None


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change: Callable = _as_they_are) -> DataFrame:
    """Per document: its runs, the strongest one, and digests of the run list and of the words that stay.

    `change(id, n_words)` may give the places of the original words that a document consists of.
    """
    return per_text(docs, lambda: _start(change), COLUMNS, id_col, text_col)
