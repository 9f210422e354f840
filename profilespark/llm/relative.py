"""Substring dedup by relative Lempel-Ziv parsing against every indexed block of reference text.

The reference is all text that starts earlier (smaller id, or earlier in the same document). It is indexed in blocks: a slice of
documents that a task reads together is one, and around each anchor (`anchors.py`) the text of all slices that holds
it is in the block of the anchor's hash. Of a block, the index holds every run of WINDOW words and its places. A document is parsed against
each block that its anchors name: at a run that the block holds earlier, the match with the earliest such place is extended, word by
word, for as long as the document goes on like it. That is a factor: (start, length, place in the reference). The next
factor begins at the first run that the last one doesn't hold, so every run across a factor's end is looked up itself. Factors are at least
WINDOW words long; their union, over all blocks, is removed.

Two equal runs share an anchor, so they meet in its block; only runs whose anchor hash occurs more than once in the
corpus are indexed there, and of equal runs of a slice the earliest alone, so what many documents share leaves a slice once, however hot.
An anchor's block holds the runs around it, so a long factor comes out as several, which follow on each other.

Shuffled: one row per distinct anchor and batch; the entries that may be repeated, packed, 18 bytes each before compression;
the factors, packed; and each text once. Runs are compared by 80 bits of hash.

A null or empty text has no words. A null id comes first. Different texts of one id are in order of a hash of the text; of
rows equal in id and text the first stays, and in the others each run starts earlier.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from profilespark.llm.anchors import (
    INDEX, anchors, buckets, document_key, entry_rows, index_of_entries, index_of_spans, marked, matched_entries, repeated, slide, span_rows,
    with_spans,
)
from profilespark.llm.text import Words, chunks, encoded, run_hash

WINDOW = 20
SEED = 6
SLICE_BYTES = 8 << 20


class _Runs:
    """For the texts of a chunk: hashes of seeds, and the lowest seed hash of each window, none over a document's end."""

    def __init__(self, texts: list[bytes], window: int, seed: int) -> None:
        self.words = Words(texts)
        self.document = self.words.document()
        self.seeds = run_hash(self.words.hash, seed)
        self.width = window - seed + 1
        self.window = window
        self.whole = self._within(seed)

    def _within(self, n: int) -> np.ndarray:
        """Whether the n words from each place are of one document."""
        count = max(0, len(self.document) - n + 1)
        return self.document[:count] == self.document[len(self.document) - count:]

    def anchor_hashes(self) -> np.ndarray:
        places = anchors(self.seeds, self.width, self.words.first)
        return self.seeds[places[self.whole[places]]]

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, hash, lowest seed hash) of every window."""
        if len(self.document) < self.window:
            return (np.zeros(0, dtype=np.int64), *[np.zeros(0, dtype=np.uint64)] * 2)
        at = np.flatnonzero(self._within(self.window))
        return at, run_hash(self.words.hash, self.window)[at], slide(self.seeds, self.width, True)[at]


def references(keys: list[np.ndarray], place: list[np.ndarray]) -> np.ndarray:
    """For each run of a block, the run with the same words that starts earliest; -1 if that is the run itself or at the same place."""
    n = len(keys[0])
    out = np.full(n, -1, dtype=np.int64)
    order = np.lexsort((*place[::-1], *keys[::-1]))
    new = np.ones(n, dtype=bool)
    new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    earlier = np.any([p[order] != p[first] for p in place], axis=0)
    out[order[earlier]] = first[earlier]
    return out


def _shared(keys: list[np.ndarray], a: int, b: int, most: int) -> int:
    """How many runs from a on equal those from b on, at most `most`; compared in stretches that double."""
    done, step = 1, 16
    while done < most:
        size = min(step, most - done)
        equal = keys[0][a + done:a + done + size] == keys[0][b + done:b + done + size]
        equal &= keys[1][a + done:a + done + size] == keys[1][b + done:b + done + size]
        if not equal.all():
            return done + int(equal.argmin())
        done, step = done + size, 2 * step
    return done


def factors(keys: list[np.ndarray], place: list[np.ndarray], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run that a factor starts with, its length in words, run of the reference it is copied from), of all documents of a block.

    `keys` are the hashes of the runs, `place` their document (two parts) and start.
    """
    order = np.lexsort(place[::-1])
    keys, place = [k[order] for k in keys], [p[order] for p in place]
    n = len(order)
    # runs left to the end of the stretch of starts that follow on each other
    last = np.ones(n, dtype=bool)
    last[:-1] = (place[0][1:] != place[0][:-1]) | (place[1][1:] != place[1][:-1]) | (place[2][1:] != place[2][:-1] + 1)
    ends = np.flatnonzero(last)
    left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n) + 1 if n else np.zeros(0, dtype=np.int64)
    reference = references(keys, place)
    matched = np.flatnonzero(reference >= 0)
    starts, lengths = [], []
    at, k = -1, 0
    for i in matched.tolist():
        if i < at:
            continue  # in the factor before
        r = int(reference[i])
        k = _shared(keys, i, r, int(min(left[i], left[r])))
        starts.append(i)
        lengths.append(k + window - 1)
        at = i + k
    starts = np.array(starts, dtype=np.int64)
    return order[starts], np.array(lengths, dtype=np.int64), order[reference[starts]]


def _seeds(docs: DataFrame, window: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = encoded(batch.column(0).to_pylist())
            found = [_Runs(texts[a:b], window, seed).anchor_hashes() for a, b in chunks(texts)]
            if found:
                seeds, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seeds.view(np.int64)), pa.array(n.astype(np.int64))], ["seed", "n"])

    return docs.select("text").mapInArrow(run, "seed bigint, n bigint")


def _index(docs: DataFrame, bitmap: np.ndarray, n: int, window: int, seed: int) -> DataFrame:
    """Entries of all windows that may be repeated, in blocks, and the spans of those that a slice has matched itself."""

    def entries(texts: list[bytes], ids: np.ndarray, versions: np.ndarray) -> Iterator[pa.RecordBatch]:
        parts = []
        for a, b in chunks(texts):
            runs = _Runs(texts[a:b], window, seed)
            at, hashes, lowest = runs.windows()
            hit = marked(bitmap, lowest)
            at = at[hit]
            document = runs.document[at]
            lowest = lowest[hit]
            parts.append((lowest, hashes[hit], (lowest & np.uint64(0xFFFF)).astype(np.uint16), document + a, at - runs.words.first[document]))
        by, hashes, more, document, start = (np.concatenate(c) for c in zip(*parts))
        keys, place = [hashes, more], [ids[document], versions[document], start]
        found, length, _ = factors(keys, place, window)
        if len(found):
            own = document[found]
            yield index_of_spans(span_rows(ids[own], versions[own], start[found], start[found] + length, n))
        first = np.flatnonzero(references(keys, place) < 0)
        if len(first):
            yield index_of_entries(entry_rows(*(x[first] for x in (by, hashes, more, document, start)), ids, versions, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = (np.asarray(batch.column(k)).astype(np.int64) for k in (0, 1))
            texts = encoded(batch.column(2).to_pylist())
            for a, b in chunks(texts, SLICE_BYTES):
                yield from entries(texts[a:b], ids[a:b], versions[a:b])

    return docs.select("id", "version", "text").mapInArrow(run, INDEX)


def duplicate_spans(keyed: DataFrame, window: int = WINDOW, seed: int | None = None) -> tuple[DataFrame, int]:
    """(spans, in words, of every run of `window` words that also starts earlier, their buckets); `keyed` is (id, version, text)."""
    seed = min(SEED, max(1, window // 3)) if seed is None else seed
    bitmap, _, occurrences = repeated(_seeds(keyed, window, seed))
    n = buckets(keyed.sparkSession, occurrences)

    def parsed(keys: list[np.ndarray], place: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        found, length, _ = factors(keys, place, window)
        return [(found, place[2][found] + length)]

    return matched_entries(_index(keyed, bitmap, n, window, seed), parsed, n, batches_matched=True), n


def _left(text: str, spans: list[tuple[np.ndarray, np.ndarray]], copied: bool, window: int) -> tuple[list[bytes], list[bytes]]:
    """(words, words that stay); nothing stays of a copy that is long enough to hold a run."""
    words = text.encode("utf-8", "surrogatepass").split()
    if copied and len(words) >= window:
        return words, []
    rest, done = [], 0
    for a, b in zip(*[x.tolist() for x in spans[0]]):
        rest += words[done:a]
        done = b
    return words, rest + words[done:]


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""

    def kept(text: str, spans: list, copied: bool) -> tuple[int, int, str]:
        words, rest = _left(text, spans, copied, window)
        return len(words), len(words) - len(rest), hashlib.sha256(b" ".join(rest)).hexdigest()

    keyed = document_key(docs)
    columns = "n_words bigint, n_removed bigint, kept_sha256 string"
    return with_spans(keyed, *duplicate_spans(keyed, window), kept, columns, first_too=False)


def removed(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id and the text without its duplicate spans: the words left, joined by one space."""

    def rest(text: str, spans: list, copied: bool) -> tuple[str]:
        return (b" ".join(_left(text, spans, copied, window)[1]).decode("utf-8", "surrogatepass"),)

    keyed = document_key(docs)
    return with_spans(keyed, *duplicate_spans(keyed, window), rest, "text string", first_too=False)
