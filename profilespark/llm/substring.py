"""Exact substring dedup with suffix arrays: bytes covered by a long enough string that also starts elsewhere.

1. Every document's anchors (`anchors.py`) are hashed and counted; only those that occur more than once matter, as
   two equal windows of WINDOW bytes share an anchor.
2. The bytes around such an anchor, as far as windows reach in which it is the lowest, go to the shard of its hash: equal
   windows have the same lowest one, so other windows that hold it meet elsewhere. Equal stretches are one stretch there, and
   if there are two of it all its windows are repeated. Of each stretch, only as much is kept on either side as some other
   stretch of the same anchor shares, in steps; one that is then shorter than a window is done.
3. A shard's stretches, those of one document merged where they overlap, are joined, and `suffix.py` finds the places whose
   window also starts elsewhere: induced suffix array, permuted common prefixes.
4. Spans go to their documents, and what they cover is removed.

The same arrays tell which bytes are covered by a passage, a string of PASSAGE bytes that also starts in another document: text that documents
share, though too short to be removed. Anchors are chosen for passages; around those that are anchors of a whole window too, and only there,
the bytes of a window are kept.

A hash with very many occurrences is dealt into parts by document, so no key fills a task; windows of different
parts are compared by 80 bits of hash in blocks. A shard has about SHARD_BYTES, so an array is bounded in any corpus.

Shuffled: one row per distinct anchor and batch; the stretches around repeated anchors; spans, packed; each text once.
Null and empty texts have no bytes. Rows equal in id and text are documents of their own: all they hold also starts in the other one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from profilespark.llm.anchors import (
    INDEX, SPANS, anchors, buckets, document_key, elsewhere, entry_rows, index_of_entries, index_of_spans, marked, matched_entries, part_of,
    repeated, span_rows, with_spans,
)
from profilespark.llm.suffix import repeated_places
from profilespark.llm.text import byte_values, chunks, encoded, mix, run_hash

WINDOW = 400
#: a string this long that another document holds too is a passage that they share: about 35 words, so that one of over 50 words is found
PASSAGE = 200
SEED = 32
SHARD_BYTES = 2 << 20
#: stretches held before they are cut down and sorted into shards
HELD_BYTES = 16 << 20
#: text whose anchors are chosen at once; its arrays, of eight bytes for each byte of text, stay in the cache of a core
ANCHOR_BYTES = 1 << 16
STEP = 32
_MARK = b"\xff"  # in no UTF-8 text


@dataclass(frozen=True)
class Sizes:
    """Bytes of a window, of a passage, and of the run of bytes whose hash is an anchor's."""

    window: int
    passage: int
    seed: int


def _own_range(hashes: np.ndarray, places: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(from, to): the bytes of the windows of `width` runs in which each anchor is the lowest.

    An anchor beside a lower one ends before it. Beside a higher one, or an equal one, its windows reach as far as they hold it:
    what is lower than both is then too far away.
    """
    values = hashes[places]
    start, last = places - width + 1, places + width - 1
    falls = values[1:] < values[:-1]
    start[1:] = np.where(values[:-1] < values[1:], np.maximum(start[1:], places[:-1] + 1), start[1:])
    last[:-1] = np.where(falls, np.minimum(last[:-1], places[1:] - 1), last[:-1])
    return start, last + seed


def _anchored(texts: list[bytes], sizes: Sizes) -> tuple[np.ndarray, ...]:
    """(seed hash, document, place, from, to) of every anchor, and the bytes of the windows that choose it; texts must be as long as a passage."""
    found = []
    for a, b in chunks(texts, ANCHOR_BYTES):
        seeds, document, *rest = _anchored_chunk(texts[a:b], sizes)
        found.append((seeds, document + a, *rest))
    return tuple(np.concatenate(c) for c in zip(*found))


def _anchored_chunk(texts: list[bytes], sizes: Sizes) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(_MARK.join(texts) + _MARK, dtype=np.uint8)
    offset = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)))
    hashes = run_hash(byte_values(data), sizes.seed, mixed=True)
    found = []
    for size in (sizes.window, sizes.passage):
        width = size - sizes.seed + 1
        own = anchors(hashes, width, offset)
        found.append((own, *_own_range(hashes, own, width, sizes.seed)))
    places = np.union1d(found[0][0], found[1][0])
    starts, ends = places.copy(), places.copy()
    for own, start, end in found:
        at = np.searchsorted(places, own)
        starts[at], ends[at] = np.minimum(starts[at], start), np.maximum(ends[at], end)
    document = np.searchsorted(offset, places, side="right") - 1
    whole = places + sizes.seed < offset[document + 1]
    places, document, starts, ends = places[whole], document[whole], starts[whole], ends[whole]
    base = offset[document]
    return hashes[places], document, places - base, np.maximum(starts - base, 0), ends - base


def _seeds(keyed: DataFrame, sizes: Sizes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t for t in encoded(batch.column(0).to_pylist()) if len(t) >= sizes.passage]
            if texts:
                found = [_anchored(texts[a:b], sizes)[0] for a, b in chunks(texts)]
                seeds, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seeds.view(np.int64)), pa.array(n.astype(np.int64))], ["seed", "n"])

    return keyed.select("text").mapInArrow(run, "seed bigint, n bigint")


def _stretches(keyed: DataFrame, bitmap: np.ndarray, hot: dict[int, int], sizes: Sizes) -> DataFrame:
    """(seed, part, id, version, start, lead, stretch): the bytes around each anchor that may be repeated."""
    names = ["seed", "part", "id", "version", "start", "lead", "stretch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = (np.asarray(batch.column(k)).astype(np.int64) for k in (0, 1))
            texts = encoded(batch.column(2).to_pylist())
            long = np.flatnonzero(np.array([len(t) for t in texts]) >= sizes.passage) if texts else np.zeros(0, dtype=np.int64)
            texts = [texts[i] for i in long]
            for a, b in chunks(texts):
                found = _anchored(texts[a:b], sizes)
                hit = marked(bitmap, found[0])
                seeds, document, places, starts, ends = (x[hit] for x in found)
                document = document + a
                own = [texts[d][s:e] for d, s, e in zip(document.tolist(), starts.tolist(), ends.tolist())]
                row = long[document]
                key = (mix(versions[row].view(np.uint64) ^ mix(ids[row].view(np.uint64))) >> np.uint64(1)).astype(np.int64)
                columns = [seeds.view(np.int64), part_of(seeds, key, hot), ids[row], versions[row], starts, places - starts]
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], pa.array(own, pa.binary())], names)

    return keyed.select("id", "version", "text").mapInArrow(
        run, "seed bigint, part bigint, id bigint, version bigint, start bigint, lead bigint, stretch binary")


class _Stretch:
    """One distinct stretch around one anchor, and where it occurs."""

    __slots__ = ("text", "lead", "places", "group", "tied")

    def __init__(self, text: bytes, lead: int, group: int) -> None:
        self.text, self.lead, self.group, self.tied = text, lead, group, False
        self.places: set[tuple[int, int, int]] = set()


def _cut_down(held: list[_Stretch], sizes: Sizes) -> list[tuple[_Stretch, int, int]]:
    """(stretch, from, to): what may be in a passage that another stretch of its group holds too.

    A group is left whole if a document has its anchor more than once: of such a run of anchors some are
    left out, so equal windows may hold different ones of it.
    """
    window, seed = sizes.window, sizes.seed
    data = np.frombuffer(b"".join(s.text for s in held), dtype=np.uint8)
    size = np.array([len(s.text) for s in held])
    base = np.cumsum(size) - size
    lead = np.array([s.lead for s in held])
    tied = np.array([s.tied for s in held])
    group = mix(np.array([s.group for s in held], dtype=np.uint64))
    values = byte_values(data)
    room = {-1: lead, 1: size - lead - seed}
    reach = {}
    for side in (-1, 1):
        grown = np.zeros(len(held), dtype=np.int64)
        active, chain = np.arange(len(held)), group  # chain: hash of the group and of all steps so far
        for steps in range(1, (window - seed) // STEP + 1):
            roomy = room[side][active] >= steps * STEP
            active, chain = active[roomy], chain[roomy]
            near = base[active] + lead[active] + (seed if side > 0 else 0)
            at = near + (steps - 1) * STEP if side > 0 else near - steps * STEP
            chain = mix(_hash_at(values, at, STEP) + chain)
            _, inverse, n = np.unique(chain, return_inverse=True, return_counts=True)
            shared = n[inverse] > 1
            active, chain = active[shared], chain[shared]
            grown[active] = steps * STEP
        reach[side] = np.where(tied, room[side], np.minimum(grown + STEP - 1, room[side]))
    out = []
    for k in np.flatnonzero(reach[-1] + seed + reach[1] >= sizes.passage):
        s = held[k]
        out.append((s, int(lead[k] - reach[-1][k]), int(lead[k] + seed + reach[1][k])))
    return out


def _hash_at(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n values from each place."""
    rows = values[at[:, None] + np.arange(n)[None, :]]
    return mix((rows * _WEIGHTS[:n]).sum(axis=1, dtype=np.uint64))


_WEIGHTS = mix(np.arange(1, STEP + 1, dtype=np.uint64)) | np.uint64(1)


def _merged_by_document(pieces: list[tuple[_Stretch, int, int]]) -> list[tuple[int, int, int, bytes]]:
    """(id, version, start, text): of each stretch its places in the first document that has it, overlapping ones of a document as one."""
    placed = []
    for s, a, b in pieces:
        first = min(s.places)[:2]
        placed += [(*first, p[2] + a, s.text[a:b]) for p in s.places if p[:2] == first]
    placed.sort(key=lambda p: p[:3])
    out: list[list] = []
    for doc, version, start, text in placed:
        if out and out[-1][:2] == [doc, version] and start <= out[-1][2] + len(out[-1][3]):
            last = out[-1]
            last[3] += text[max(0, last[2] + len(last[3]) - start):]
        else:
            out.append([doc, version, start, text])
    return [tuple(p) for p in out]


#: (id, version, start, end) of spans by level: repeated windows, shared passages
Spans = tuple[list[tuple[int, int, int, int]], list[tuple[int, int, int, int]]]


def _shard_spans(pieces: list[tuple[_Stretch, int, int]], sizes: Sizes) -> Spans:
    """The repeated windows and the shared passages of a shard's text."""
    regions = _merged_by_document(pieces)
    data = np.frombuffer(b"".join(r[3] + _MARK for r in regions), dtype=np.uint8)
    names: dict[tuple[int, int], int] = {}
    lengths = [len(r[3]) + 1 for r in regions]
    owner = np.repeat(np.array([names.setdefault(r[:2], len(names)) for r in regions]), lengths)
    base = np.concatenate(([0], np.cumsum(lengths)))
    out: Spans = ([], [])
    for level, (hit, size) in enumerate(zip(repeated_places(data, sizes.window, sizes.passage, owner), (sizes.window, sizes.passage))):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
        for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist()):
            k = int(np.searchsorted(base, a, side="right")) - 1
            doc, version, start, _ = regions[k]
            out[level].append((doc, version, start + a - int(base[k]), start + b - 1 - int(base[k]) + size))
    return out


def _in_shards(pieces: list[tuple[_Stretch, int, int]], size: int) -> Iterator[list]:
    """Pieces in runs of about `size` bytes, groups whole."""
    held, total = [], 0
    for k, (s, a, b) in enumerate(pieces):
        if total >= size and s.group != held[-1][0].group:
            yield held
            held, total = [], 0
        held.append((s, a, b))
        total += b - a
    if held:
        yield held


def _entries_of(split: list[_Stretch], sizes: Sizes, n_blocks: int) -> pa.RecordBatch:
    """Index entries of all windows, and of all passages, around the anchors of hashes that were dealt out; the last bit tells which."""
    hashes, more, document, starts, keys = [], [], [], [], []
    for s in split:
        values = byte_values(np.frombuffer(s.text, dtype=np.uint8))
        ordered = sorted(s.places)
        other = next((p for p in ordered if p[:2] != ordered[0][:2]), None)
        for level, size in enumerate((sizes.window, sizes.passage)):
            first, last = max(0, s.lead + sizes.seed - size), min(s.lead, len(s.text) - size)
            if first > last:
                continue
            own = run_hash(values, size, mixed=True)[first:last + 1]
            # a second place, or document, is enough to tell that it is repeated, as all places of repeated ones are known
            places = ordered[:2] if not level else ordered if other is None else [ordered[0], other]
            for doc, version, start in places:
                hashes.append(own)
                more.append(np.full(len(own), (s.group & 0x7FFF) << 1 | level, dtype=np.uint16))
                document.append(np.full(len(own), len(keys)))
                starts.append(np.arange(first, last + 1) + start)
                keys.append((doc, version))
    if not keys:
        return entry_rows(*[np.zeros(0, dtype=t) for t in (np.uint64, np.uint64, np.uint16, np.int64, np.int64, np.int64, np.int64)], n_blocks)
    ids, versions = (np.array(k, dtype=np.int64) for k in zip(*keys))
    return entry_rows(np.concatenate(hashes), *(np.concatenate(c) for c in (hashes, more, document, starts)), ids, versions, n_blocks)


def _shards(stretches: DataFrame, hot: dict[int, int], n: int, sizes: Sizes) -> DataFrame:
    """Spans found in the shards, and index entries of the hashes that were dealt out."""
    rows = stretches.repartition("seed", "part").sortWithinPartitions("seed", "part")

    def flush(spans: Spans, held: list[_Stretch], split: list[_Stretch]) -> Iterator[pa.RecordBatch]:
        if held:
            for shard in _in_shards(_cut_down(held, sizes), SHARD_BYTES):
                for own, found in zip(spans, _shard_spans(shard, sizes)):
                    own += found
        for level, own in enumerate(spans):
            if own:
                yield index_of_spans(span_rows(*(np.array(c, dtype=np.int64) for c in zip(*own)), n, level))
        if split:
            yield index_of_entries(_entries_of(split, sizes, n))

    def close(own: dict, key: int, spans: Spans, held: list[_Stretch], split: list[_Stretch]) -> int:
        """Takes a group's stretches over; gives the bytes that were added."""
        for s in own.values():
            if len(s.places) > 1:
                whole = [(doc, version, start, start + len(s.text)) for doc, version, start in s.places]
                if len(s.text) >= sizes.window:
                    spans[0].extend(whole)
                if len(s.text) >= sizes.passage and len({p[:2] for p in s.places}) > 1:
                    spans[1].extend(whole)
        added = 0
        if len(own) > 1:
            places = [p for s in own.values() for p in s.places]
            if len({p[:2] for p in places}) < len(places):
                for s in own.values():
                    s.tied = True
            held += own.values()
            added = sum(len(s.text) for s in own.values())
        if key in hot:
            split += own.values()
        return added

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, group, size = None, {}, 0, 0
        spans, held, split = ([], []), [], []
        for batch in batches:
            for at, part, doc, version, start, lead, text in zip(*[c.to_pylist() for c in batch.columns]):
                if (at, part) != key:
                    if own:
                        size += close(own, key[0], spans, held, split)
                    key, own, group = (at, part), {}, at & ((1 << 63) - 1)
                    if size >= HELD_BYTES or len(spans[0]) + len(spans[1]) > 200_000 or len(split) > 2000:
                        yield from flush(spans, held, split)
                        spans, held, split, size = ([], []), [], [], 0
                s = own.get((lead, text))
                if s is None:
                    s = own[lead, text] = _Stretch(text, lead, group)
                s.places.add((doc, version, start))
        if own:
            close(own, key[0], spans, held, split)
        yield from flush(spans, held, split)

    return rows.mapInArrow(run, INDEX)


def repeated_spans(keyed: DataFrame, window: int = WINDOW, passage: int | None = None) -> tuple[DataFrame, int]:
    """(spans, in bytes, their buckets); `keyed` is (id, version, text). Level 0: every run of `window` bytes that also starts elsewhere;
    level 1: every run of `passage` bytes that also starts in another document."""
    passage = min(PASSAGE, max(2, window // 2)) if passage is None else passage
    sizes = Sizes(window, passage, min(SEED, max(1, passage // 4)))
    bitmap, hot, occurrences = repeated(_seeds(keyed, sizes))
    n = buckets(keyed.sparkSession, occurrences)
    index = _shards(_stretches(keyed, bitmap, hot, sizes), hot, n, sizes)
    if not hot:
        return index.select(*[c.split()[0] for c in SPANS.split(", ")]), n

    def repeats(keys: list[np.ndarray], place: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for level, (size, apart) in enumerate(((sizes.window, place), (sizes.passage, place[:2]))):
            of = np.flatnonzero((keys[1] & 1) == level)
            order, flags = elsewhere([k[of] for k in keys], [p[of] for p in apart])
            found = of[order[flags]]
            out.append((found, place[2][found] + size))
        return out

    return matched_entries(index, repeats, n, batches_matched=False), n


def _whole(data: bytes, spans: tuple[np.ndarray, np.ndarray], copied: bool, least: int) -> list[tuple[int, int]]:
    """The spans of a document; one that has a copy is one span, if it is long enough to be any."""
    if copied and len(data) >= least:
        return [(0, len(data))]
    return list(zip(*[x.tolist() for x in spans]))


def dedup(docs: DataFrame, window: int = WINDOW, passage: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, and n_shared, the bytes in passages that other documents hold too."""
    least = min(PASSAGE, max(2, window // 2)) if passage is None else passage

    def kept(text: str, spans: list, copied: bool) -> tuple[int, int, int, str, int]:
        data = text.encode("utf-8", "surrogatepass")
        gone, shared = _whole(data, spans[0], copied, window), _whole(data, spans[1], copied, least)
        digest, done = hashlib.sha256(), 0
        for a, b in gone:
            digest.update(data[done:a])
            done = b
        digest.update(data[done:])
        return len(data), sum(b - a for a, b in gone), len(gone), digest.hexdigest(), sum(b - a for a, b in shared)

    keyed = document_key(docs)
    columns = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, n_shared bigint"
    return with_spans(keyed, *repeated_spans(keyed, window, passage), kept, columns, first_too=True, levels=2)


def removed(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id and `rest`, the bytes that are left; a cut may fall inside a character."""

    def rest(text: str, spans: list, copied: bool) -> tuple[bytes]:
        data = text.encode("utf-8", "surrogatepass")
        edges = [0, *[x for span in _whole(data, spans[0], copied, window) for x in span], len(data)]
        return (b"".join(data[a:b] for a, b in zip(edges[0::2], edges[1::2])),)

    keyed = document_key(docs)
    return with_spans(keyed, *repeated_spans(keyed, window), rest, "rest binary", first_too=True, levels=2)
