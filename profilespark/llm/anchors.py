"""Anchors: content-chosen places that every long enough repeat shares.

Over a sequence (bytes or words), every window of `window` values has the place whose run of `seed` values hashes
lowest. Two equal windows choose the same run, so a repeat of that length meets its other occurrence at an anchor with the same
hash, and only hashes that occur more than once need a closer look. About 2 / (window - seed) of all places
are anchors; of runs of equal hashes, as many as leave no window without one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from profilespark.session import materialize

#: bound on the bitmap that tells tasks which hashes are repeated; a false hit costs bytes, not results
BITMAP_BITS = 1 << 27
#: a hash with more than this share of all anchors is dealt out by document; so there are at most as many of them
HOT_SHARE = 1 / 4096
HOT_LEAST = 1024


def slide(values: np.ndarray, width: int, lower: bool) -> np.ndarray:
    """Minimum (or maximum) of every `width` consecutive values, by doubling."""
    pick = np.minimum if lower else np.maximum
    out, size = values, 1
    while size * 2 <= width:
        out = pick(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return pick(out[:-rest], out[rest:]) if rest else out


def anchors(hashes: np.ndarray, width: int, offsets: np.ndarray) -> np.ndarray:
    """Places of the lowest hash of every `width` consecutive ones; of ties, enough to leave out no window.

    Documents start at `offsets`; windows that reach over the end of one only add places.
    """
    if len(hashes) < width:
        return np.zeros(0, dtype=np.int64)
    lowest = slide(hashes, width, True)
    edge = np.zeros(width - 1, dtype=hashes.dtype)
    places = np.flatnonzero(slide(np.concatenate((edge, lowest, edge)), width, False) == hashes)
    values = hashes[places]
    document = np.searchsorted(offsets, places, side="right")
    same = (values[1:] == values[:-1]) & (document[1:] == document[:-1])
    keep = np.ones(len(places), dtype=bool)
    runs = np.flatnonzero(np.concatenate(([True], ~same, [True])))
    for r in np.flatnonzero(np.diff(runs) > 2):  # first and last stay, and between them no gap of more than the width
        a, b = runs[r], runs[r + 1]
        last = places[a]
        for x in range(a + 1, b - 1):
            if places[x + 1] - last <= width:
                keep[x] = False
            else:
                last = places[x]
    return places[keep]


#: bits in one piece of a bitmap: 32 KB, so that the driver gets a few hundred rows at most, never one per word
PIECE_BITS = 1 << 18


def bitmap_of(places: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of `bits` bits with those of a column `bit` set; its pieces are made in tasks, and the driver only joins their bytes."""

    def piece(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        bit = rows["bit"].to_numpy() - key[0].as_py() * PIECE_BITS
        own = np.zeros(min(PIECE_BITS, bits), dtype=np.uint8)
        own[bit] = 1
        return pa.table({"piece": [key[0].as_py()], "set": pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())})

    rows = places.select("bit", F.floor(F.col("bit") / PIECE_BITS).alias("piece")).groupBy("piece").applyInArrow(piece, "piece bigint, set binary")
    whole = np.zeros(-(-bits // PIECE_BITS) * PIECE_BITS // 8, dtype=np.uint8)
    for row in rows.collect():
        own = np.frombuffer(row["set"], dtype=np.uint8)
        at = row["piece"] * PIECE_BITS // 8
        whole[at:at + len(own)] = own
    return whole.view("<u4")[:bits // 32].copy()


def repeated(seeds: DataFrame, hot_share: float = HOT_SHARE) -> tuple[np.ndarray, dict[int, int], int]:
    """(bitmap of the hashes that occur more than once, parts to deal each hot hash into, their occurrences) from (seed, n) rows."""
    counts = materialize(seeds.groupBy("seed").agg(F.sum("n").alias("n")).filter("n > 1"))
    distinct, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    bits = min(BITMAP_BITS, max(1 << 12, 32 * (distinct // 2 + 1)))
    most = max(HOT_LEAST, hot_share * total)
    hot = counts.filter(F.col("n") > most).select("seed", F.ceil(F.col("n") / most).alias("parts")).collect()
    bitmap = bitmap_of(counts.select(F.pmod("seed", F.lit(bits)).alias("bit")), bits)
    return bitmap, {r["seed"]: int(r["parts"]) for r in hot}, int(total)


def marked(bitmap: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Whether each hash may be repeated."""
    bit = np.mod(seeds.view(np.int64), 32 * len(bitmap))
    return ((bitmap[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1).astype(bool)


def part_of(seeds: np.ndarray, document: np.ndarray, hot: dict[int, int]) -> np.ndarray:
    """The part of a hot hash that a document belongs to; 0 for other hashes."""
    if not hot:
        return np.zeros(len(seeds), dtype=np.int64)
    keys = np.array(sorted(hot), dtype=np.int64)
    parts = np.array([hot[k] for k in sorted(hot)], dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, seeds.view(np.int64)), len(keys) - 1)
    n = np.where(keys[at] == seeds.view(np.int64), parts[at], 1)
    return np.mod(document, n)


def document_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, version, text): a null id comes first, a null text is empty. Rows equal in id and text are told apart by `with_spans`."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text).alias("version"), text.alias("text"))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals, as sorted ones that don't touch."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > reach[:-1]))
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


#: occurrences of repeated anchors that one bucket of documents, or block of entries, stands for at most, about
BUCKET_ANCHORS = 500_000


def buckets(spark: SparkSession, occurrences: int) -> int:
    """Number of pieces that documents, and hashes of entries, are dealt into.

    A task holds what belongs to one of them at a time, so they are as many as the repeated anchors ask for; never fewer than shuffle partitions.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-occurrences // BUCKET_ANCHORS))


#: spans of several kinds, by `level`, may lie side by side
SPANS = "bucket int, level int, ids binary, versions binary, starts binary, ends binary"
#: rows of an index: either packed entries of a block, or spans already found, which stand in the block of their bucket
INDEX = f"block int, n bigint, entries binary, {SPANS}"
_INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]


def index_of_spans(rows: pa.RecordBatch) -> pa.RecordBatch:
    none = [pa.nulls(len(rows), kind) for kind in (pa.int64(), pa.binary())]
    return pa.RecordBatch.from_arrays([rows.column(0), *none, *rows.columns], _INDEX_NAMES)


def index_of_entries(rows: pa.RecordBatch) -> pa.RecordBatch:
    none = [pa.nulls(len(rows), kind) for kind in (pa.int32(), pa.int32(), *[pa.binary()] * 4)]
    return pa.RecordBatch.from_arrays([*rows.columns, *none], _INDEX_NAMES)


def span_rows(ids: np.ndarray, versions: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int, level: int = 0) -> pa.RecordBatch:
    """Spans of one level of many documents as one row for each bucket that they fall into; those that meet are one."""
    place = np.mod(ids ^ versions, n)
    order = np.lexsort((starts, versions, ids, place))
    place, ids, versions, starts, ends = (a[order] for a in (place, ids, versions, starts, ends))
    # a running maximum within each document, by way of one that documents can't reach over
    new = np.concatenate(([True], (ids[1:] != ids[:-1]) | (versions[1:] != versions[:-1]))) if len(ids) else np.zeros(0, dtype=bool)
    lift = np.cumsum(new) * (int(ends.max(initial=0)) + 1)
    reach = np.maximum.accumulate(ends + lift) - lift
    new[1:] |= starts[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(new)) - 1
    place, columns = place[first], [a.astype(np.int64) for a in (ids[first], versions[first], starts[first], reach[last])]
    cuts = np.flatnonzero(np.diff(place, prepend=-1))
    ends_at = np.append(cuts[1:], len(place))
    packed = [pa.array([zstandard.compress(c[a:b].tobytes(), 1) for a, b in zip(cuts, ends_at)], pa.binary()) for c in columns]
    columns = [pa.array(place[cuts], pa.int32()), pa.array(np.full(len(cuts), level, dtype=np.int32)), *packed]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "level", "ids", "versions", "starts", "ends"])


def with_spans(docs: DataFrame, spans: DataFrame, n: int, function: Callable, columns: str, first_too: bool, levels: int = 1) -> DataFrame:
    """One row per document: doc_id and what function(text, [(starts, ends) of each level], copied) gives for its merged spans.

    `docs` are (id, version, text); `spans` have the columns of SPANS, in `n` buckets. Each text moves once, to its
    bucket, where the bucket's spans come first. Rows equal in id and text follow each other there: each of them but the
    first is `copied`, and with `first_too` the first as well if another follows.
    """
    nothing = {c: F.lit(None).cast("binary").alias(c) for c in ("ids", "versions", "starts", "ends")}
    own = docs.select(F.pmod(F.col("id").bitwiseXOR(F.col("version")), F.lit(n)).cast("int").alias("bucket"), "id", "version", "text", F.lit(None).cast("int").alias("level"), *nothing.values())
    none = F.lit(None).cast("bigint")
    given = spans.select("bucket", none.alias("id"), none.alias("version"), F.lit(None).cast("string").alias("text"), "level", *nothing)
    rows = own.unionByName(given).repartition("bucket").sortWithinPartitions("bucket", F.col("text").isNotNull(), "id", "version")
    added = StructType.fromDDL(columns)
    schema = StructType.fromDDL(f"doc_id bigint, {columns}")
    kinds = [f.type for f in to_arrow_schema(added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts, known = None, [[] for _ in range(levels)], None
        held = None  # the last document, until it is clear whether a copy of it follows
        ids, out = [], []

        def done(copy_follows: bool) -> None:
            key, text, own, is_copy = held
            ids.append(None if key[0] == -(1 << 63) else key[0])
            out.append(function(text, own, is_copy or (first_too and copy_follows)))

        def made() -> pa.RecordBatch:
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*out), kinds, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *arrays], schema.fieldNames())

        for batch in batches:
            for at, doc, version, text, level, *packed in zip(*[c.to_pylist() for c in batch.columns]):
                if at != bucket:
                    bucket, parts, known = at, [[] for _ in range(levels)], None
                if text is None:
                    parts[level].append([np.frombuffer(zstandard.decompress(p), dtype=np.int64) for p in packed])
                    continue
                if known is None:
                    known = [_by_document(p) for p in parts]
                    parts = []
                is_copy = held is not None and held[0] == (doc, version)
                if held is not None:
                    done(is_copy)
                held = ((doc, version), text, [merged(*k.get((doc, version), _NO_SPANS)) for k in known], is_copy)
            if out:
                yield made()
                ids.clear()
                out.clear()
        if held is not None:
            done(False)
            yield made()

    return rows.mapInArrow(run, schema)


_NO_SPANS = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))


def _by_document(parts: list) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    if not parts:
        return {}
    ids, versions, starts, ends = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((starts, versions, ids))
    ids, versions, starts, ends = ids[order], versions[order], starts[order], ends[order]
    new = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (versions[1:] != versions[:-1]))))
    return {(int(ids[a]), int(versions[a])): (starts[a:b], ends[a:b]) for a, b in zip(new, np.append(new[1:], len(ids)))}


def _groups(keys: list[np.ndarray], place: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by keys, then place; where a group of equal keys starts; whether the place moves on within a group)."""
    order = np.lexsort((*place[::-1], *keys[::-1]))
    same, moved = np.ones(len(order) - 1, dtype=bool), np.zeros(len(order) - 1, dtype=bool)
    for key in keys:
        same &= key[order[1:]] == key[order[:-1]]
    for p in place:
        moved |= p[order[1:]] != p[order[:-1]]
    return order, np.flatnonzero(np.concatenate(([True], ~same))), np.concatenate(([False], same & moved))


def elsewhere(keys: list[np.ndarray], place: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, flags in that order): flagged if an equal key has another place."""
    if not len(keys[0]):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    order, start, moved = _groups(keys, place)
    return order, np.repeat(np.logical_or.reduceat(moved, start), np.diff(np.append(start, len(order))))


def entry_rows(
    by: np.ndarray, hashes: np.ndarray, more: np.ndarray, document: np.ndarray, start: np.ndarray, ids: np.ndarray, versions: np.ndarray, n_blocks: int
) -> pa.RecordBatch:
    """Index entries as one packed row (block, n, entries) for each block; `by` says which, `document` is a place in ids and versions."""
    block = (by % np.uint64(n_blocks)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    block = block[order]
    cuts = np.flatnonzero(np.diff(block, prepend=-1))
    sizes, entries = [], []
    for a, b in zip(cuts, np.append(cuts[1:], len(block))):
        x = order[a:b]
        used, own = np.unique(document[x], return_inverse=True)
        arrays = [np.array([len(used)], dtype=np.int64), ids[used], versions[used], hashes[x], more[x], own.astype(np.int32), start[x].astype(np.int32)]
        sizes.append(b - a)
        entries.append(zstandard.compress(b"".join(v.tobytes() for v in arrays), 1))
    return pa.RecordBatch.from_arrays(
        [pa.array(block[cuts], pa.int32()), pa.array(sizes, pa.int64()), pa.array(entries, pa.binary())], ["block", "n", "entries"])


def _entries(n: int, packed: bytes) -> tuple[np.ndarray, ...]:
    data = zstandard.decompress(packed)
    documents = int(np.frombuffer(data, np.int64, 1)[0])
    out, at = [], 8
    for kind, size in ((np.int64, documents), (np.int64, documents), (np.uint64, n), (np.uint16, n), (np.int32, n), (np.int32, n)):
        out.append(np.frombuffer(data, kind, size, at))
        at += size * np.dtype(kind).itemsize
    ids, versions, hashes, more, own, start = out
    return hashes, more, ids[own], versions[own], start.astype(np.int64)


def matched_entries(index: DataFrame, decide: Callable, n_buckets: int, batches_matched: bool) -> DataFrame:
    """Spans that `decide` finds, block by block. Rows of spans pass through.

    decide([hashes, more], [ids, versions, start]) gives (entries, ends) for each level: where spans begin, and the ends of these spans.
    batches_matched: entries of one batch have been matched with each other, so a block that has no other needs no look.
    """
    rows = index.repartition("block").sortWithinPartitions("block")

    def done(held: list) -> Iterator[pa.RecordBatch]:
        if len(held) > batches_matched:
            hashes, more, ids, versions, start = (np.concatenate(c) for c in zip(*[_entries(n, e) for n, e in held]))
            for level, (x, ends) in enumerate(decide([hashes, more], [ids, versions, start])):
                if len(x):
                    yield span_rows(ids[x], versions[x], start[x], ends, n_buckets, level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []
        for batch in batches:
            is_span = pa.compute.is_valid(batch.column(3))
            yield pa.RecordBatch.from_arrays(batch.filter(is_span).columns[3:], [c.split()[0] for c in SPANS.split(", ")])
            for b, n, entries in zip(*[c.to_pylist() for c in batch.filter(pa.compute.invert(is_span)).columns[:3]]):
                if b != block:
                    yield from done(held)
                    block, held = b, []
                held.append((n, entries))
        yield from done(held)

    return rows.mapInArrow(run, SPANS)
