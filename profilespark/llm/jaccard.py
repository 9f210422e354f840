"""N-gram Jaccard join: MinHash banding finds candidates, full shingle sets decide.

1. Every text becomes the set of its word 5-grams. Texts with equal sets are one node, so copies never multiply.
2. A node has BANDS x ROWS MinHash values; the numbers are chosen for a recall of 0.9999 at a similarity of 0.8.
   Nodes are shuffled on their band hashes; a bucket is the nodes that share one.
3. Of a bucket with at most SMALL nodes, candidate pairs are listed; a pair that several buckets hold is kept once, in
   its smallest bucket, and each node's set goes there once. A larger bucket is dealt into blocks, and every two
   blocks meet in a group of bounded size, which counts links and returns a spanning forest, never its pairs.
4. Links make connected components; all copies of the nodes of a component are one class.

Sets are computed again, from the texts, only for nodes in some bucket: a bitmap of at most BITMAP_BITS bits tells the
second pass which ones; what it lets through by mistake costs bytes, not results. Shuffled rows are bounded by
documents x bands; nothing but the bitmap and counts reaches the driver.

A text of one to four words is one shingle of them all. A text without words has no shingles: it links with nothing and
is its own class. Rows with equal ids and texts are copies. Nodes are 64-bit hashes of sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilespark.functions.clean import quoted
from profilespark.llm.anchors import bitmap_of
from profilespark.llm.components import components
from profilespark.llm.text import Words, chunks, encoded, free_names, inside, mix, run_hash, sliced
from profilespark.session import materialize

SHINGLE = 5
#: similarity as a fraction, so that the decision is exact
SIMILAR = (4, 5)
RECALL = 0.9999
SMALL = 32
BLOCK_NODES, BLOCK_SHINGLES = 512, 400_000
BITMAP_BITS = 1 << 27
_NO_ID = -(1 << 63)


def banding(similarity: float, recall: float, hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): as many rows as reach the recall with at most so many hashes, then as few bands as do."""
    for rows in range(hashes, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)) if similarity < 1 else 1
        if bands * rows <= hashes:
            return bands, rows
    return hashes, 1


BANDS, ROWS = banding(SIMILAR[0] / SIMILAR[1], RECALL)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for a, b in chunks(texts):
        words = Words(texts[a:b])
        at = inside(words.first, size)
        runs = run_hash(words.hash, size)[at] if len(at) else np.zeros(0, dtype=np.uint64)
        cut = np.searchsorted(at, words.first)
        for d in range(b - a):
            n = words.first[d + 1] - words.first[d]
            if n >= size:
                yield np.unique(runs[cut[d]:cut[d + 1]])
            elif n:
                yield run_hash(words.hash[words.first[d]:words.first[d + 1]], n)
            else:
                yield np.zeros(0, dtype=np.uint64)


def node_of(shingles: np.ndarray) -> int:
    return int(mix(np.array([mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))]))[0].view(np.int64))


_HASHES = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)).reshape(2, -1)


def band_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, BANDS): a hash of the band's number and its MinHash values; sets must not be empty."""
    values = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.zeros((len(sets), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(sets), band + 1, dtype=np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            key = mix(key + np.minimum.reduceat((values ^ _HASHES[1, k]) * (_HASHES[0, k] | np.uint64(1)), starts))
        out[:, band] = key
    return out.view(np.int64)


def _groups(sets: Iterator[np.ndarray], most: int = 100_000) -> Iterator[list[np.ndarray]]:
    """Runs of sets of about `most` values together, so that arrays stay in a processor's cache."""
    held, size = [], 0
    for one in sets:
        held.append(one)
        size += len(one)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, version, node, shingles, bands) per document; `node` is null for a text without words, `version` a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            nodes, sizes, bands = [], [], []
            for sets in _groups(shingle_sets(encoded(batch.column(1).to_pylist()))):
                full = [s for s in sets if len(s)]
                hashes = iter(band_hashes(full).tolist() if full else [])
                nodes += [node_of(s) if len(s) else None for s in sets]
                sizes += [len(s) for s in sets]
                bands += [next(hashes) if len(s) else None for s in sets]
            arrays = [batch.column(0), batch.column(2), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "version", "node", "shingles", "bands"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("version"))
    return rows.mapInArrow(run, "id bigint, version bigint, node bigint, shingles bigint, bands array<bigint>")


def _mark(node: np.ndarray, first_id: np.ndarray, bits: int) -> np.ndarray:
    """The place of a node's first document in the bitmap."""
    return (mix(node.view(np.uint64) + mix(first_id.view(np.uint64))) % np.uint64(bits)).astype(np.int64)


def _bitmap(wanted: DataFrame) -> np.ndarray:
    """Bits of the nodes whose sets are needed, from (node, first_id); 16 bits a node up to the bound."""
    bits = min(BITMAP_BITS, max(1 << 12, 32 * (wanted.count() // 2 + 1)))

    @F.pandas_udf("bigint")
    def place(node: pd.Series, first_id: pd.Series) -> pd.Series:
        return pd.Series(_mark(node.to_numpy(dtype=np.int64), first_id.to_numpy(dtype=np.int64), bits))

    return bitmap_of(wanted.select(place("node", "first_id").alias("bit")), bits)


def _sets(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """(node, shingles as bytes) of every marked node, from its first document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            nodes, sets = [], []
            ids = [_NO_ID if i is None else i for i in batch.column(0).to_pylist()]
            at = 0
            for group in _groups(shingle_sets(encoded(batch.column(1).to_pylist()))):
                node = np.array([node_of(s) for s in group], dtype=np.int64)
                bit = _mark(node, np.array(ids[at:at + len(group)], dtype=np.int64), 32 * len(bitmap))
                at += len(group)
                hit = (bitmap[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1
                for k in np.flatnonzero(hit):
                    nodes.append(int(node[k]))
                    sets.append(group[k].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["node", "set"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").mapInArrow(run, "node bigint, set binary")
    return rows.groupBy("node").agg(F.first("set").alias("set"))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity."""
    least, most = sorted((len(a), len(b)))
    if not least or SIMILAR[1] * least < SIMILAR[0] * most:
        return False
    common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return SIMILAR[1] * common >= SIMILAR[0] * (len(a) + len(b) - common)


def _small_links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of the pairs (cell, a, b) that reach the similarity; a set goes to each cell once."""
    needed = pairs.select("cell", F.explode(F.array("a", "b")).alias("node")).distinct()
    sent = needed.join(sets, "node").select("cell", F.col("node").alias("a"), F.lit(None).cast("bigint").alias("b"), "set")
    asked = pairs.select("cell", "a", "b", F.lit(None).cast("binary").alias("set"))
    rows = sent.unionByName(asked).repartition("cell").sortWithinPartitions("cell", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, known = None, {}
        for batch in sliced(batches, 3):
            left, right = [], []
            for c, a, b, values in zip(*[x.to_pylist() for x in batch.columns]):
                if c != cell:
                    cell, known = c, {}
                if b is None:
                    known[a] = np.frombuffer(values, dtype=np.uint64)
                elif similar(known[a], known[b]):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of every left with every right set."""
    out = np.zeros((len(left), len(right)))
    rows_l, rows_r = (np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (left, right))
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    at_l, at_r = (np.searchsorted(both, np.concatenate(s)) for s in (left, right))
    ok_l, ok_r = (both[np.minimum(at, len(both) - 1)] == np.concatenate(s) if len(both) else np.zeros(len(at), bool)
                  for at, s in ((at_l, left), (at_r, right)))
    rows_l, at_l, rows_r, at_r = rows_l[ok_l], at_l[ok_l], rows_r[ok_r], at_r[ok_r]
    for start in range(0, len(both), columns):
        sides = []
        for rows, at, n in ((rows_l, at_l, len(left)), (rows_r, at_r, len(right))):
            here = (at >= start) & (at < start + columns)
            side = np.zeros((n, columns), dtype=np.float32)
            side[rows[here], at[here] - start] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def _forest(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges that keep the nodes connected as the links do: every node to the smallest it can reach."""
    label_l, label_r = left.copy(), right.copy()
    big = np.iinfo(np.int64).max
    while True:
        new_l = np.minimum(label_l, np.where(links, label_r[None, :], big).min(axis=1, initial=big))
        new_r = np.minimum(label_r, np.where(links, new_l[:, None], big).min(axis=0, initial=big))
        if (new_l == label_l).all() and (new_r == label_r).all():
            break
        label_l, label_r = new_l, new_r
    ends = {(int(n), int(m)) for n, m in zip(np.concatenate((left, right)), np.concatenate((label_l, label_r))) if n != m}
    return sorted(ends)


def _block_pair(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links between two blocks of a bucket: (a, b) forest edges with n = 0, and (a, null) counts n."""
    bucket, i, j = pdf["bucket"].iloc[0], pdf["i"].iloc[0], pdf["j"].iloc[0]
    sides = [pdf[pdf["block"] == x].drop_duplicates("node").reset_index(drop=True) for x in (i, j)]
    sets = [[np.frombuffer(s, dtype=np.uint64) for s in side["set"]] for side in sides]
    nodes = [side["node"].to_numpy(dtype=np.int64) for side in sides]
    if not len(nodes[0]) or not len(nodes[1]):
        return pd.DataFrame({"a": [], "b": [], "n": []})
    common = _overlaps(*sets)
    sizes = [np.array([len(s) for s in side]) for side in sets]
    links = SIMILAR[1] * common >= SIMILAR[0] * (sizes[0][:, None] + sizes[1][None, :] - common)
    # a pair counts in the smallest large bucket that both are in
    width = max(len(h) for side in sides for h in side["large"])
    large = [np.array([np.pad(np.sort(h), (0, width - len(h)), constant_values=fill) for h in side["large"]])
             for side, fill in zip(sides, (np.iinfo(np.int64).min, np.iinfo(np.int64).max))]
    for x in range(width):
        for y in range(width):
            smaller = (large[0][:, None, x] == large[1][None, :, y]) & (large[0][:, None, x] < bucket)
            links &= ~smaller
    if i == j:
        np.fill_diagonal(links, False)
    edges = _forest(links, nodes[0], nodes[1])
    counts = list(zip(nodes[0].tolist(), links.sum(axis=1).tolist()))
    if i != j:
        counts += zip(nodes[1].tolist(), links.sum(axis=0).tolist())
    rows = [(a, b, 0) for a, b in edges] + [(a, None, n) for a, n in counts if n]
    return pd.DataFrame({"a": pd.array([r[0] for r in rows], dtype="Int64"), "b": pd.array([r[1] for r in rows], dtype="Int64"),
                         "n": pd.array([r[2] for r in rows], dtype="Int64")})


def _large_links(large: DataFrame, lists: DataFrame, sets: DataFrame) -> DataFrame:
    """Forest edges and counts of the large buckets; every two blocks of a bucket meet in one group."""
    dealt = large.withColumn("blocks", F.ceil(F.greatest(F.col("n") / BLOCK_NODES, F.col("weight") / BLOCK_SHINGLES)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node", "bucket"), "blocks"))
    meet = F.expr("transform(sequence(cast(0 as bigint), blocks - 1), x -> struct(least(x, block) as i, greatest(x, block) as j))")
    dealt = dealt.withColumn("meet", F.explode(meet)).select("bucket", "node", "block", "meet.i", "meet.j")
    # of a block pair, the sets of both sides; the node's own large buckets tell where a pair counts
    rows = dealt.join(sets.join(lists, "node"), "node")
    return rows.groupBy("bucket", "i", "j").applyInPandas(_block_pair, "a bigint, b bigint, n bigint")


def _classified(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with id, version and node; nodes with first_id, n_copies, n_links and the component they are in)."""
    rows = materialize(signatures(docs))
    key = F.coalesce("id", F.lit(_NO_ID))
    nodes = rows.filter("node is not null").groupBy("node").agg(
        F.min(key).alias("first_id"), F.count(F.lit(1)).alias("n_copies"), F.first("bands").alias("bands"), F.max("shingles").alias("shingles"))
    nodes = materialize(nodes)
    placed = nodes.select("node", "shingles", F.explode("bands").alias("bucket"))
    buckets = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("shingles").alias("weight")).filter("n > 1")
    members = materialize(placed.drop("shingles").join(buckets, "bucket"))
    large = members.filter(F.col("n") > SMALL)
    lists = materialize(large.groupBy("node").agg(F.collect_set("bucket").alias("large")))  # at most BANDS each

    listed = members.filter(F.col("n") <= SMALL).groupBy("bucket").agg(F.array_sort(F.collect_list("node")).alias("nodes"))
    two = F.expr("flatten(transform(nodes, (x, i) -> transform(slice(nodes, i + 2, size(nodes)), y -> struct(x as a, y as b))))")
    pairs = listed.select("bucket", F.explode(two).alias("p")).groupBy("p.a", "p.b").agg(F.min("bucket").alias("cell"))
    large_a, large_b = (lists.select(F.col("node").alias(c), F.col("large").alias(f"large_{c}")) for c in "ab")
    pairs = pairs.join(large_a, "a", "left").join(large_b, "b", "left").filter(
        "large_a is null or large_b is null or not arrays_overlap(large_a, large_b)")
    pairs = materialize(pairs.select("cell", "a", "b"))

    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(lists.select("node")).distinct()
    wanted = materialize(nodes.join(needed, "node", "left_semi").select("node", "first_id"))
    sets = materialize(_sets(docs, _bitmap(wanted)))

    links = materialize(_small_links(pairs, sets))
    blocks = materialize(_large_links(large.select("bucket", "node", "n", "weight"), lists, sets))
    edges = links.unionByName(blocks.filter("b is not null").select("a", "b"))
    counts = links.select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).cast("bigint").alias("n")).unionByName(
        blocks.filter("b is null").select(F.col("a").alias("node"), "n")).groupBy("node").agg(F.sum("n").alias("n_links"))
    found = components(edges)
    named = nodes.select("node", "first_id", "n_copies").join(found, "node", "left").join(counts, "node", "left")
    return rows, named.withColumns({"component": F.coalesce("component", "node"), "n_links": F.coalesce("n_links", F.lit(0))})


def join(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies): a class is named by its smallest id; links are with other texts."""
    rows, named = _classified(docs)
    least = named.groupBy("component").agg(F.min("first_id").alias("class_id"))
    by_node = named.join(least, "component").select("node", "class_id", "n_copies", "n_links")
    own = rows.select("id", "node").join(by_node, "node", "left")
    none = F.lit(None).cast("bigint")
    return own.select(
        F.col("id").alias("doc_id"),
        F.when(F.col("node").isNull(), F.col("id")).when(F.col("class_id") == _NO_ID, none).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row, columns unchanged, of each class of near duplicates: the smallest by id, then by a hash of the text.

    A row's key is its id and the hash of its text, so rows that share an id are told apart, and a class whose rows have
    no id is reduced like any other (a null id comes last). Of rows equal in id and text one stays, whatever its other columns.
    Rows without words are near duplicates of nothing; of those, too, equal ones are one row.
    """
    own = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    rows, named = _classified(own)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "version")
    # of each set of shingles its first row, then of each class: however many copies, a task passes on one row of them
    firsts = rows.filter("node is not null").groupBy("node").agg(F.min(order).alias("first"))
    chosen = firsts.join(named.select("node", "component"), "node").groupBy("component").agg(F.min("first").alias("first")).select("first.id", "first.version")
    chosen = chosen.unionByName(rows.filter("node is null").select("id", "version").distinct())
    version, kept_id, kept_version = free_names(docs.columns, "version", "kept_id", "kept_version")
    keyed = docs.withColumn(version, F.xxhash64(docs[text_col]))
    kept = chosen.select(F.col("id").alias(kept_id), F.col("version").alias(kept_version))
    both = F.col(quoted(id_col)).cast("bigint").eqNullSafe(F.col(kept_id)) & (F.col(version) == F.col(kept_version))
    left = keyed.join(kept, both, "left_semi").dropDuplicates([id_col, version])
    return left.select(*[quoted(c) for c in docs.columns])
