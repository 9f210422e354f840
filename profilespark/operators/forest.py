"""Random forests on all labelled rows: one tree is one row of a Spark job.

Rows are binned where they lie, a byte for each cell, and ordered by a hash of their id. A table of at most SHARED_CELLS cells goes to every
worker once; a larger one is sent to each task that grows trees. Trees are grown in parallel, each from the seed and its own number
alone, and come back as one row each. They stay a table: only a forest of at most SHARED_NODES nodes is read by the driver and goes to
every worker. Of a larger one, groups of trees and blocks of distinct binned points meet in tasks, which pass on sums of label shares.

A node's split depends on nothing but its own rows and its path from the root. So the first trees of a forest are the
smaller forest, and trees cut at a depth are the trees grown to that depth: one fit serves every setting that differs in these
two, and only the smallest leaf asks for another one.

Each tree draws as many rows as the table has, with replacement. A node tries a random part of the columns, as many as the root of their
number, and all of them if none of these splits it; splits lie between the values of a column, or between quantiles where it has
more than BINS values, and keep the least Gini impurity. A forest's probabilities are the means of its leaves' label shares.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from profilespark.functions.clean import quoted
from profilespark.operators.ordered import running_totals, seeded_hash
from profilespark.session import materialize

# task functions travel by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: binned cells that go to every worker, and nodes of a forest that do
SHARED_CELLS = 1 << 25
SHARED_NODES = 1 << 19
BINS = 255
TREES_PER_TASK = 4
#: rows of one block of the binned table
BLOCK_ROWS = 1 << 16
#: (row, tree) pairs that are scored at a time
PAIRS = 1 << 20
#: where a forest is larger: nodes that meet points in one task, points of one block, and sums that a task passes on
GROUP_NODES = 1 << 19
POINT_ROWS = 1 << 12
GROUP_SUMS = 1 << 21

TREE = "leaf int, tree int, feature array<int>, threshold array<double>, below array<int>, depth array<int>, counts array<float>"
_TREE_NAMES = [c.split()[0] for c in TREE.split(", ")]


@dataclass
class Sample:
    """Labelled rows, binned: `bins[i, f]` is how many of the column's edges lie below the value."""

    bins: np.ndarray
    edges: list[np.ndarray]
    label: np.ndarray
    classes: int
    shared: Broadcast | None = field(default=None, repr=False, compare=False)

    def on_workers(self, spark: SparkSession) -> Broadcast:
        if self.shared is None:
            self.shared = spark.sparkContext.broadcast(Sample(self.bins, self.edges, self.label, self.classes))  # bounded by SHARED_CELLS
        return self.shared

    @classmethod
    def of(cls, blocks: pa.Table, edges: list[np.ndarray], classes: int) -> "Sample":
        """From rows of BLOCK in any order."""
        blocks = blocks.sort_by([("part", "ascending"), ("number", "ascending")])
        label = np.frombuffer(b"".join(v.as_buffer() for v in blocks["label"]), dtype=np.int32)
        bins = np.frombuffer(b"".join(v.as_buffer() for v in blocks["bins"]), dtype=np.uint8)
        return cls(bins.reshape(len(label), len(edges)), edges, label.astype(np.int64), classes)


@dataclass
class Spread:
    """Labelled rows, binned, as a written table of BLOCK: more than goes to every worker."""

    blocks: DataFrame
    edges: list[np.ndarray]
    classes: int


BLOCK = "part int, number int, label binary, bins binary"


def bounded(vectors: DataFrame, target: str, row_id: str, limit: int, seed: int) -> DataFrame:
    """At most `limit` rows, of each label in proportion: the first ones by a hash of the id."""
    hashed = vectors.withColumn("_h", seeded_hash(seed, F.col(quoted(row_id))))
    sizes = {r[0]: r[1] for r in vectors.groupBy(target).count().collect() if r[0] is not None}  # one row a label
    total = sum(sizes.values())
    if total <= limit:
        return hashed.filter(F.col(quoted(target)).isNotNull())
    quota = F.create_map(*[F.lit(v) for label, n in sizes.items() for v in (label, max(1, n * limit // total))])
    order = Window.partitionBy(target).orderBy("_h")
    # each task passes on at most a label's quota, as the rank is bounded
    ranked = hashed.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= max(1, limit))
    return ranked.filter(F.col("_r") <= quota[F.col(quoted(target))]).drop("_r")


def sample(vectors: DataFrame, target: str, row_id: str, classes: Sequence[str], seed: int, vector: str = "features",
           rows: int | None = None) -> Sample | Spread:
    """All labelled rows of (row id, target, vector), in hash order, or with `rows` at most so many, of each label in proportion."""
    first = vectors.select(F.size(vector_to_array(vector))).first()
    width = first[0] if first else 0
    vectors = vectors.select(row_id, target, vector)
    if rows is None:
        chosen = vectors.withColumn("_h", seeded_hash(seed, F.col(quoted(row_id)))).filter(F.col(quoted(target)).isNotNull())
    else:
        chosen = bounded(vectors, target, row_id, max(1, rows), seed)
    place = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(quoted(target))) - 1
    chosen = chosen.select("_h", F.col(quoted(row_id)).alias("_id"), place.cast("int").alias("label"), vector_to_array(vector).alias("x"))
    n, edges = column_edges(chosen.select("x"), width)
    blocks = _blocks(chosen, edges)
    if n * max(1, width) > SHARED_CELLS:
        return Spread(materialize(blocks), edges, len(classes))
    data = Sample.of(blocks.toArrow(), edges, len(classes))  # at most SHARED_CELLS bytes, and four for each label
    if (data.label < 0).any():
        raise ValueError("A label is none of the classes")
    return data


def column_edges(rows: DataFrame, width: int) -> tuple[int, list[np.ndarray]]:
    """(number of rows, the edges of each column) of vectors `x array<double>`: between its values, or between as many quantiles.

    Values are counted by column; where they are more than BINS, the ranks of the quantiles are looked up in running sums.
    """
    if not width:
        return rows.count(), []

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(0))
            for f in range(x.shape[1]):
                value, n = np.unique(x[:, f], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), f, dtype=np.int32)), pa.array(value), pa.array(n)], ["column", "value", "n"])

    counted = rows.mapInArrow(distinct, "column int, value double, n bigint").groupBy("column", "value").agg(F.sum("n").alias("n"))
    counted = materialize(counted)
    # one row for each column
    sizes = {r["column"]: (r.values, r.n) for r in counted.groupBy("column").agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("n")).collect()}
    many = [c for c, (values, _) in sizes.items() if values > BINS]
    few = (counted.filter(~F.col("column").isin(many)) if many else counted).select("column", "value").toArrow()  # at most BINS for each column
    found = [few]
    total = max((n for _, n in sizes.values()), default=0)
    if many:
        wanted = np.unique(np.rint(np.linspace(0, 1, BINS) * (total - 1)).astype(np.int64))

        def quantiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                before, n = batch.column(2).to_numpy(), batch.column(3).to_numpy()
                at = np.searchsorted(wanted, before)  # the first wanted rank that isn't before the value
                hit = wanted[np.minimum(at, len(wanted) - 1)] < before + n
                yield batch.select([0, 1]).filter(pa.array(hit & (at < len(wanted))))

        placed = running_totals(counted.filter(F.col("column").isin(many)), ["column"], "value", ["n"])
        placed = placed.select("column", "value", F.col("before_n").cast("bigint"), "n")
        found.append(placed.mapInArrow(quantiles, "column int, value double").toArrow())  # at most BINS for each column
    column = np.concatenate([t["column"].to_numpy() for t in found])
    value = np.concatenate([t["value"].to_numpy() for t in found])
    order = np.lexsort((value, column))
    ends = np.searchsorted(column[order], np.arange(width + 1))
    return total, [_between(value[order[a:b]]) for a, b in zip(ends[:-1], ends[1:])]


def _blocks(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """Rows (_h, _id, label, x) as rows of BLOCK, in the order of `_h` and `_id`."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, label, bins, size = TaskContext.get().partitionId(), 0, [], [], 0

        def block() -> pa.RecordBatch:
            cells = [np.concatenate(label).astype(np.int32).tobytes(), np.concatenate(bins).tobytes()]
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), *[pa.array([c], pa.binary()) for c in cells]],
                ["part", "number", "label", "bins"])

        for batch in batches:
            if not batch.num_rows:
                continue
            label.append(batch.column(0).to_numpy(zero_copy_only=False))
            bins.append(binned(matrix(batch.column(1)), edges))
            size += batch.num_rows
            if size >= BLOCK_ROWS or size * len(edges) >= SHARED_CELLS:
                yield block()
                number, label, bins, size = number + 1, [], [], 0
        if size:
            yield block()

    # equal ids, which may be, are put in order by what the rows hold
    return rows.orderBy("_h", "_id", "label", "x").select("label", "x").mapInArrow(pack, BLOCK)


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """How many of each column's edges lie below the values; a missing number lies below all, as no cut has it above."""
    if not edges:
        return np.zeros((len(x), 0), np.uint8)
    out = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)]).astype(np.uint8)
    out[np.isnan(x)] = 0
    return out


def _between(distinct: np.ndarray) -> np.ndarray:
    """Between neighbouring values; a value up to an edge lies below it."""
    return (distinct[1:] + distinct[:-1]) / 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Splits:
    """The best split of each of some nodes so far: the larger the score, the purer the two sides."""

    def __init__(self, nodes: int) -> None:
        self.score = np.full(nodes, -np.inf)
        self.feature = np.full(nodes, -1, dtype=np.int32)
        self.bin = np.zeros(nodes, dtype=np.int64)

    def try_column(self, node: np.ndarray, column: np.ndarray, feature: np.ndarray, label: np.ndarray, totals: np.ndarray, leaf: int) -> None:
        """Offers each node the cuts of one column: `node` and `column` (bins) are by row, `feature` is by node."""
        nodes, classes = totals.shape
        # rows that are equal in node, bin and label count together
        key = (node * 256 + column) * classes + label
        if nodes * 256 * classes <= 4 * len(key):
            n = np.bincount(key)
            key = np.flatnonzero(n)
            n = n[key]
        else:
            key.sort()
            starts = np.flatnonzero(np.diff(key, prepend=-1))
            n = np.diff(starts, append=len(key))
            key = key[starts]
        cell, label = key // classes, key % classes
        new = np.diff(cell, prepend=-1) != 0
        one = np.zeros((int(new.sum()), classes))
        one[np.cumsum(new) - 1, label] = n
        cell = cell[new]
        node, column = cell >> 8, cell & 255
        left = np.cumsum(one, axis=0)
        starts = np.flatnonzero(np.diff(node, prepend=-1))
        base = np.zeros((nodes, classes))
        base[node[starts]] = left[starts] - one[starts]
        cut = np.flatnonzero(node[1:] == node[:-1])
        if not len(cut):
            return
        at = node[cut]
        left = left[cut] - base[at]
        right = totals[at] - left
        n_left, n_right = left.sum(axis=1), right.sum(axis=1)
        score = (left * left).sum(axis=1) / n_left + (right * right).sum(axis=1) / n_right
        score[(n_left < leaf) | (n_right < leaf)] = -np.inf
        # the first of the best cuts of each node
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        most = np.repeat(np.maximum.reduceat(score, starts), np.diff(starts, append=len(at)))
        best = np.flatnonzero(score == most)
        first = best[np.flatnonzero(np.diff(at[best], prepend=-1))]
        better = first[score[first] > self.score[at[first]]]
        self.score[at[better]] = score[better]
        self.feature[at[better]] = feature[at[better]]
        self.bin[at[better]] = column[cut[better]]


def grow(data: Sample, leaf: int, tree: int, seed: int, max_depth: int | None = None) -> dict[str, np.ndarray]:
    """One tree, level by level. Node 0 is the root; the sides of node i are below[i] and below[i] + 1; a leaf has feature -1."""
    n, width = data.bins.shape
    drawn = np.random.default_rng((seed, tree)).integers(0, n, n)
    label, bins = data.label[drawn], data.bins[drawn]
    some = max(1, int(np.sqrt(width)))
    names = np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    path = _mix(np.array([(seed << 32) + tree + 1], dtype=np.uint64))  # a hash of each node's way from the root
    rows, node = np.arange(n), np.zeros(n, dtype=np.int64)
    out = {c: [] for c in ("feature", "threshold", "below", "depth", "counts")}
    made, depth = 1, 0
    while len(path):
        nodes = len(path)
        totals = np.bincount(node * data.classes + label[rows], minlength=nodes * data.classes).astype(float).reshape(nodes, -1)
        best = _Splits(nodes)
        if max_depth is None or depth < max_depth:
            open_node = (totals.max(axis=1) < totals.sum(axis=1)) & (totals.sum(axis=1) >= 2 * leaf)
            turn = np.argsort(_mix(path[:, None] ^ names[None, :]), axis=1, kind="stable")
            for k in range(width):
                if k == some:
                    open_node &= best.feature < 0  # go on where no column so far splits the node
                here = open_node[node]
                if not here.any():
                    break
                r, at = rows[here], node[here]
                best.try_column(at, bins[r, turn[at, k]].astype(np.int64), turn[:, k], label[r], totals, leaf)
                if k >= some:
                    open_node &= best.feature < 0
        split = best.feature >= 0
        side = np.cumsum(split) - 1  # of the nodes that are split
        out["feature"].append(best.feature)
        out["threshold"].append(np.array([data.edges[f][b] if f >= 0 else 0.0 for f, b in zip(best.feature.tolist(), best.bin.tolist())]))
        out["below"].append(np.where(split, made + 2 * side, -1).astype(np.int32))
        out["depth"].append(np.full(nodes, depth, dtype=np.int32))
        out["counts"].append(totals)
        made += 2 * int(split.sum())
        stay = split[node]
        rows, node = rows[stay], node[stay]
        right = (bins[rows, best.feature[node]] > best.bin[node]).astype(np.int64)
        parent = path[split]
        path = _mix(np.repeat(parent, 2) + np.tile(np.array([1, 2], dtype=np.uint64), len(parent)))
        node = 2 * side[node] + right
        depth += 1
    return {c: np.concatenate(v) for c, v in out.items()}


def fit_trees(
    spark: SparkSession, data: Sample | Spread, leaves: Sequence[int], trees: int, seed: int, max_depth: int | None = None
) -> DataFrame:
    """One row of TREE for each of `trees` trees with each smallest leaf."""
    leaves = list(leaves)
    total = len(leaves) * trees
    tasks = -(-total // TREES_PER_TASK)

    def one_row(rows: Sample, number: int) -> pa.RecordBatch:
        leaf, tree = leaves[number // trees], number % trees
        one = grow(rows, leaf, tree, seed, max_depth)
        one["counts"] = one["counts"].ravel().astype(np.float32)
        return pa.RecordBatch.from_arrays(
            [pa.array([leaf], pa.int32()), pa.array([tree], pa.int32()), *[pa.array([one[c]]) for c in _TREE_NAMES[2:]]], _TREE_NAMES)

    if isinstance(data, Spread):
        edges, classes = data.edges, data.classes

        def every(key: tuple, blocks: pa.Table) -> pa.Table:
            rows, task = Sample.of(blocks, edges, classes), key[0].as_py()
            return pa.Table.from_batches([one_row(rows, number) for number in range(task, total, tasks)])

        return data.blocks.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).groupBy("task").applyInArrow(every, TREE)
    shared = data.on_workers(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                yield one_row(shared.value, number)

    return spark.range(0, total, 1, tasks).mapInArrow(run, TREE)


def grown(
    spark: SparkSession, data: Sample | Spread, leaves: Sequence[int], trees: int, seed: int, max_depth: int | None = None
) -> DataFrame:
    """The trees of `fit_trees`, written; the rows leave the workers then."""
    rows = materialize(fit_trees(spark, data, leaves, trees, seed, max_depth))
    if isinstance(data, Sample):
        data.shared.destroy()
        data.shared = None
    return rows


@dataclass
class Forest:
    """Trees one after the other: node arrays, and where each tree begins."""

    classes: tuple[str, ...]
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    below: np.ndarray
    depth: np.ndarray
    counts: np.ndarray
    shared: Broadcast | None = field(default=None, repr=False, compare=False)
    #: the written table that it was read from
    rows: DataFrame | None = field(default=None, repr=False, compare=False)

    @classmethod
    def of(cls, table: pa.Table, classes: Sequence[str]) -> "Forest":
        """From rows of TREE."""
        table = table.sort_by("tree")
        sizes = pc.list_value_length(table["feature"]).to_numpy()
        roots = np.cumsum([0, *sizes])[:-1].astype(np.int64)

        def column(name: str) -> np.ndarray:
            return table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False)

        below = column("below")
        below = np.where(below >= 0, below + np.repeat(roots, sizes), -1).astype(np.int32)
        return cls(tuple(classes), roots, column("feature"), column("threshold"), below, column("depth"), column("counts").reshape(-1, len(classes)))

    def table(self, spark: SparkSession, leaf: int = 0) -> DataFrame:
        """Its trees as rows of TREE."""
        if self.rows is not None:
            return self.rows
        ends = np.append(self.roots[1:], len(self.feature))
        sizes = ends - self.roots
        below = np.where(self.below >= 0, self.below - np.repeat(self.roots, sizes), -1).astype(np.int32)
        offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (self.feature, self.threshold, below, self.depth)]
        counts = pa.ListArray.from_arrays(pa.array((np.concatenate(([0], ends)) * len(self.classes)).astype(np.int32)), pa.array(self.counts.ravel()))
        trees = len(self.roots)
        columns = [pa.array(np.full(trees, leaf, dtype=np.int32)), pa.array(np.arange(trees, dtype=np.int32)), *lists, counts]
        return spark.createDataFrame(pa.table(columns, names=_TREE_NAMES), TREE)

    def part(self, trees: int | None = None, max_depth: int | None = None) -> "Forest":
        """The forest of its first trees, grown to a depth."""
        roots = self.roots[:trees]
        end = int(self.roots[trees]) if trees is not None and trees < len(self.roots) else len(self.feature)
        feature, below = self.feature[:end], self.below[:end]
        if max_depth is not None:
            inner = self.depth[:end] < max_depth
            feature, below = np.where(inner, feature, -1).astype(np.int32), np.where(inner, below, -1).astype(np.int32)
        return Forest(self.classes, roots, feature, self.threshold[:end], below, self.depth[:end], self.counts[:end])

    def leaves(self, x: np.ndarray, max_depth: int | None = None, since: tuple[np.ndarray, int] | None = None) -> np.ndarray:
        """(rows, trees): the node that each row ends in; `since` gives the nodes that they reached at a smaller depth."""
        n, trees = len(x), len(self.roots)
        # the rows of one tree after another, as its nodes lie together
        out = np.repeat(self.roots, n) if since is None else since[0].T.flatten()
        going, row = np.arange(n * trees), np.tile(np.arange(n), trees)
        depth = 0 if since is None else since[1]
        while len(going) and (max_depth is None or depth < max_depth):
            node = out[going]
            inner = self.feature[node] >= 0
            going, row, node = going[inner], row[inner], node[inner]
            out[going] = self.below[node] + (x[row, self.feature[node]] > self.threshold[node])
            depth += 1
        return np.ascontiguousarray(out.reshape(trees, n).T)

    def shares(self, leaves: np.ndarray) -> np.ndarray:
        """Mean label shares of some trees' leaves; rounded, so that equal ones stay equal however they were added up."""
        counts = self.counts / self.counts.sum(axis=1, keepdims=True, dtype=float)
        return np.round(counts[leaves].mean(axis=1), 12)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        step = max(1, PAIRS // max(1, len(self.roots)))
        parts = [self.shares(self.leaves(x[a:a + step])) for a in range(0, len(x), step)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.classes)))

    def on_workers(self, spark: SparkSession) -> Broadcast:
        """The forest, sent to each executor once and read by each worker once."""
        if self.shared is None:
            self.shared = spark.sparkContext.broadcast(Forest(
                self.classes, self.roots, self.feature, self.threshold, self.below, self.depth, self.counts))
        return self.shared


def matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


@dataclass
class TreeTable:
    """Trees as a written table of TREE: more than goes to every worker. `nodes` is by (leaf, tree)."""

    classes: tuple[str, ...]
    rows: DataFrame
    nodes: dict[tuple[int, int], int]
    found: dict[int, np.ndarray] | None = field(default=None, repr=False, compare=False)

    def table(self, spark: SparkSession, leaf: int = 0) -> DataFrame:
        return self.rows

    def edges(self) -> dict[int, np.ndarray]:
        """Where each column that the trees use is cut: fewer than BINS numbers a column."""
        if self.found is None:
            def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    feature, threshold = (c.flatten().to_numpy(zero_copy_only=False) for c in batch.columns)
                    for f in np.unique(feature[feature >= 0]):
                        value = np.unique(threshold[feature == f])
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), f, dtype=np.int32)), pa.array(value)], ["column", "value"])

            rows = self.rows.select("feature", "threshold").mapInArrow(cuts, "column int, value double").distinct().toArrow()
            column, value = rows["column"].to_numpy(), rows["value"].to_numpy()
            self.found = {int(f): np.sort(value[column == f]) for f in np.unique(column)}
        return self.found


def by_leaf(rows: DataFrame, classes: Sequence[str]) -> dict[int, Forest] | TreeTable:
    """A written table of TREE as a forest for each smallest leaf that goes to every worker, if it has few enough nodes."""
    nodes = {(r.leaf, r.tree): r.n for r in rows.select("leaf", "tree", F.size("feature").alias("n")).collect()}  # one row a tree
    if sum(nodes.values()) > SHARED_NODES:
        return TreeTable(tuple(classes), rows, nodes)
    table = rows.toArrow()
    return {leaf: Forest.of(table.filter(pc.equal(table["leaf"], leaf)), classes) for leaf in sorted({leaf for leaf, _ in nodes})}


def of_trees(rows: DataFrame, classes: Sequence[str]) -> Forest | TreeTable:
    """The same of a table with one smallest leaf."""
    found = by_leaf(rows, classes)
    if isinstance(found, TreeTable):
        return found
    forest, = found.values()
    forest.rows = rows
    return forest


def score(rows: DataFrame, forest: Forest | TreeTable, vector: str, output: str) -> DataFrame:
    """`rows` with `output array<double>`: one probability per class."""
    if isinstance(forest, TreeTable):
        leaf, = {leaf for leaf, _ in forest.nodes}
        return _meeting(rows, forest, [(leaf, len(forest.nodes), None)], vector, output, labels=False)
    shared = forest.on_workers(rows.sparkSession)

    @F.arrow_udf("array<double>")
    def probabilities(x: pa.Array) -> pa.Array:
        p = shared.value.probabilities(matrix(x))
        offsets = np.arange(len(p) + 1, dtype=np.int32) * len(shared.value.classes)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(p.ravel()))

    return rows.withColumn(output, probabilities(vector_to_array(vector)))


def _groups(nodes: dict[tuple[int, int], int], settings: Sequence[tuple[int, int, int | None]], least: int) -> list[tuple[int, int, int]]:
    """(leaf, tree, group): trees that meet points together, all within one leaf and one stretch between the settings' numbers of trees."""
    ends = {leaf: sorted({t for at, t, _ in settings if at == leaf}) for leaf, _, _ in settings}
    wanted = sorted((leaf, tree) for leaf, tree in nodes if leaf in ends and tree < ends[leaf][-1])
    limit = min(GROUP_NODES, -(-sum(nodes[k] for k in wanted) // max(1, least)))
    out, group, size, last = [], -1, 0, None
    for leaf, tree in wanted:
        stretch = (leaf, sum(tree >= e for e in ends[leaf]))
        if stretch != last or size + nodes[leaf, tree] > limit:
            group, size, last = group + 1, 0, stretch
        out.append((leaf, tree, group))
        size += nodes[leaf, tree]
    return out


def _meeting(
    rows: DataFrame, forest: TreeTable, settings: Sequence[tuple[int, int, int | None]], vector: str, output: str, labels: bool
) -> DataFrame:
    """`rows` with `output`: the probabilities of one setting (leaf, trees, depth), or with `labels` the likeliest class's number of each.

    Points that no cut tells apart are scored once. Each group of trees meets all blocks of points, as long as the sums that a task
    passes on are few enough; else the points are dealt into parts, and the trees meet each of them.
    """
    spark, settings, classes = rows.sparkSession, list(settings), len(forest.classes)
    edges = forest.edges()
    used = sorted(edges)
    place = np.full(max(used, default=-1) + 2, -1, dtype=np.int32)  # the last one is that of no column
    place[used] = np.arange(len(used))
    cuts = [edges[f] for f in used]

    @F.arrow_udf("binary")
    def bins(x: pa.Array) -> pa.Array:
        cells = binned(matrix(x)[:, used], cuts) if len(x) else np.zeros((0, len(used)), np.uint8)
        offsets = pa.array(np.arange(len(cells) + 1, dtype=np.int32) * len(used))
        return pa.Array.from_buffers(pa.binary(), len(cells), [None, offsets.buffers()[1], pa.py_buffer(cells.tobytes())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            for start in range(0, batch.num_rows, POINT_ROWS):
                piece = batch.column(0).slice(start, POINT_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at]), pa.array([len(piece)], pa.int32()), pa.array([b"".join(v.as_buffer() for v in piece)], pa.binary())],
                    ["block", "n", "bins"])
                at += 1

    binned_rows = rows.withColumn("_bins", bins(vector_to_array(vector)))
    points = materialize(binned_rows.select("_bins").distinct().mapInArrow(pack, "block bigint, n int, bins binary"))
    total = points.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    depths = {leaf: sorted({d for at, _, d in settings if at == leaf}, key=lambda d: (d is None, d or 0)) for leaf, _, _ in settings}
    parts = max(1, -(-total * classes * max(map(len, depths.values())) // GROUP_SUMS))
    listed = _groups(forest.nodes, settings, -(-spark.sparkContext.defaultParallelism // parts))
    groups = 1 + max(g for _, _, g in listed)
    sent = spark.createDataFrame(listed, "leaf int, tree int, group int")
    trees = forest.rows.join(F.broadcast(sent), ["leaf", "tree"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    asked = points.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    names = ["block", "group", "leaf", "first", "bins", "sums"]

    def meet(blocks: pa.Table, own: pa.Table) -> pa.Table:
        group, leaf, first = own["group"][0].as_py(), own["leaf"][0].as_py(), pc.min(own["tree"]).as_py()
        whole = Forest.of(own, [""] * classes)
        feature = place[whole.feature]
        cut = np.zeros(len(feature), dtype=np.uint8)
        for k, e in enumerate(cuts):
            at = np.flatnonzero(feature == k)
            cut[at] = np.searchsorted(e, whole.threshold[at])
        whole.feature, whole.threshold = feature, cut
        shares = whole.counts / whole.counts.sum(axis=1, keepdims=True, dtype=float)
        step = max(1, PAIRS // (4 * len(whole.roots)))
        sizes = blocks["n"].to_numpy().astype(np.int64)
        starts = np.cumsum([0, *sizes])
        sums = np.zeros((starts[-1], len(depths[leaf]), classes))
        for begin, n, cells in zip(starts.tolist(), sizes.tolist(), blocks["bins"]):
            x = np.frombuffer(cells.as_buffer(), dtype=np.uint8).reshape(n, len(used))
            for start in range(0, n, step):
                since, out = None, sums[begin + start:begin + min(n, start + step)]
                for k, depth in enumerate(depths[leaf]):
                    ends = whole.leaves(x[start:start + step], depth, since)
                    since = (ends, depth)
                    out[:, k] = shares[ends].sum(axis=1)
        n = blocks.num_rows
        told = [pa.array(np.full(n, v, dtype=np.int32)) for v in (group, leaf, first)]
        carried = blocks["bins"] if group == 0 else pa.array([b""] * n, pa.binary())
        ends = pa.array((starts * (8 * classes * len(depths[leaf]))).astype(np.int32))
        passed = pa.Array.from_buffers(pa.binary(), n, [None, ends.buffers()[1], pa.py_buffer(sums)])
        return pa.table([blocks["block"], *told, carried, passed], names=names)

    def add(own: pa.Table) -> pa.Table:
        own = own.sort_by("group")
        cells = own["bins"][0].as_buffer()
        n = len(own["sums"][0].as_buffer()) // (8 * classes * len(depths[own["leaf"][0].as_py()]))
        out = np.zeros((n, len(settings), classes))
        for leaf, first, sums in zip(own["leaf"].to_pylist(), own["first"].to_pylist(), own["sums"]):
            sums = np.frombuffer(sums.as_buffer()).reshape(n, len(depths[leaf]), classes)
            for k, (at, until, depth) in enumerate(settings):
                if at == leaf and first < until:
                    out[:, k] += sums[:, depths[leaf].index(depth)]
        # rounded, so that equal shares stay equal however they were added up
        out = np.round(out / np.array([t for _, t, _ in settings])[None, :, None], 12)
        found = out.argmax(axis=2).astype(np.int32) if labels else out[:, 0]
        offsets = pa.array(np.arange(n + 1, dtype=np.int32) * found.shape[1])
        ends = pa.array(np.arange(n + 1, dtype=np.int32) * len(used))
        each = pa.Array.from_buffers(pa.binary(), n, [None, ends.buffers()[1], cells])
        return pa.table([each, pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))], names=["_bins", output])

    summed = asked.groupBy("group", "part").cogroup(trees.groupBy("group", "part")).applyInArrow(
        meet, "block bigint, group int, leaf int, first int, bins binary, sums binary")
    kind = "array<int>" if labels else "array<double>"
    found = materialize(summed.groupBy("block").applyInArrow(add, f"_bins binary, {quoted(output)} {kind}"))
    return binned_rows.join(found, "_bins").select(*[F.col(quoted(c)) for c in rows.columns], quoted(output))


def setting_labels(
    rows: DataFrame, forests: dict[int, Forest] | TreeTable, settings: Sequence[tuple[int, int, int | None]], vector: str, output: str
) -> DataFrame:
    """`rows` with `output array<int>`: for each setting (leaf, trees, depth) the number of the likeliest class.

    Each row goes down each forest once, whatever the number of settings: from the end for one depth on to that for the next.
    """
    if isinstance(forests, TreeTable):
        return _meeting(rows, forests, settings, vector, output, labels=True)
    shared = {leaf: forest.on_workers(rows.sparkSession) for leaf, forest in forests.items()}
    settings = list(settings)

    @F.arrow_udf("array<int>")
    def labels(x: pa.Array) -> pa.Array:
        points = matrix(x)
        out = np.zeros((len(points), len(settings)), dtype=np.int32)
        step = max(1, PAIRS // max((t for _, t, _ in settings), default=1))
        for start in range(0, len(points), step):
            piece = points[start:start + step]
            for leaf in sorted({leaf for leaf, _, _ in settings}):
                forest, since = shared[leaf].value, None
                for depth in sorted({d for at, _, d in settings if at == leaf}, key=lambda d: (d is None, d or 0)):
                    ends = forest.leaves(piece, depth, since)
                    since = (ends, depth)
                    for k, (at, trees, until) in enumerate(settings):
                        if (at, until) == (leaf, depth):
                            out[start:start + step, k] = forest.shares(ends[:, :trees]).argmax(axis=1)
        offsets = np.arange(len(points) + 1, dtype=np.int32) * len(settings)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

    return rows.withColumn(output, labels(vector_to_array(vector)))
