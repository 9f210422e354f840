"""Exact k nearest neighbours over a fitted index of cells.

The index is built once: training rows are written with the cell they fall into. Cells lie around pivots, as many as the
rows ask for, and pivots are gathered into groups around a few of them, so that a row's cell is found in two short steps. Per cell and
per group the index keeps how far its farthest point lies from the centre.

Cells are small, so that they rule out much; what a query is sent to is a shard, the cells of one region that hold a block of rows
together. A query first searches the shard of its cell; the distance of its k-th hit then rules out every group, and then every cell, whose
nearest possible point is farther away (triangle inequality), and only the shards of the other cells are searched, for hits within that
distance. A shard that holds many rows is split into blocks, and large query sets on one shard are split as well. Tasks exchange at most
one row per (query, block), never pairs. An index of one block at most, counted when it is built, goes to every worker instead, and queries
are answered where they are.

Within a task, points and queries lie in leaves of a tree of median cuts. A leaf of queries meets the leaves of points in order of the distance
between their boxes, until these are too far; a matrix product tells which pairs may be near enough, and only for these the distance
itself is summed.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from profilespark.functions.clean import quoted
from profilespark.operators.ordered import seeded_hash
from profilespark.session import materialize

# task functions travel by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: rows of one training block and of one query chunk
BLOCK_ROWS = 20_000
QUERY_ROWS = 20_000
#: rows of one cell, if a block is not smaller
CELL_ROWS = 256
#: pivots reach the driver and every task; with more rows than BLOCK_ROWS for each of them, cells are split into blocks
MAX_PIVOTS = 1 << 16
#: rows in a leaf of the tree that a task searches, and leaves that are searched at once
LEAF_ROWS = 256
LEAVES_AT_ONCE = 16
#: a side is cut at its gap if one part in so many lies beyond it, and the gap times this is no less than the widest side
GAP_SHARE = 16
GAP_WORTH = 8
#: numbers in the points of an index that goes to every worker
LOCAL_CELLS = 1 << 22
#: a search that asks for at most so many cells reads only these
LISTED_CELLS = 1000
#: squared distances are compared after rounding, so noise in the last digits cannot reorder ties
DIGITS = 9


def squared_distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    total = np.zeros((len(queries), len(points)))
    for j in range(points.shape[1]):
        total += (queries[:, j, None] - points[None, :, j]) ** 2
    return np.round(total, DIGITS)


def _top_k(distance: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row the positions of the k smallest values; the earlier position wins ties."""
    n = distance.shape[1]
    if n <= k:
        return list(np.argsort(distance, axis=1, kind="stable"))
    edge = np.partition(distance, k - 1, axis=1)[:, k - 1]
    found = []
    for row, limit in zip(distance, edge):
        near = np.flatnonzero(row <= limit)
        found.append(near[np.argsort(row[near], kind="stable")][:k])
    return found


def _leaves(x: np.ndarray, rows: int = LEAF_ROWS, gaps: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(rows in order of their leaf, where each leaf begins, and the end), down to `rows`: halves along the widest side, unless there is a wide gap.

    Sides with a gap in the middle, as the 0 and 1 of a category's columns have, are cut there: no region then reaches across.
    Without `gaps` no side is; cells lie around pivots, so they reach across all the same.
    """
    order, edges, todo = np.arange(len(x)), [0], [(0, len(x))]
    while todo:
        a, b = todo.pop()
        if b - a <= rows:
            edges.append(b)
            continue
        own, half = order[a:b], (b - a) // 2
        inside = x[own]
        low, high = inside.min(axis=0), inside.max(axis=0)
        side = int((high - low).argmax())
        upper = inside > (low + high) / 2
        count = upper.sum(axis=0)
        # halves may differ in size, but not so much that the tree gets deep
        fair = np.flatnonzero(np.minimum(count, b - a - count) * GAP_SHARE >= b - a)
        if gaps and len(fair):
            sides, above = inside[:, fair], upper[:, fair]
            gap = np.where(above, sides, np.inf).min(axis=0) - np.where(above, -np.inf, sides).max(axis=0)
            gap[2 * gap < high[fair] - low[fair]] = 0.0
            if gap.max() * GAP_WORTH >= high[side] - low[side]:
                best = int(gap.argmax())
                side, half = int(fair[best]), b - a - int(count[fair[best]])
        order[a:b] = own[np.argpartition(inside[:, side], half)]
        todo += [(a + half, b), (a, a + half)]
    return order, np.array(edges)


def _product_error(x: np.ndarray, y: np.ndarray) -> float:
    """How far `_by_product` may be from the distance, for rows of these squared lengths."""
    return 8.0 * np.finfo(float).eps * float(x.max(initial=0.0) + y.max(initial=0.0))


def _by_product(x: np.ndarray, y: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> np.ndarray:
    """Squared distances by a matrix product, up to rounding; x2 and y2 are the squared lengths."""
    out = x @ y.T
    out *= -2.0
    out += x2[:, None]
    out += y2[None, :]
    return out


def _least_distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances, none larger than it is, and smaller by rounding at most."""
    if not (np.isfinite(x).all() and np.isfinite(points).all()):
        return squared_distances(x, points)
    middle = points.mean(axis=0)
    x, points = x - middle, points - middle
    x2, y2 = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", points, points)
    return np.maximum(_by_product(x, points, x2, y2) - _product_error(x2, y2) * (4 + x.shape[1]), 0.0)


def nearest_points(queries: np.ndarray, points: np.ndarray, k: int, limit: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, squared distance) of each query's k nearest points within its limit, by query, distance and point."""
    n, width = queries.shape[0], points.shape[1]
    limit = np.full(n, np.inf) if limit is None else limit
    if not n or not len(points):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    if not (width and np.isfinite(queries).all() and np.isfinite(points).all()):
        return _one_by_one(queries, points, k, limit)
    middle = points.mean(axis=0)
    q, p = queries - middle, points - middle
    by_leaf, edges = _leaves(p)
    p = p[by_leaf]
    p2, q2 = np.einsum("ij,ij->i", p, p), np.einsum("ij,ij->i", q, q)
    low, high = np.minimum.reduceat(p, edges[:-1]), np.maximum.reduceat(p, edges[:-1])
    # compared distances are rounded, so what is equal after rounding stays in
    margin = _product_error(q2, p2) * (4 + width) + 2 * 10.0 ** -DIGITS
    asked, cuts = _leaves(q)
    from_query, from_point = [], []
    for a, b in zip(cuts[:-1], cuts[1:]):
        own = asked[a:b]
        x, x2 = q[own], q2[own]
        apart = np.maximum(np.maximum(low - x.max(axis=0), x.min(axis=0) - high), 0.0)
        apart = np.einsum("ij,ij->i", apart, apart)
        order = np.argsort(apart, kind="stable")
        bound, best = limit[own] + margin, np.full((len(own), k), np.inf)
        rows, hits, found = [], [], []
        done, step = 0, 1
        while done < len(order):
            near = order[done:done + step]
            near = near[apart[near] <= bound.max() + margin]
            if not len(near):
                break
            at = np.concatenate([np.arange(edges[leaf], edges[leaf + 1]) for leaf in near])
            distance = _by_product(x, p[at], x2, p2[at])
            hit = np.flatnonzero((distance <= bound[:, None]).any(axis=1))
            if len(hit):
                distance = distance[hit]
                both = np.concatenate((best[hit], distance), axis=1)
                best[hit] = np.partition(both, k - 1, axis=1)[:, :k]
                bound[hit] = np.minimum(bound[hit], best[hit].max(axis=1) + margin)
                r, c = np.nonzero(distance <= bound[hit][:, None])
                rows.append(hit[r])
                hits.append(at[c])
                found.append(distance[r, c])
            done, step = done + step, min(2 * step, LEAVES_AT_ONCE)
        if rows:
            row, point, distance = np.concatenate(rows), np.concatenate(hits), np.concatenate(found)
            still = distance <= bound[row]
            from_query.append(own[row[still]])
            from_point.append(by_leaf[point[still]])
    if not from_query:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    row, point = np.concatenate(from_query), np.concatenate(from_point)
    d2 = np.zeros(len(row))
    for j in range(width):
        d2 += (queries[row, j] - points[point, j]) ** 2
    d2 = np.round(d2, DIGITS)
    return _first(row, point, d2, k, limit)


def _one_by_one(queries: np.ndarray, points: np.ndarray, k: int, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`nearest_points` by comparing all pairs: where a number is missing, no order of regions holds."""
    rows, hits, found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0)]
    for s in _in_steps(queries, len(points)):
        distance = squared_distances(queries[s], points)
        for i, near in enumerate(_top_k(distance, k)):
            rows.append(np.full(len(near), s.start + i))
            hits.append(near)
            found.append(distance[i, near])
    row, point, d2 = (np.concatenate(c) for c in (rows, hits, found))
    keep = ~(d2 > limit[row])
    return row[keep], point[keep], d2[keep]


def _first(row: np.ndarray, point: np.ndarray, d2: np.ndarray, k: int, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k first of each row, by distance and then point."""
    keep = d2 <= limit[row]
    row, point, d2 = row[keep], point[keep], d2[keep]
    order = np.lexsort((point, d2, row))
    row, point, d2 = row[order], point[order], d2[order]
    at = np.arange(len(row))
    new = np.concatenate(([True], row[1:] != row[:-1])) if len(row) else np.zeros(0, dtype=bool)
    keep = at - np.maximum.accumulate(np.where(new, at, 0)) < k
    return row[keep], point[keep], d2[keep]


@dataclass
class Cells:
    """Pivots in groups: cell c lies around pivots[c] and belongs to group[c], which lies around centers[group[c]]."""

    pivots: np.ndarray
    group: np.ndarray
    centers: np.ndarray

    @classmethod
    def around(cls, pivots: np.ndarray) -> "Cells":
        """Groups around the first ones, as many as the root of their number."""
        centers = pivots[: max(1, int(np.ceil(np.sqrt(len(pivots)))))]
        step = max(1, 4_000_000 // len(centers))
        group = [_least_distances(pivots[a:a + step], centers).argmin(axis=1) for a in range(0, len(pivots), step)]
        return cls(pivots, np.concatenate(group), centers)

    def nearest(self, x: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell, distance to its pivot, distance to its group's centre): the nearest allowed cell of the nearest group that has one."""
        groups = np.unique(self.group[allowed])
        at = _least_distances(x, self.centers[groups]).argmin(axis=1)
        cell = np.zeros(len(x), dtype=np.int64)
        for g in np.unique(at):
            rows, cells = np.flatnonzero(at == g), np.flatnonzero(allowed & (self.group == groups[g]))
            cell[rows] = cells[_least_distances(x[rows], self.pivots[cells]).argmin(axis=1)]
        return cell, _lengths(x - self.pivots[cell]), _lengths(x - self.centers[groups[at]])

    def within(self, x: np.ndarray, limit: np.ndarray, reach: np.ndarray, group_reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of the cells that may hold a point within each row's squared distance, by row."""
        limit = np.sqrt(limit + 1e-7) + 1e-7  # the margin covers the rounding of compared distances
        near = np.sqrt(_least_distances(x, self.centers)) - group_reach[None, :] <= limit[:, None]
        from_row, found = [], []
        for g in np.flatnonzero(near.any(axis=0)):
            rows, cells = np.flatnonzero(near[:, g]), np.flatnonzero(self.group == g)
            d = np.sqrt(_least_distances(x[rows], self.pivots[cells])) - reach[cells][None, :]
            r, c = np.nonzero(d <= limit[rows][:, None])
            from_row.append(rows[r])
            found.append(cells[c])
        row, cell = (np.concatenate(v) if v else np.zeros(0, dtype=np.int64) for v in (from_row, found))
        order = np.lexsort((cell, row))
        return row[order], cell[order]


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def _in_steps(x: np.ndarray, width: int) -> list[slice]:
    """Rows whose distances to so many pivots stay within a few million numbers."""
    step = max(1, 4_000_000 // max(1, width))
    return [slice(a, a + step) for a in range(0, len(x), step)]


def _cell_udf(cells: Cells):
    """Nearest cell of a point, and the distances to its pivot and to its group's centre."""

    @F.arrow_udf("struct<cell:int,reach:double,group_reach:double>")
    def cell(x: pa.Array) -> pa.Array:
        points = _matrix(pa.chunked_array([x]))
        if not len(points):
            return pa.nulls(0, pa.struct([("cell", pa.int32()), ("reach", pa.float64()), ("group_reach", pa.float64())]))
        every = np.ones(len(cells.pivots), dtype=bool)
        parts = [cells.nearest(points[s], every) for s in _in_steps(points, len(every))]
        at, reach, group_reach = (np.concatenate(c) for c in zip(*parts))
        return pa.StructArray.from_arrays([pa.array(at.astype("int32")), pa.array(reach), pa.array(group_reach)], names=["cell", "reach", "group_reach"])

    return cell


def _home_udf(cells: Cells, filled: np.ndarray):
    """Nearest cell among those that hold points."""

    @F.arrow_udf("int")
    def home(x: pa.Array) -> pa.Array:
        points = _matrix(pa.chunked_array([x]))
        if not len(points):
            return pa.array([], pa.int32())
        return pa.array(np.concatenate([cells.nearest(points[s], filled)[0] for s in _in_steps(points, len(filled))]).astype("int32"))

    return home


def _other_shards_udf(cells: Cells, reach: np.ndarray, group_reach: np.ndarray, shards: np.ndarray):
    """Shards with a cell that may hold a point closer than `limit`, without the one already searched."""

    @F.arrow_udf("array<int>")
    def others(x: pa.Array, done: pa.Array, limit: pa.Array) -> pa.Array:
        points, bound = _matrix(pa.chunked_array([x])), limit.to_numpy(zero_copy_only=False)
        if not len(points):
            return pa.array([], pa.list_(pa.int32()))
        searched, n = done.to_numpy(zero_copy_only=False), int(shards.max()) + 1
        sizes, found = [], []
        for s in _in_steps(points, len(reach)):
            row, cell = cells.within(points[s], bound[s], reach, group_reach)
            both = np.unique(row * n + shards[cell])
            row, shard = both // n, both % n
            keep = shard != searched[s][row]
            sizes.append(np.bincount(row[keep], minlength=len(points[s])))
            found.append(shard[keep])
        offsets = np.concatenate([[0], np.concatenate(sizes).cumsum()]).astype("int32")
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).astype("int32")))

    return others


def _number_udf(values: np.ndarray):
    """A number per cell, or per shard."""
    numbers = values.astype("int32")

    @F.arrow_udf("int")
    def number(cell: pa.Array) -> pa.Array:
        return pa.array(numbers[cell.to_numpy(zero_copy_only=False)])

    return number


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """An Arrow list column of equally long lists as a matrix."""
    lists = column.combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    return values.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0))


def _hits(row: np.ndarray, point: np.ndarray, d2: np.ndarray, n: int, ids: pa.Array, labels: pa.Array) -> pa.ListArray:
    """Per query its hits, (d2, tid, label) in order."""
    offsets = np.concatenate([[0], np.bincount(row, minlength=n).cumsum()]).astype("int32")
    at = pa.array(point)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(d2), ids.take(at), labels.take(at)], names=["d2", "tid", "label"]))


def _search(routed: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """(qid, hits) of every (query, block) with a hit, blocks and query chunks meeting in one cogroup."""
    schema = T.StructType([T.StructField("qid", routed.schema["qid"].dataType), T.StructField("hits", T.ArrayType(T.StructType([
        T.StructField("d2", T.DoubleType()), T.StructField("tid", blocks.schema["tid"].dataType), T.StructField("label", T.StringType()),
    ])))])
    arrow = to_arrow_schema(schema)

    def search(queries: pa.Table, points: pa.Table) -> pa.Table:
        if not queries.num_rows or not points.num_rows:
            return arrow.empty_table()
        points = points.take(pc.sort_indices(points["tid"], null_placement="at_start"))
        limit = queries["limit"].to_numpy().astype(float)
        row, point, d2 = nearest_points(_matrix(queries["x"]), _matrix(points["x"]), k, limit)
        found = np.unique(row)
        hits = _hits(np.searchsorted(found, row), point, d2, len(found), points["tid"].combine_chunks(), points["label"].combine_chunks())
        return pa.table([queries["qid"].take(pa.array(found)), hits], names=arrow.names).cast(arrow)

    keys = ["shard", "part", "chunk"]
    return routed.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(search, schema)


def _best(hits: DataFrame, k: int) -> DataFrame:
    """(qid, hits): the k first of all hits of each query."""
    every = F.array_sort(F.flatten(F.collect_list("hits")))
    return hits.groupBy("qid").agg(F.slice(every, 1, k).alias("hits"))


@dataclass
class NeighborIndex:
    """Training points by cell, and what searching them needs to know of each cell. Bounded by MAX_PIVOTS, but for the table."""

    #: (cell, tid, x, label), written once
    points: DataFrame
    #: of equal points, as many are kept: no search may ask for more neighbours
    k: int
    block_rows: int
    cells: Cells | None
    counts: np.ndarray
    reach: np.ndarray
    group_reach: np.ndarray
    shared: Broadcast | None = field(default=None, repr=False, compare=False)

    @property
    def is_local(self) -> bool:
        """Whether the whole index goes to every worker; its size is known."""
        return self.cells is None

    @property
    def shard_rows(self) -> int:
        """Small cells rule out more, but it is a block of rows that a query is sent to, however small the cells are."""
        return self.block_rows if self.block_rows >= CELL_ROWS else BLOCK_ROWS

    def shards(self) -> np.ndarray:
        """The shard of each cell: cells of one region, as many as hold about a block of rows."""
        order, _ = _leaves(self.cells.pivots, 1, gaps=False)
        before = np.cumsum(self.counts[order]) - self.counts[order]
        out = np.zeros(len(order), dtype=np.int64)
        out[order] = np.unique(before // self.shard_rows, return_inverse=True)[1]
        return out

    def save(self, path: str) -> None:
        spark = self.points.sparkSession
        self.points.write.mode("overwrite").parquet(f"{path}/points")
        rows = [("index", None, None, None, self.block_rows, float(self.k))]
        if self.cells is None:
            rows.append(("cell", 0, 0, None, int(self.counts[0]), 0.0))
        else:
            rows += [("cell", c, int(self.cells.group[c]), self.cells.pivots[c].tolist(), int(n), float(self.reach[c])) for c, n in enumerate(self.counts)]
            rows += [("group", g, None, center.tolist(), None, float(self.group_reach[g])) for g, center in enumerate(self.cells.centers)]
        schema = "kind string, number int, in_group int, x array<double>, n bigint, reach double"
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/cells")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "NeighborIndex":
        rows = spark.read.parquet(f"{path}/cells").collect()  # at most MAX_PIVOTS, and the root of it
        about = next(r for r in rows if r.kind == "index")
        cell = sorted((r for r in rows if r.kind == "cell"), key=lambda r: r.number)
        group = sorted((r for r in rows if r.kind == "group"), key=lambda r: r.number)
        cells = Cells(np.array([r.x for r in cell]), np.array([r.in_group for r in cell]), np.array([r.x for r in group])) if group else None
        return cls(spark.read.parquet(f"{path}/points"), int(about.reach), int(about.n), cells, np.array([r.n for r in cell]),
                   np.array([r.reach for r in cell]), np.array([r.reach for r in group]))


def build(
    train: DataFrame, k: int, *, train_id: str, label: str, x: str = "x", seed: int | str = 42, block_rows: int = BLOCK_ROWS,
    pivots: int | None = None,
) -> NeighborIndex:
    """The index of training rows for up to `k` neighbours. `x` is an array<double> column, equally long in all rows."""
    points = train.select(
        F.col(train_id).alias("tid"), F.col(x).cast("array<double>").alias("x"), F.col(label).cast("string").alias("label")
    )
    # rows on one and the same point: only the k smallest ids can ever be neighbours,
    # and the limit is applied before the shuffle
    copies = Window.partitionBy("x").orderBy("tid")
    rows = materialize(points.withColumn("_c", F.row_number().over(copies)).filter(F.col("_c") <= k).drop("_c"))
    total, width = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not total:
        raise ValueError("No training rows to search")
    wanted = pivots if pivots is not None else min(MAX_PIVOTS, -(-total // min(block_rows, CELL_ROWS)))
    if (wanted <= 1 or pivots is None and total <= block_rows) and total * width <= LOCAL_CELLS:
        return NeighborIndex(rows.withColumn("cell", F.lit(0)), k, block_rows, None, np.array([total]), np.array([np.inf]), np.array([np.inf]))
    chosen = rows.select("x", seeded_hash(seed, "tid").alias("_h")).orderBy("_h").limit(max(1, wanted)).collect()
    cells = Cells.around(np.unique(np.array([r.x for r in chosen], dtype=float), axis=0))
    placed = rows.withColumn("_p", _cell_udf(cells)("x")).select("_p.cell", "_p.reach", "_p.group_reach", "tid", "x", "label")
    # by cell within each file, so that a search which asks for a few cells skips most of it
    placed = materialize(placed.sortWithinPartitions("cell"))
    counts, reach, group_reach = np.zeros(len(cells.pivots), dtype=np.int64), np.full(len(cells.pivots), -np.inf), np.full(len(cells.centers), -np.inf)
    # one row per pivot
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("reach"), F.max("group_reach").alias("group_reach")).collect():
        counts[r.cell], reach[r.cell] = r.n, r.reach
        group_reach[cells.group[r.cell]] = max(group_reach[cells.group[r.cell]], r.group_reach)
    return NeighborIndex(placed.drop("reach", "group_reach"), k, block_rows, cells, counts, reach, group_reach)


def with_neighbors(queries: DataFrame, train: DataFrame | NeighborIndex, k: int, *, x: str = "x", query_rows: int = QUERY_ROWS, **options) -> DataFrame:
    """Every row of `queries` with `neighbors array<struct<rank, d2, id, label>>`, its k nearest training rows.

    `train` is a built index, or a table to build one from; then `options` are those of `build`. Order: squared distance, then training id.
    Rows are told apart by their point alone: equal points are searched once, and no id of the caller's, which
    may be repeated or null, decides anything.
    """
    index = train if isinstance(train, NeighborIndex) else build(train, k, x=x, **options)
    if k > index.k:
        raise ValueError(f"The index was built for up to {index.k} neighbours.")
    if index.is_local:
        return _where_they_are(queries, index, k, x)
    found = _of_points(queries.select(F.col(x).cast("array<double>").alias("point")).distinct(), index, k, query_rows)
    point = queries.withColumn("_point", F.col(x).cast("array<double>"))
    return point.join(found.withColumnRenamed("point", "_point"), "_point").select(*[F.col(quoted(c)) for c in queries.columns], "neighbors")


def neighbors(queries: DataFrame, train: DataFrame | NeighborIndex, k: int, *, query_id: str, x: str = "x", **options) -> DataFrame:
    """(query id, neighbors) of every query row."""
    return with_neighbors(queries, train, k, x=x, **options).select(F.col(quoted(query_id)).alias(query_id), "neighbors")


def _where_they_are(queries: DataFrame, index: NeighborIndex, k: int, x: str) -> DataFrame:
    """The search in a map: every worker holds the index."""
    if index.shared is None:
        table = index.points.orderBy("tid").select("tid", "x", "label").toArrow()  # at most LOCAL_CELLS numbers
        index.shared = queries.sparkSession.sparkContext.broadcast((table["tid"].combine_chunks(), _matrix(table["x"]), table["label"].combine_chunks()))
    shared = index.shared
    kind = T.ArrayType(T.StructType([
        T.StructField("rank", T.IntegerType()), T.StructField("d2", T.DoubleType()),
        T.StructField("id", index.points.schema["tid"].dataType), T.StructField("label", T.StringType()),
    ]))

    @F.arrow_udf(kind)
    def search(column: pa.Array) -> pa.Array:
        ids, points, labels = shared.value
        asked = _matrix(pa.chunked_array([column]))
        row, at, found = nearest_points(asked, points, k)
        offsets = np.concatenate([[0], np.bincount(row, minlength=len(asked)).cumsum()]).astype("int32")
        rank = (np.arange(len(at)) - offsets[row] + 1).astype("int32")
        rows = pa.StructArray.from_arrays(
            [pa.array(rank), pa.array(found), ids.take(pa.array(at)), labels.take(pa.array(at))], names=["rank", "d2", "id", "label"])
        return pa.ListArray.from_arrays(pa.array(offsets), rows)

    return queries.withColumn("neighbors", search(F.col(x).cast("array<double>")))


def _of_points(asked: DataFrame, index: NeighborIndex, k: int, query_rows: int) -> DataFrame:
    """(point, neighbors) of distinct points `point array<double>`."""
    # a point is named by a number, so that only the search itself carries its coordinates; written once, as it is read in each step below
    asked = materialize(asked.select(F.monotonically_increasing_id().alias("qid"), F.col("point").alias("x")))
    cell_shards = index.shards()
    shards = int(cell_shards.max()) + 1
    rows = np.bincount(cell_shards, weights=index.counts, minlength=shards).astype(np.int64)
    parts = np.maximum(1, -(-rows // (2 * index.shard_rows)))

    def run(routed: DataFrame) -> DataFrame:
        """Search (qid, x, limit, shard) rows; both sides are replicated only as often as pieces need."""
        load = np.zeros(shards, dtype=np.int64)
        for r in routed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect():  # at most one row per pivot
            load[r.shard] = r.n
        chunks = np.maximum(1, -(-load // query_rows))
        part_count, chunk_count = _number_udf(parts)("shard"), _number_udf(chunks)("shard")
        left = routed.withColumns({"_parts": part_count, "_chunks": chunk_count}).select(
            "qid", "x", "limit", "shard", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("part"),
            F.pmod("qid", F.col("_chunks")).cast("int").alias("chunk"),
        )
        points, used = index.points, np.flatnonzero(load[cell_shards] * index.counts)
        if len(used) <= LISTED_CELLS:
            points = points.filter(F.col("cell").isin(used.tolist()))
        right = points.withColumn("shard", _number_udf(cell_shards)("cell")).withColumns({"_parts": part_count, "_chunks": chunk_count}).select(
            "tid", "x", "label", "shard", F.pmod(F.xxhash64("tid"), F.col("_parts")).cast("int").alias("part"),
            F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("chunk"),
        )
        return _search(left, right, k)

    home = asked.withColumn("shard", _number_udf(cell_shards)(_home_udf(index.cells, index.counts > 0)("x")))
    home = materialize(home.withColumn("limit", F.lit(float("inf"))))
    # read three times below (limits, routing, merge), so it is written once
    first = materialize(_best(run(home), k))
    full = F.size("hits") == k
    limits = first.select("qid", F.when(full, F.element_at("hits", -1)["d2"]).otherwise(float("inf")).alias("limit"))
    others = _other_shards_udf(index.cells, index.reach, index.group_reach, cell_shards)
    rest = materialize(home.drop("limit").join(limits, "qid").withColumn("shard", F.explode(others("x", "shard", "limit"))))
    best = _best(first.unionByName(run(rest)), k)
    ranked = F.transform("hits", lambda h, i: F.struct((i + 1).alias("rank"), h["d2"].alias("d2"), h["tid"].alias("id"), h["label"].alias("label")))
    return best.withColumn("neighbors", ranked).join(asked, "qid").select(F.col("x").alias("point"), "neighbors")


def vote(neighbors_col: str, k: int, weights: str, classes: Sequence[str]) -> dict[str, Column]:
    """`probabilities` and `predicted` from the first k neighbours.

    "uniform": one vote each. "distance": votes of 1/distance; when exact matches exist,
    only they vote. The label that is first in text order wins ties.
    """
    if weights not in ("uniform", "distance"):
        raise ValueError("weights must be 'uniform' or 'distance'")
    return {"probabilities": _shares_udf(k, weights, classes)(neighbors_col), "predicted": _winner_udf(k, weights, classes)(neighbors_col)}


def _winner_udf(k: int, weights: str, classes: Sequence[str]):
    """The label with the largest share of the votes."""
    ordered = sorted(classes)

    @F.arrow_udf("string")
    def winner(neighbors: pa.Array) -> pa.Array:
        # a missing distance leaves no share to any label, so the first one wins there too
        rounded = np.round(-np.nan_to_num(_shares(neighbors, k, weights, ordered)[0]), 12)
        return pa.array(ordered, pa.string()).take(pa.array(rounded.argmin(axis=1)))

    return winner


def _shares_udf(k: int, weights: str, classes: Sequence[str]):
    """The share of the votes of each label."""

    @F.arrow_udf("map<string,double>")
    def probabilities(neighbors: pa.Array) -> pa.Array:
        shares, total = _shares(neighbors, k, weights, classes)
        offsets = np.arange(0, shares.size + 1, len(classes), dtype=np.int32)
        values = pa.array(shares.ravel(), mask=np.repeat(total == 0, len(classes)))
        return pa.MapArray.from_arrays(pa.array(offsets), pa.array(list(classes) * len(shares), pa.string()), values)

    return probabilities


def _shares(neighbors: pa.Array, k: int, weights: str, classes: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(per row and class its share of the votes of the first k neighbours, per row all votes), summed in the neighbours' order."""
    sizes = np.minimum(neighbors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), k)
    starts = neighbors.offsets.to_numpy()[:-1].astype(np.int64)
    d2 = pc.struct_field(neighbors.values, "d2").to_numpy(zero_copy_only=False)
    found = pc.index_in(pc.struct_field(neighbors.values, "label"), pa.array(list(classes), pa.string())).fill_null(-1).to_numpy(zero_copy_only=False)
    within = np.arange(k)[None, :] < sizes[:, None]
    at = np.where(within, starts[:, None] + np.arange(k)[None, :], 0)
    if not len(d2):
        return np.zeros((len(sizes), len(classes))), np.zeros(len(sizes))
    distance, label = d2[at], np.where(within, found[at], -1)
    weight = np.ones(at.shape)
    with np.errstate(divide="ignore", invalid="ignore"):
        if weights == "distance":
            exact = (distance == 0) & within
            weight = np.where(exact.any(axis=1)[:, None], exact.astype(float), 1.0 / np.sqrt(distance))
        shares, total = np.zeros((len(at), len(classes))), np.zeros(len(at))
        for j in range(k):  # one place after the other, so that equal neighbours give equal sums
            own = np.where(within[:, j], weight[:, j], 0.0)
            total += own
            for c in range(len(classes)):
                shares[:, c] += np.where(label[:, j] == c, own, 0.0)
        return shares / total[:, None], total
