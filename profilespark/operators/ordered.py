"""Ranks, cut points, running sums and exact quantiles without one-task windows.

The usual `row_number() over (partition by label ...)` puts a whole label on one task.
Here rows are first counted per bucket (map-side combine, tiny shuffle); only the
buckets that hold a wanted rank, or buckets of bounded share, are ever sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profilespark.functions.clean import quoted
from profilespark.session import materialize

#: rows that one sorting task should hold at most, about
TASK_ROWS = 1_000_000
#: accuracy of the sketch that brackets a rank: a bracket holds about 8 rows in this many
SKETCH = 100_000


def bucket_digits(rows: int) -> int:
    """Hex digits of a hash that cut `rows` into even buckets of about TASK_ROWS or less."""
    digits = 2
    while digits < 12 and rows / 16**digits > TASK_ROWS:
        digits += 1
    return digits


def seeded_hash(seed: int | str, *columns: str | Column) -> Column:
    """md5 over `seed|col|...`: the same text order in every SQL engine."""
    parts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))


def rank_cuts(
    hashed: DataFrame, keys: Sequence[str], wanted: DataFrame, rows: int, hash_col: str = "_h"
) -> DataFrame:
    """The hash found at given 1-based ranks of each key: (keys..., rank, cut).

    `wanted` is a small table (keys..., rank), `rows` the size of the table. Rows outside the buckets that hold a
    wanted rank are never sorted or shuffled.
    """
    bucket = F.substring(hash_col, 1, bucket_digits(rows))
    counts = hashed.groupBy(*keys, bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    located = offsets.join(F.broadcast(wanted), list(keys)).filter(
        (F.col("rank") > F.col("_before")) & (F.col("rank") <= F.col("_before") + F.col("_n"))
    )
    located = located.select(*keys, "_b", "rank", (F.col("rank") - F.col("_before")).alias("_within"))
    inside = hashed.withColumn("_b", bucket).join(
        F.broadcast(located.select(*keys, "_b").distinct()), [*keys, "_b"], "left_semi"
    )
    ranked = inside.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(hash_col)))
    hit = F.col("_r") == F.col("_within")
    return (
        ranked.join(F.broadcast(located), [*keys, "_b"])
        .filter(hit)
        .select(*keys, "rank", F.col(hash_col).alias("cut"))
    )


def global_rank(df: DataFrame, keys: Sequence[str], hash_col: str, out: str, rows: int) -> DataFrame:
    """Exact 1-based rank by a hash within each key, sorted in even hash buckets.

    `rows` is the number of rows per key.
    """
    bucketed = df.withColumn("_b", F.substring(hash_col, 1, bucket_digits(rows)))
    counts = bucketed.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(hash_col))
    return (
        bucketed.withColumn("_r", inner)
        .join(offsets, [*keys, "_b"])
        .withColumn(out, F.col("_r") + F.col("_before"))
        .drop("_b", "_r", "_before")
    )


def _in_ranges(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """`df` written in the order of (keys, order), with `_at`, the number of its range in the upper bits and of its row in the lower 33.

    Ranges are as many as shuffle partitions and about even, as long as few rows are equal in (keys, order). They are written once, so
    that a row's place is the same for all who read it.
    """
    columns = [*keys, order]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(ranges, *columns).sortWithinPartitions(*columns).withColumn("_at", F.monotonically_increasing_id()))


def _with_earlier(ranges: DataFrame, keys: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """`ranges` with `_part`, `_first` (the first place of the row's keys in its range) and each sum over earlier ranges of the same keys."""
    part = F.shiftright("_at", 33)
    totals = ranges.groupBy(part.alias("_part"), *keys).agg(F.min("_at").alias("_first"), *[v.alias(name) for name, v in sums.items()])
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *keys, "_first", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in sums])
    # a row for each range and for each key that begins in one
    return ranges.withColumn("_part", part).join(F.broadcast(offsets), ["_part", *keys])


def positions(df: DataFrame, keys: Sequence[str], order: str, out: str = "position") -> DataFrame:
    """`df` with each row's place, from 0, in the order of `order` within its keys. No key is ever in one task."""
    placed = _with_earlier(_in_ranges(df, keys, order), keys, {"_before": F.count(F.lit(1))})
    return placed.select(*[F.col(quoted(c)) for c in df.columns], (F.col("_at") - F.col("_first") + F.col("_before")).alias(out))


def running_totals(grouped: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Sum of each value column over all smaller `order` values: `before_<value>`.

    `grouped` must hold one row per (keys, order), which may be any number: a sum is that of the ranges before
    and of the rows before in the same range, and the ranges are as many as shuffle partitions.
    """
    placed = _with_earlier(_in_ranges(grouped, keys, order), keys, {f"_o_{v}": F.sum(v) for v in values})
    inner = Window.partitionBy("_part", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        *[F.col(quoted(c)) for c in grouped.columns],
        *[(F.col(f"_o_{v}") + F.coalesce(F.sum(v).over(inner), F.lit(0))).alias(f"before_{v}") for v in values],
    )


#: groups whose limits go to every task
FEW_GROUPS = 10_000


def sent_if_few(table: DataFrame, limit: int = FEW_GROUPS) -> DataFrame:
    """A written table for a join: with a broadcast hint if it has few rows, counted, and as it is otherwise."""
    return F.broadcast(table) if table.count() <= limit else table


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int | None = None,
    sketch: int | None = None,
) -> DataFrame:
    """Quantiles with linear interpolation, long: (by..., column, probability, quantile, n).

    Exact (the default), in one way at every size: a quantile sketch brackets each wanted rank, one aggregation
    counts what lies below the bracket, and only the few values inside the brackets
    are grouped and ranked. No value-to-count map of a whole column is ever built, and
    a value that holds a large share of the rows collapses in the map-side combine.
    With `accuracy` set, the sketch's own answer is returned. `df` is read three times: pass a table.
    """
    by = list(by)
    probabilities = list(probabilities)
    cells = [(c, i, p) for c in columns for i, p in enumerate(probabilities)]
    # a number that isn't one counts as missing
    value_of = {c: F.col(quoted(c)).cast("double") for c in columns}
    col = {c: F.when(~F.isnan(x), x) for c, x in value_of.items()}

    def rows_of(source: DataFrame, value) -> DataFrame:
        return source.select(
            *by,
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(c).alias("column"),
                            F.lit(i).alias("_p"),
                            F.lit(float(p)).alias("probability"),
                            *value(c, i, p),
                        )
                        for c, i, p in cells
                    ]
                )
            ),
        )

    if accuracy is not None:
        sketched = df.groupBy(*by).agg(
            *[F.percentile_approx(col[c], probabilities, F.lit(accuracy)).alias(f"_q_{j}") for j, c in enumerate(columns)],
            *[F.count(col[c]).alias(f"_n_{j}") for j, c in enumerate(columns)],
        )
        at = {c: j for j, c in enumerate(columns)}
        return rows_of(
            sketched,
            lambda c, i, p: [
                F.element_at(f"_q_{at[c]}", i + 1).alias("quantile"),
                F.col(f"_n_{at[c]}").alias("n"),
            ],
        ).drop("_p")

    sketch = sketch or SKETCH
    margin = 4.0 / sketch
    low_p = [max(p - margin, 0.0) for p in probabilities]
    high_p = [min(p + margin, 1.0) for p in probabilities]
    at = {c: j for j, c in enumerate(columns)}
    bounds = df.groupBy(*by).agg(
        *[
            F.percentile_approx(col[c], [*low_p, *high_p], F.lit(sketch)).alias(f"_s_{j}")
            for j, c in enumerate(columns)
        ],
        *[F.count(col[c]).alias(f"_n_{j}") for j, c in enumerate(columns)],
    )
    bounds = materialize(bounds)  # one row a group, read by the two passes below
    width = len(probabilities)

    def low(c, i):
        return F.lit(float("-inf")) if low_p[i] <= 0 else F.element_at(f"_s_{at[c]}", i + 1)

    def high(c, i):
        return F.lit(float("inf")) if high_p[i] >= 1 else F.element_at(f"_s_{at[c]}", width + i + 1)

    bracketed = df.select(*by, *[col[c].alias(f"_x_{j}") for j, c in enumerate(columns)])
    if by:
        # null-safe: a null group is a group
        renamed = bounds.select(*[F.col(b).alias(f"_by_{b}") for b in by], *[c for c in bounds.columns if c not in by])
        condition = None
        for b in by:
            test = F.col(b).eqNullSafe(F.col(f"_by_{b}"))
            condition = test if condition is None else condition & test
        joined = bracketed.join(sent_if_few(renamed), condition).drop(*[f"_by_{b}" for b in by])
    else:
        one = bounds.agg(
            F.first(F.struct(*bounds.columns)).alias("_all")
        ).scalar()  # a single row of sketch bounds, injected as a value
        joined = bracketed.withColumn("_all", one).select("*", "_all.*").drop("_all")

    below = joined.groupBy(*by).agg(
        *[F.count_if(F.col(f"_x_{at[c]}") < low(c, i)).alias(f"_b_{at[c]}_{i}") for c, i, _ in cells],
        # the neighbours just outside: with few rows a rank can lie one step off the bracket
        *[F.max(F.when(F.col(f"_x_{at[c]}") < low(c, i), F.col(f"_x_{at[c]}"))).alias(f"_l_{at[c]}_{i}") for c, i, _ in cells],
        *[F.min(F.when(F.col(f"_x_{at[c]}") > high(c, i), F.col(f"_x_{at[c]}"))).alias(f"_g_{at[c]}_{i}") for c, i, _ in cells],
        *[F.max(f"_n_{j}").alias(f"_n_{j}") for j in range(len(columns))],
    )
    below = materialize(below)
    targets = rows_of(
        below,
        lambda c, i, p: [
            F.col(f"_b_{at[c]}_{i}").alias("_below"),
            F.col(f"_l_{at[c]}_{i}").alias("_less"),
            F.col(f"_g_{at[c]}_{i}").alias("_more"),
            F.col(f"_n_{at[c]}").alias("n"),
            ((F.col(f"_n_{at[c]}") - 1) * F.lit(float(p))).alias("_at"),
        ],
    )
    inside = joined.select(
        *by,
        F.inline(
            F.array_compact(
                F.array(
                    *[
                        F.when(
                            F.col(f"_x_{at[c]}").between(low(c, i), high(c, i)),
                            F.struct(
                                F.lit(c).alias("column"), F.lit(i).alias("_p"), F.col(f"_x_{at[c]}").alias("_x")
                            ),
                        )
                        for c, i, _ in cells
                    ]
                )
            )
        ),
    )
    values = inside.groupBy(*by, "column", "_p", "_x").agg(F.count(F.lit(1)).alias("_k"))
    earlier = Window.partitionBy(*by, "column", "_p").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumn("_seen", F.coalesce(F.sum("_k").over(earlier), F.lit(0)))

    keys = [*by, "column", "_p"]
    right = values.select(*[F.col(k).alias(f"_v_{k}") for k in keys], "_x", "_k", "_seen")
    condition = None
    for k in keys:
        test = F.col(k).eqNullSafe(F.col(f"_v_{k}"))
        condition = test if condition is None else condition & test
    placed = right.join(sent_if_few(targets), condition)
    start = F.col("_below") + F.col("_seen")

    def value_at(position: Column) -> Column:
        inside_hit = F.max(F.when((position >= start) & (position < start + F.col("_k")), F.col("_x")))
        return (
            F.when(position == F.col("_below") - 1, F.col("_less"))
            .when(position == F.col("_below") + F.sum("_k"), F.col("_more"))
            .otherwise(inside_hit)
        )

    picked = placed.groupBy(*by, "column", "_p", "probability", "n", "_at", "_below", "_less", "_more").agg(
        value_at(F.floor("_at")).alias("_lo"), value_at(F.ceil("_at")).alias("_hi")
    )
    exact = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_at") - F.floor("_at"))
    quantile = F.when(F.col("_lo").isNull() | F.col("_hi").isNull(),
                      F.raise_error(F.lit("quantile bracket missed its rank")).cast("double")).otherwise(exact)
    found = picked.select(*by, "column", "_p", "probability", "n", quantile.alias("quantile"))
    # columns without a single value keep a row with a null quantile
    empty = targets.filter(F.col("n") == 0).select(
        *by, "column", "_p", "probability", "n", F.lit(None).cast("double").alias("quantile")
    )
    return found.unionByName(empty).select(*by, "column", "probability", "quantile", "n")
