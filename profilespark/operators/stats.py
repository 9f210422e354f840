"""Profiling of the training rows: every result is an aggregate table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilespark.contract import Contract
from profilespark.functions.clean import quoted
from profilespark.operators.ordered import exact_quantiles, positions, sent_if_few
from profilespark.session import materialize


def _long(one_row: DataFrame, entries: Sequence[dict[str, Column]], by: Sequence[str] = ()) -> DataFrame:
    structs = [F.struct(*[value.alias(name) for name, value in entry.items()]) for entry in entries]
    return one_row.select(*by, F.inline(F.array(*structs)))


def ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, low, high): observed range per numeric column."""
    one = df.agg(
        *[F.min(F.col(quoted(c)).cast("double")).alias(f"_a{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(quoted(c)).cast("double")).alias(f"_z{i}") for i, c in enumerate(columns)],
    )
    return _long(one, [
        {"column": F.lit(c), "low": F.col(f"_a{i}"), "high": F.col(f"_z{i}")} for i, c in enumerate(columns)
    ])


def medians(df: DataFrame, columns: Sequence[str], accuracy: int | None = None) -> DataFrame:
    return exact_quantiles(df, columns, [0.5], accuracy=accuracy).select(
        "column", F.col("quantile").alias("median")
    )


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    entries = []
    aggregates = []
    for i, c in enumerate(columns):
        x = F.col(quoted(c)).cast("double")
        aggregates += [
            F.count(x).alias(f"_n{i}"), F.avg(x).alias(f"_m{i}"), F.stddev_samp(x).alias(f"_s{i}"),
            F.min(x).alias(f"_a{i}"), F.max(x).alias(f"_z{i}"),
        ]
        entries.append({
            "column": F.lit(c), "n": F.col(f"_n{i}"), "mean": F.col(f"_m{i}"), "std": F.col(f"_s{i}"),
            "low": F.col(f"_a{i}"), "high": F.col(f"_z{i}"),
        })
    return _long(df.agg(*aggregates), entries)


def describe(df: DataFrame, columns: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per column."""
    quartiles = (
        exact_quantiles(df, columns, [0.25, 0.5, 0.75], accuracy=accuracy)
        .groupBy("column")
        .agg(*[
            F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(name)
            for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
        ])
    )
    return moments(df, columns).join(quartiles, "column").select(
        "column", "n", "mean", "std", "low", "q25", "q50", "q75", "high"
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 20) -> DataFrame:
    """(column, bin, lower, upper, n): equal bins over the observed range, the last one closed."""
    limits = {r["column"]: (r.low, r.high) for r in ranges(df, columns).collect()}
    arrays = []
    kept = [c for c in columns if limits[c][0] is not None]
    edges = {}
    for c in kept:
        low, high = limits[c]
        if low == high:  # a constant column gets a bin range one unit wide around its value
            low, high = low - 0.5, high + 0.5
        edges[c] = (low, high)
        x = F.col(quoted(c)).cast("double")
        step = (high - low) / bins
        # a first guess by division, then one step to the bin whose printed edges hold the value
        guess = F.least(F.floor((x - F.lit(low)) / F.lit(high - low) * F.lit(bins)), F.lit(bins - 1))
        lower, upper = F.lit(low) + guess * F.lit(step), F.lit(low) + (guess + 1) * F.lit(step)
        number = (
            F.when(x < lower, guess - 1).when((x >= upper) & (guess < bins - 1), guess + 1).otherwise(guess) + 1
        )
        arrays.append(F.struct(F.lit(c).alias("column"), F.when(x.isNotNull(), number).cast("int").alias("bin")))
    counts = (
        df.select(F.inline(F.array(*arrays)))
        .filter(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = df.sparkSession.createDataFrame(
        [
            (c, b, edges[c][0] + (b - 1) * ((edges[c][1] - edges[c][0]) / bins),
             edges[c][1] if b == bins else edges[c][0] + b * ((edges[c][1] - edges[c][0]) / bins))
            for c in kept for b in range(1, bins + 1)
        ],
        "column string, bin int, lower double, upper double",
    )
    # columns x bins rows on the left: empty bins stay
    return frame.join(counts, ["column", "bin"], "left").select(
        "column", "bin", "lower", "upper", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair over rows where both are present, one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = df.agg(*[
        F.corr(F.col(quoted(a)).cast("double"), F.col(quoted(b)).cast("double")).alias(f"_r{i}")
        for i, (a, b) in enumerate(pairs)
    ])
    entries = []
    for i, (a, b) in enumerate(pairs):
        entries.append({"left": F.lit(a), "right": F.lit(b), "r": F.col(f"_r{i}")})
        if a != b:
            entries.append({"left": F.lit(b), "right": F.lit(a), "r": F.col(f"_r{i}")})
    return _long(one, entries)


def box_stats(df: DataFrame, columns: Sequence[str], label: str, accuracy: int | None = None) -> DataFrame:
    """Quartiles, whiskers and outlier counts per (column, label).

    Whiskers end at the last value within 1.5 interquartile ranges of the box.
    """
    quartiles = (
        exact_quantiles(df.filter(F.col(quoted(label)).isNotNull()), columns, [0.25, 0.5, 0.75], by=[label], accuracy=accuracy)
        .groupBy(label, "column")
        .agg(*[
            F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(name)
            for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
        ])
    )
    wide = quartiles.groupBy(label).agg(
        *[F.max(F.when(F.col("column") == c, F.struct("q25", "q50", "q75"))).alias(f"_q{i}") for i, c in enumerate(columns)]
    )
    rows = df.select(F.col(quoted(label)).alias(label), *[F.col(quoted(c)).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)])
    joined = rows.join(sent_if_few(materialize(wide)), label)
    aggregates, entries = [], []
    for i, c in enumerate(columns):
        x, q1, q3 = F.col(f"_x{i}"), F.col(f"_q{i}.q25"), F.col(f"_q{i}.q75")
        reach = F.lit(1.5) * (q3 - q1)
        low, high = q1 - reach, q3 + reach
        aggregates += [
            # numbers, not a struct, so that the aggregate stays a hash aggregate
            *[F.max(f"_q{i}.{q}").alias(f"_{q}_{i}") for q in ("q25", "q50", "q75")],
            F.min(F.when(x >= low, x)).alias(f"_a{i}"),
            F.max(F.when(x <= high, x)).alias(f"_z{i}"),
            F.count(x).alias(f"_n{i}"),
            F.count_if((x < low) | (x > high)).alias(f"_o{i}"),
        ]
        entries.append({
            "column": F.lit(c), "n": F.col(f"_n{i}"),
            "q25": F.col(f"_q25_{i}"), "q50": F.col(f"_q50_{i}"), "q75": F.col(f"_q75_{i}"),
            # never inside the box
            "whisker_low": F.least(F.col(f"_a{i}"), F.col(f"_q25_{i}")),
            "whisker_high": F.greatest(F.col(f"_z{i}"), F.col(f"_q75_{i}")),
            "outliers": F.col(f"_o{i}"),
        })
    return _long(joined.groupBy(label).agg(*aggregates), entries, by=[F.col(label).alias("label")])


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) of every non-null category; one shuffle of partial counts."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.inline(F.array(*entries)))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def vocabulary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, position, value): distinct non-null categories in text order, from 0."""
    return positions(category_counts(df, columns), ["column"], "value").select("column", "position", "value")


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mode): most frequent category; the smallest text wins ties."""
    return modes_of(category_counts(df, columns))


def modes_of(counts: DataFrame) -> DataFrame:
    """The same from (column, value, n); each task passes on one row per column."""
    best = F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("best")
    return counts.groupBy("column").agg(best).select("column", F.col("best.value").alias("mode"))


# Which training quantile each rule threshold is.
THRESHOLD_QUANTILES: Mapping[str, Mapping[str, float]] = {
    "Sleep_Hours_Per_Night": {"low": 0.25, "very_low": 0.10, "high": 0.90, "reference": 0.50},
    "Avg_Daily_Usage_Hours": {"high": 0.75, "very_high": 0.90, "reference": 0.50},
    "Daily_Unlocks": {"high": 0.75, "very_high": 0.90, "reference": 0.50},
    "Physical_Activity_Hours": {"low": 0.25, "very_low": 0.10, "reference": 0.50},
    "Study_Hours": {"high": 0.75, "very_high": 0.90, "reference": 0.50},
}


def thresholds(
    train: DataFrame,
    wanted: Mapping[str, Mapping[str, float]] = THRESHOLD_QUANTILES,
    accuracy: int | None = None,
) -> DataFrame:
    """(column, threshold, value): named training quantiles, two decimals."""
    probabilities = sorted({p for names in wanted.values() for p in names.values()})
    quantiles = exact_quantiles(train, list(wanted), probabilities, accuracy=accuracy)
    names = train.sparkSession.createDataFrame(
        [(c, name, float(p)) for c, entries in wanted.items() for name, p in entries.items()],
        "column string, threshold string, probability double",
    )
    return quantiles.join(F.broadcast(names), ["column", "probability"]).select(
        "column", "threshold", F.round("quantile", 2).alias("value")
    )


def preview(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    return df.orderBy(order).limit(n)
