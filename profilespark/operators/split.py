"""Stratified splits and folds by hash rank: exact sizes, no full sort, no row moved.

Per label the rows are ordered by a seeded hash of the row id and cut at exact ranks.
Only the hash value at each cut is needed, so the assignment itself is a narrow map
against a table of (labels x parts) rows. The outcome depends on ids alone, so
a recomputed partition gets the same rows again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilespark.contract import Contract
from profilespark.functions.clean import is_missing, quoted
from profilespark.operators.ordered import rank_cuts, seeded_hash
from profilespark.operators.quality import class_counts, require_class_size

PARTS = ("train", "val", "test")


def with_row_id(df: DataFrame, columns: Sequence[str] | None = None, name: str = "row_id") -> DataFrame:
    """A stable row identity from row content; equal rows must have been removed."""
    marker = F.lit("\x01null")
    texts = [F.coalesce(F.col(quoted(c)).cast("string"), marker) for c in (columns or df.columns)]
    return df.withColumn(name, F.sha2(F.concat_ws("\x1f", *texts), 256))


def largest_remainder(total: int, sizes: dict[str, int]) -> dict[str, int]:
    """Share `total` over labels in proportion; larger remainders, then label order, win."""
    everything = sum(sizes.values())
    exact = {k: total * n / everything if everything else 0.0 for k, n in sizes.items()}
    shares = {k: min(math.floor(v), sizes[k]) for k, v in exact.items()}
    order = sorted(sizes, key=lambda k: (-(exact[k] - math.floor(exact[k])), list(sizes).index(k)))
    left = total - sum(shares.values())
    while left > 0:
        for k in order:
            if left > 0 and shares[k] < sizes[k]:
                shares[k] += 1
                left -= 1
    return shares


def split_quotas(sizes: dict[str, int]) -> dict[str, dict[str, int]]:
    """Rows per label and part: 20 % test, then 25 % of the rest for validation, rounded up."""
    n = sum(sizes.values())
    test = largest_remainder(math.ceil(n * 0.2), sizes)
    rest = {k: sizes[k] - test[k] for k in sizes}
    val = largest_remainder(math.ceil(sum(rest.values()) * 0.25), rest)
    return {k: {"test": test[k], "val": val[k], "train": rest[k] - val[k]} for k in sizes}


def fold_quotas(sizes: dict[str, int], folds: int) -> dict[str, list[int]]:
    """Rows per label and fold when the label-sorted rows are dealt out in turn."""
    quotas, start = {}, 0
    for k, n in sizes.items():
        quotas[k] = [len(range((f - start) % folds, n, folds)) for f in range(folds)]
        start += n
    return quotas


def label_sizes(df: DataFrame, contract: Contract) -> dict[str, int]:
    return {r.label: r.n for r in class_counts(df, contract).orderBy("position").collect()}


def _assign(
    df: DataFrame, contract: Contract, quotas: dict[str, list[tuple[str, int]]], seed: str, out: str
) -> DataFrame:
    """Give each row the part whose hash interval it falls into.

    `quotas`: per label the parts in rank order with their sizes; the last part takes the rest.
    """
    spark = df.sparkSession
    label, row_id = contract.target, contract.row_id
    wanted = [
        (name, rank) for name, parts in quotas.items()
        for rank in {sum(n for _, n in parts[: i + 1]) for i in range(len(parts) - 1)} if rank > 0
    ]
    hashed = df.select(F.col(quoted(label)).alias("_label"), seeded_hash(seed, F.col(quoted(row_id))).alias("_h"))
    total = sum(n for parts in quotas.values() for _, n in parts)
    cuts = rank_cuts(hashed, ["_label"], spark.createDataFrame(wanted, "_label string, rank long"), total)
    # labels x parts rows: bounded by the contract
    found = {(r._label, r.rank): r.cut for r in cuts.collect()}

    row_hash = seeded_hash(seed, F.col(quoted(row_id)))
    part = F.lit(None).cast("string")
    chain = None
    for name, parts in quotas.items():
        upto, inner = 0, None
        for part_name, size in parts[:-1]:
            upto += size
            if size == 0:
                continue
            test = row_hash <= F.lit(found[(name, upto)])
            inner = F.when(test, F.lit(part_name)) if inner is None else inner.when(test, F.lit(part_name))
        value = F.lit(parts[-1][0]) if inner is None else inner.otherwise(F.lit(parts[-1][0]))
        test = F.col(quoted(label)) == F.lit(name)
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return df.withColumn(out, part if chain is None else chain)


def stratified_split(df: DataFrame, contract: Contract, seed: int | None = None) -> DataFrame:
    """Add `split` (train / val / test), 60/20/20 within each label."""
    if not contract.row_id:
        raise ValueError("Splitting needs a contract with a stable row id")
    sizes = label_sizes(df, contract)
    require_class_size(sizes, contract)
    quotas = {
        name: [("test", q["test"]), ("val", q["val"]), ("train", q["train"])]
        for name, q in split_quotas(sizes).items()
    }
    return _assign(df, contract, quotas, str(contract.seed if seed is None else seed), "split")


def stratified_folds(df: DataFrame, contract: Contract, folds: int = 3, seed: int | None = None) -> DataFrame:
    """Add `fold` (0..folds-1): label shares are kept, fold sizes differ by at most one."""
    base = contract.seed if seed is None else seed
    sizes = {k: n for k, n in label_sizes(df, contract).items() if n > 0}
    quotas = {
        name: [(str(i), n) for i, n in enumerate(per_fold)]
        for name, per_fold in fold_quotas(sizes, folds).items()
    }
    return _assign(df, contract, quotas, f"{base}|fold", "fold").withColumn("fold", F.col("fold").cast("int"))


def require_usable_columns(train: DataFrame, contract: Contract) -> None:
    """Raise when a training column has no value at all."""
    counts = train.agg(
        *[F.count_if(~is_missing(train, c)).alias(c) for c in contract.features]
    ).first()
    empty = [c for c in contract.features if counts[c] == 0]
    if empty:
        raise ValueError(f"No usable training values for columns: {empty}")


def split_label_counts(split: DataFrame, contract: Contract) -> DataFrame:
    """Label counts per part, one row per label, with a total."""
    label = F.col(quoted(contract.target))
    counted = (
        split.groupBy(label.alias("label"))
        .pivot("split", list(PARTS))
        .agg(F.count(F.lit(1)))
        .na.fill(0, list(PARTS))
    )
    return counted.withColumn("total", sum((F.col(p) for p in PARTS[1:]), F.col(PARTS[0])))


def split_checks(split: DataFrame, source: DataFrame, contract: Contract) -> DataFrame:
    """Leakage checks as (check, violations): one grouping on the row id, one on the profile."""
    row_id = C_id = quoted(contract.row_id)
    per_id = (
        split.select(F.col(C_id).alias("_id"), "split", F.lit(1).alias("_in"))
        .unionByName(source.select(F.col(row_id).alias("_id"), F.lit(None).cast("string").alias("split"), F.lit(0).alias("_in")))
        .groupBy("_id")
        .agg(
            F.min("split").alias("_a"), F.max("split").alias("_z"),
            F.sum("_in").alias("_assigned"), F.count_if(F.col("_in") == 0).alias("_source"),
        )
        .agg(
            F.count_if(F.col("_a") != F.col("_z")).alias("row_in_two_parts"),
            F.count_if(F.col("_assigned") < F.col("_source")).alias("row_without_part"),
            F.count_if(F.col("_assigned") > F.col("_source")).alias("row_not_in_source"),
        )
    )
    profiles = (
        split.groupBy(*[F.col(quoted(c)) for c in contract.features])
        .agg(F.min("split").alias("_a"), F.max("split").alias("_z"))
        .agg(F.count_if(F.col("_a") != F.col("_z")).alias("profile_in_two_parts"))
    )
    label = F.col(quoted(contract.target))
    cells = [(p, name) for p in PARTS for name in contract.labels]
    missing = split.agg(
        *[F.count_if((F.col("split") == p) & (label == name)).alias(f"_{i}") for i, (p, name) in enumerate(cells)]
    ).select(sum((F.when(F.col(f"_{i}") == 0, 1).otherwise(0) for i in range(len(cells))), F.lit(0)).cast("long").alias("label_missing_in_part"))
    leaked = [c for c in contract.excluded if c in split.columns]

    def long(df: DataFrame) -> DataFrame:
        return df.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).cast("long").alias("violations")) for c in df.columns]))
        )

    fixed = split.sparkSession.createDataFrame([("excluded_column_present", len(leaked))], "check string, violations long")
    return long(per_id).unionByName(long(profiles)).unionByName(long(missing)).unionByName(fixed)
