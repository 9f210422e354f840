"""Cleaning, label checks, duplicate and conflict removal, and the audit.

`prepare` needs one shuffle: duplicates, conflicting profiles and repeated profiles
are all decided by a single aggregation on the cleaned profile. It uses only
min / max / count, so map-side partial aggregation absorbs a profile that holds a
large share of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilespark.contract import Contract
from profilespark.functions import clean as C

MAX_LISTED_LABELS = 100


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "required") -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"Missing {what} columns: {missing}")


def stage(df: DataFrame, contract: Contract, columns: Sequence[str]) -> DataFrame:
    """Add `_s_<column>`: the parsed number or the stripped text of each text column.

    Later rules read such a value several times; a projection of its own makes sure
    that parsing and stripping run once per cell.
    """
    staged = {}
    for c in columns:
        kind = df.schema[c].dataType
        source = F.col(C.quoted(c))
        if c not in contract.numeric:
            staged[f"_s_{c}"] = C.strip(source.cast("string"))
        elif isinstance(kind, T.StringType):
            staged[f"_s_{c}"] = C.to_number(source, kind)
    return df.withColumns(staged) if staged else df


def clean_column(df: DataFrame, contract: Contract, column: str) -> Column:
    """Cleaned value of one column of a staged table."""
    staged = f"_s_{column}"
    if column in contract.numeric:
        if staged in df.columns:
            number = F.col(C.quoted(staged))
        else:
            number = C.to_number(F.col(C.quoted(column)), df.schema[column].dataType)
        return C.in_bounds(number, contract.bounds.get(column)).alias(column)
    text = F.col(C.quoted(staged)) if staged in df.columns else C.strip(F.col(C.quoted(column)).cast("string"))
    return F.nullif(C.alias_value(text, contract.aliases.get(column)), F.lit("")).alias(column)


def clean_features(
    df: DataFrame, contract: Contract, features: Sequence[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Lenient cleaning: bad cells become null, rows stay. Only contract columns remain."""
    columns = tuple(features or contract.features)
    require_columns(df, columns, "feature")
    staged = stage(df, contract, columns)
    return staged.select(
        *[F.col(C.quoted(c)) for c in keep], *[clean_column(staged, contract, c) for c in columns]
    )


def clean_target(contract: Contract) -> Column:
    return F.nullif(C.strip(F.col(C.quoted(contract.target)).cast("string")), F.lit(""))


def label_position(contract: Contract, label: Column) -> Column:
    """1-based place in the label order; an unknown label stops the job.

    Whole numbers keep min / max in a hash aggregation; texts would force a sort.
    """
    place = F.array_position(F.array(*[F.lit(x) for x in contract.labels]), label).cast("int")
    stop = F.raise_error(F.concat(F.lit("Unknown label: "), label)).cast("int")
    return F.when(place > 0, place).when(label.isNotNull(), stop)


def label_at(contract: Contract, position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in contract.labels]), position)


def unknown_labels(df: DataFrame, contract: Contract) -> DataFrame:
    """Labels outside the contract, with their row counts."""
    label = clean_target(contract)
    return (
        df.select(label.alias("label"))
        .filter(F.col("label").isNotNull() & ~F.col("label").isin(*contract.labels))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def check_labels(df: DataFrame, contract: Contract) -> None:
    found = [r.label for r in unknown_labels(df, contract).orderBy("label").limit(MAX_LISTED_LABELS + 1).collect()]
    if found:
        name = (contract.target or "target").replace("_", " ").lower()
        listed = found[:MAX_LISTED_LABELS]
        more = f" and others: unknown_labels() has the full table of {unknown_labels(df, contract).count()}" if len(found) > len(listed) else ""
        raise ValueError(
            f"Unknown {name} values (unknown labels): {listed}{more}. Expected {list(contract.labels)}."
        )


def exact_duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row counts before and after removing rows that are equal in every column."""
    keys = [F.col(C.quoted(c)) for c in (columns or df.columns)]
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("raw_rows"),
            F.count(F.lit(1)).alias("distinct_rows"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("exact_duplicates_removed"),
        )
    )


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def labelled_profiles(df: DataFrame, contract: Contract) -> DataFrame:
    """Cleaned features, target and row id of every row that has a label."""
    require_columns(df, contract.features + (contract.target,))
    # the raw null test comes first, so it can be pushed to the scan
    labelled = df.filter(F.col(C.quoted(contract.target)).isNotNull())
    labelled = stage(labelled, contract, contract.features + (contract.target,))
    keep = [F.col(C.quoted(contract.row_id)).alias(contract.row_id)] if contract.row_id else []
    return labelled.select(
        *keep,
        *[clean_column(labelled, contract, c) for c in contract.features + (contract.target,)],
    ).filter(F.col(C.quoted(contract.target)).isNotNull())


def profile_groups(df: DataFrame, contract: Contract, key: Sequence[str] | None = None) -> DataFrame:
    """One row per cleaned profile: copies, lowest and highest label, smallest row id."""
    rows = labelled_profiles(df, contract)
    rows = rows.withColumn("_place", label_position(contract, F.col(C.quoted(contract.target))))
    carried = [c for c in contract.features if c not in (key or contract.features)]
    aggregates = [
        F.count(F.lit(1)).alias("copies"),
        F.min("_place").alias("_low"),
        F.max("_place").alias("_high"),
    ]
    named = [*([contract.row_id] if contract.row_id else []), *carried]
    if carried:
        # columns outside a narrower key come from one row, the one with the smallest id
        aggregates.append(F.min(F.struct(*[F.col(C.quoted(c)).alias(f"_{i}") for i, c in enumerate(named)])).alias("_first"))
    elif named:
        aggregates.append(F.min(C.quoted(contract.row_id)).alias(contract.row_id))
    groups = rows.groupBy(*[C.quoted(c) for c in (key or contract.features)]).agg(*aggregates)
    if carried:
        groups = groups.withColumns({c: F.col(f"_first._{i}") for i, c in enumerate(named)}).drop("_first")
    return groups.withColumns({
        "first_label": label_at(contract, F.col("_low")), "last_label": label_at(contract, F.col("_high"))
    })


def conflicting_profiles(df: DataFrame, contract: Contract) -> DataFrame:
    """Profiles that occur with more than one label, and how many rows they hold."""
    return profile_groups(df, contract).filter(F.col("_low") != F.col("_high")).drop(
        "_low", "_high", *([contract.row_id] if contract.row_id else [])
    )


def prepare(
    df: DataFrame, contract: Contract, *, check: bool = True, key: Sequence[str] | None = None
) -> DataFrame:
    """Clean table with one row per unambiguous profile.

    Exact duplicates need no pass of their own: equal rows have equal profiles and
    labels, so the profile aggregation removes them too. `key` may name
    `contract.model_features` to treat profiles that differ only in report-only
    columns as one.
    """
    require_columns(df, contract.features + (contract.target,))
    if check:
        check_labels(df, contract)
    keep = [contract.row_id] if contract.row_id else []
    return (
        profile_groups(df, contract, key)
        .filter(F.col("_low") == F.col("_high"))
        .select(
            *[C.quoted(c) for c in keep],
            *[C.quoted(c) for c in contract.features],
            F.col("first_label").alias(contract.target),
        )
    )


def audit(df: DataFrame, contract: Contract) -> DataFrame:
    """Every data-quality count in one job, as a long table (metric, column, value).

    Rows are first grouped on all raw columns (exact duplicates), then on the cleaned
    profile. Both steps only sum counters, so neither is hurt by a hot key.
    """
    require_columns(df, contract.features + (contract.target,))
    raw_columns = list(df.columns)
    features = list(contract.features)
    target = C.quoted(contract.target)

    distinct = df.groupBy(*[C.quoted(c) for c in raw_columns]).agg(F.count(F.lit(1)).alias("_copies"))
    distinct = stage(distinct, contract, contract.features + (contract.target,))
    label = clean_column(distinct, contract, contract.target)
    has_label = label.isNotNull()

    counters: dict[str, Column] = {
        "raw_rows": F.col("_copies"),
        "exact_duplicates_removed": F.col("_copies") - 1,
        "missing_target_rows_removed": F.when(~has_label, 1).otherwise(0),
    }
    for column in raw_columns:
        counters[f"raw_missing/{column}"] = F.when(C.is_missing(df, column), F.col("_copies")).otherwise(0)
    for column in contract.numeric:
        lost = ~C.is_missing(df, column) & clean_column(distinct, contract, column).isNull()
        counters[f"invalid_numeric_values/{column}"] = F.when(has_label & lost, 1).otherwise(0)

    profiled = distinct.select(
        *[clean_column(distinct, contract, c).alias(f"_f{i}") for i, c in enumerate(features)],
        label_position(contract, label).alias("_label"),
        *[value.cast("long").alias(f"_c{i}") for i, value in enumerate(counters.values())],
    )
    # rows without a label form groups of their own and never decide a conflict
    groups = profiled.groupBy(
        *[f"_f{i}" for i in range(len(features))], F.col("_label").isNotNull().alias("_labelled")
    ).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min("_label").alias("_first"),
        F.max("_label").alias("_last"),
        *[F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(counters))],
    )
    conflict = F.col("_labelled") & (F.col("_first") != F.col("_last"))
    kept = F.col("_labelled") & (F.col("_first") == F.col("_last"))

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("long")

    results: list[tuple[str, str | None, Column]] = []
    for i, name in enumerate(counters):
        metric, _, column = name.partition("/")
        results.append((metric, column or None, total(F.col(f"_c{i}"))))
    results += [
        ("raw_columns", None, F.lit(len(raw_columns)).cast("long")),
        ("conflicting_profile_rows_removed", None, total(F.when(conflict, F.col("_rows")))),
        ("repeated_profile_rows_removed", None, total(F.when(kept, F.col("_rows") - 1))),
        ("prepared_rows", None, total(F.when(kept, 1))),
    ]
    results += [
        ("class_counts", name, total(F.when(kept & (F.col("_first") == i + 1), 1))) for i, name in enumerate(contract.labels)
    ]
    results += [
        ("remaining_missing", c, total(F.when(kept & F.col(f"_f{i}").isNull(), 1)))
        for i, c in enumerate(features)
    ]
    results.append(("remaining_missing", contract.target, F.lit(0).cast("long")))

    one_row = groups.agg(*[value.alias(f"_v{i}") for i, (_, _, value) in enumerate(results)])
    entries = F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric"),
                F.lit(column).cast("string").alias("column"),
                F.col(f"_v{i}").alias("value"),
            )
            for i, (metric, column, _) in enumerate(results)
        ]
    )
    return one_row.select(F.inline(entries))


def class_counts(df: DataFrame, contract: Contract, by: Sequence[str] = ()) -> DataFrame:
    """Rows per label in contract order, zero for absent labels (labels are a fixed list)."""
    label = F.col(C.quoted(contract.target))
    counts = df.groupBy(*by).agg(
        *[F.count_if(label == F.lit(name)).alias(f"_n{i}") for i, name in enumerate(contract.labels)]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(i).cast("int").alias("position"),
                F.lit(name).alias("label"),
                F.col(f"_n{i}").alias("n"),
            )
            for i, name in enumerate(contract.labels)
        ]
    )
    return counts.select(*by, F.inline(entries))


def require_class_size(counts: dict[str, int], contract: Contract) -> None:
    smallest = min(counts.get(name, 0) for name in contract.labels)
    if smallest < contract.min_class_rows:
        raise ValueError(
            f"Need at least {contract.min_class_rows} unique profiles per label for stratified "
            f"splitting and folds; found {counts}."
        )
