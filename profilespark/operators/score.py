"""Scoring of new rows: labels, probabilities, cluster, comparisons, notes, prompts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilespark.contract import Contract
from profilespark.functions.clean import canonical_text, quoted, to_number
from profilespark.operators.dictionary import Dictionary


def _value(df: DataFrame, column: str) -> Column:
    return to_number(F.col(quoted(column)), df.schema[column].dataType)


def agreement(labels: Column, primary: Column) -> Column:
    """How many labels in an array equal the primary one (itself included)."""
    return F.size(F.filter(labels, lambda x: x == primary))


def median_comparison(df: DataFrame, contract: Contract, medians: Mapping[str, float]) -> Column:
    """array<struct<feature, name, value, training_median>> over the numeric columns."""
    return F.array(*[
        F.struct(
            F.lit(c).alias("feature"), F.lit(contract.display(c)).alias("name"),
            _value(df, c).alias("value"), F.lit(float(medians[c])).alias("training_median"),
        )
        for c in contract.numeric if c in medians
    ])


def _short(value: float) -> str:
    return f"{value:g}"


def range_notes(df: DataFrame, contract: Contract, ranges: Mapping[str, Sequence[float]]) -> list[Column]:
    """A text (or null) per numeric column whose value lies outside the training range."""
    notes = []
    for c in contract.numeric:
        if c not in ranges:
            continue
        low, high = (float(v) for v in ranges[c])
        name, span = contract.display(c), f"({_short(low)}-{_short(high)})"
        # The wording of the notes.
        if c in contract.report_only:
            text = (
                f"{name} is outside the observed training range {span}. {name} is excluded from "
                f"prediction, but performance for this {name.lower()} group is unverified."
            )
        else:
            text = f"{name} is outside the observed training range {span}; this prediction may be less reliable."
        notes.append(F.when(~_value(df, c).between(F.lit(low), F.lit(high)), F.lit(text)))
    return notes


def with_unseen(df: DataFrame, contract: Contract, known: Dictionary) -> tuple[DataFrame, dict[str, str]]:
    """(`df` with a flag per category column: whether its cleaned value was not in training, the flags' names).

    Values are looked up in the dictionary's table, so the plan is the same whatever the number of known values.
    """
    flags = {}
    for i, c in enumerate(contract.categorical):
        if c not in known.sizes:
            continue
        value, flags[c] = canonical_text(F.col(quoted(c)), contract.aliases.get(c)), f"_unseen_{i}"
        df = known.with_position(df, value, c, "_position").withColumn(flags[c], value.isNotNull() & F.col("_position").isNull()).drop("_position")
    return df, flags


def unseen_notes(contract: Contract, flags: Mapping[str, str]) -> list[Column]:
    """A text (or null) per category column whose flag is set."""
    # The wording of the note.
    return [
        F.when(F.col(flag), F.lit(f"{contract.display(c)} was unseen in training and is encoded as an unknown category."))
        for c, flag in flags.items()
    ]


def notes(df: DataFrame, contract: Contract, ranges: Mapping[str, Sequence[float]], flags: Mapping[str, str]) -> Column:
    """All notes of a row of `df`, which has the flags of `with_unseen`."""
    found = range_notes(df, contract, ranges) + unseen_notes(contract, flags)
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
