"""Majority baseline: the most frequent training label for every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilespark.contract import Contract
from profilespark.operators.quality import class_counts


def majority_label(train: DataFrame, contract: Contract) -> str:
    counts = class_counts(train, contract).collect()
    return min(counts, key=lambda r: (-r.n, r.label)).label


def score_majority(df: DataFrame, label: str, classes: Sequence[str]) -> DataFrame:
    """Add `predicted` and the one-hot `probabilities`."""
    pairs = [x for c in classes for x in (F.lit(c), F.lit(1.0 if c == label else 0.0))]
    return df.withColumns({"predicted": F.lit(label), "probabilities": F.create_map(*pairs)})
