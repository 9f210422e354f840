"""Labelled rows for fitting: all of them, or a bounded sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled(labels: DataFrame, where: str = "true", id_col: str = "doc_id") -> DataFrame:
    """The labelled ids that `where` holds for; ids that are null, or labelled more than once in all of `labels`, are left out."""
    once = labels.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(
        *[F.min(c).alias(c) for c in labels.columns if c != id_col], F.count(F.lit(1)).alias("label_rows")
    )
    return once.filter("label_rows = 1").drop("label_rows").filter(where)


def labelled_sample(labels: DataFrame, n: int, where: str = "true", id_col: str = "doc_id") -> DataFrame:
    """At most n of the `labelled` ids, the first in the order of a hash of the id: the same ones in every run.

    A bounded top list, so no task gets more than n rows from each other task.
    """
    return labelled(labels, where, id_col).orderBy(F.xxhash64(id_col), id_col).limit(n)
