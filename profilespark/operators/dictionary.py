"""Dictionaries of category values: a written table with a position per value, looked up by join.

A dictionary may hold any number of values: it is counted with map-side combine, put in order by ranges, and never collected. Rows look
values up in a copy that goes to every task where its counted size allows that, and else by a shuffle in which no value is hot, as the most frequent
values are looked up in every task first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profilespark.operators.ordered import positions
from profilespark.operators.stats import category_counts

#: bounds on what of one column's values goes to every task
SENT_VALUES = 100_000
SENT_BYTES = 8 << 20
#: what the rows of frequent values are dealt by in the shuffle that has nothing for them
DEALT = 1009

TABLE = "column string, value string, n bigint, position bigint"


@dataclass(frozen=True)
class Dictionary:
    #: (column, value, n, position): positions count from 0 within a column, in text order
    table: DataFrame
    #: number of values and their bytes, by column
    sizes: Mapping[str, tuple[int, int]]

    def entries(self, column: str) -> DataFrame:
        return self.table.filter(F.col("column") == column)

    def is_small(self, column: str) -> bool:
        values, size = self.sizes.get(column, (0, 0))
        return values <= SENT_VALUES and size <= SENT_BYTES

    def with_position(self, rows: DataFrame, value: Column, column: str, output: str) -> DataFrame:
        """`rows` with the position of a value in the dictionary of a column; null for unknown and null values."""
        key, known, near = f"_key_{output}", f"_value_{output}", f"_near_{output}"
        entries = self.entries(column).select(F.col("value").alias(known), F.col("position").alias(near), "n")
        keyed = rows.withColumn(key, value)
        if self.is_small(column):
            found = keyed.join(F.broadcast(entries.drop("n")), F.col(key) == F.col(known), "left")
            return found.withColumnRenamed(near, output).drop(key, known)
        # a bounded list of the most frequent values, and of bounded length each
        often = entries.filter(F.octet_length(known) <= SENT_BYTES // SENT_VALUES).orderBy(F.desc("n"), known).limit(SENT_VALUES).drop("n")
        first = keyed.join(F.broadcast(often), F.col(key) == F.col(known), "left").drop(known)
        # rows that are done, or have no value, are dealt evenly: a text that starts with U+0000 and a number is no category
        dealt = F.concat(F.lit("\u0000"), F.pmod(F.monotonically_increasing_id(), F.lit(DEALT)).cast("string"))
        asked = F.when(F.col(near).isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(dealt)
        rest = entries.select(F.col(known), F.col(near).alias(output))
        joined = first.withColumn(key, asked).join(rest, F.col(key) == F.col(known), "left")
        return joined.withColumn(output, F.coalesce(near, output)).drop(key, known, near)


def build(df: DataFrame, columns: Sequence[str]) -> Dictionary:
    """The dictionary of the non-null values of some columns, as text."""
    return of_table(positions(category_counts(df, columns), ["column"], "value"))


def of_table(table: DataFrame) -> Dictionary:
    """From a table of TABLE, as it is written and read."""
    # one row per column of the contract
    sizes = table.groupBy("column").agg(F.count(F.lit(1)).alias("values"), F.sum(F.octet_length("value")).alias("size")).collect()
    return Dictionary(table, {r["column"]: (r["values"], r["size"]) for r in sizes})


def of_values(spark: SparkSession, values: Mapping[str, Sequence[str]]) -> Dictionary:
    """From lists of known values."""
    rows = [(c, v, 1, i) for c, known in values.items() for i, v in enumerate(sorted(set(known)))]
    return of_table(spark.createDataFrame(rows, TABLE))
