"""Sinks: one folder per result table, and JSON rows without non-finite numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilespark.functions.clean import quoted


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def _without_non_finite(col: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col) & (F.abs(col) != float("inf")), col)
    if isinstance(data_type, T.ArrayType):
        return F.transform(col, lambda x: _without_non_finite(x, data_type.elementType))
    if isinstance(data_type, T.StructType):
        fields = [
            _without_non_finite(col.getField(f.name), f.dataType).alias(f.name) for f in data_type.fields
        ]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(data_type, T.MapType):
        return F.transform_values(col, lambda _, v: _without_non_finite(v, data_type.valueType))
    return col


def result_json(df: DataFrame) -> DataFrame:
    """Each row as one JSON text; NaN and infinities become null at every depth."""
    fields = [_without_non_finite(F.col(quoted(f.name)), f.dataType).alias(f.name) for f in df.schema.fields]
    options = {"ignoreNullFields": "false"}
    return df.select(F.to_json(F.struct(*fields), options).alias("value"))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    result_json(df).write.mode(mode).text(path)
