"""Scans. Delimited files are read as text; the contract, not inference, types them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from profilespark.functions.clean import na_tokens_to_null, quoted

FORMATS = {
    ".csv": "csv", ".tsv": "tsv", ".json": "json", ".jsonl": "json", ".ndjson": "json",
    ".parquet": "parquet", ".orc": "orc",
}


def read_csv_text(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """A delimited file with a header, every column text, missing-value words as null."""
    raw = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("inferSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", False)
        .csv(path)
    )
    return raw.select(*[na_tokens_to_null(F.col(quoted(c))).alias(c) for c in raw.columns])


def _suffix(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    for compression in (".gz", ".bz2", ".zst", ".snappy"):
        name = name.removesuffix(compression)
    return "." + name.rsplit(".", 1)[-1] if "." in name else ""


def read_table(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Scan by format name or by suffix; a missing path or an unknown format raises."""
    kind = fmt or FORMATS.get(_suffix(path))
    if kind is None or kind not in set(FORMATS.values()):
        raise ValueError(
            f"Unsupported table format: {fmt or _suffix(path) or path}. "
            f"Use one of {sorted(set(FORMATS.values()))}."
        )
    try:
        if kind in ("csv", "tsv"):
            return read_csv_text(spark, path, sep="," if kind == "csv" else "\t")
        return spark.read.format(kind).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"Table not found: {path}") from error
        raise


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of each file under `path`. One file is one row; files are hashed in tasks."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", F.sha2("content", 256).alias("sha256"))
    )


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Order-free content fingerprint: row count, sum and xor of the row hashes.

    One partial aggregation per task, one row out. The xor alone would cancel equal
    rows, the exact decimal sum does not.
    """
    row_hash = F.xxhash64(*[F.col(quoted(c)) for c in sorted(df.columns)])
    return df.select(row_hash.alias("h")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("h").cast(T.DecimalType(38, 0))).cast("string").alias("hash_sum"),
        F.bit_xor("h").alias("hash_xor"),
    )


def source_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, length, sha256) of the files under `path`, named from there. Files are hashed in tasks; one over 2 GB can't be read that way."""
    spark_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = spark_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(spark_path).toString().rstrip("/")
    named = F.regexp_replace(F.col("path"), f"^{re.escape(root)}/?", "")
    files = file_fingerprints(spark, path).withColumn("file", F.when(named == "", F.element_at(F.split("path", "/"), -1)).otherwise(named))
    return files.select("file", "length", "sha256")


def manifest_changes(current: DataFrame, expected: DataFrame) -> DataFrame:
    """(file, status): same, changed, missing (expected only) or new (there is none to compare with)."""
    now, then = current.select("file", F.col("sha256").alias("_now")), expected.select("file", F.col("sha256").alias("_then"))
    status = (
        F.when(F.col("_then").isNull(), "new").when(F.col("_now").isNull(), "missing")
        .when(F.col("_now") == F.col("_then"), "same").otherwise("changed")
    )
    return now.join(then, "file", "full").select("file", status.alias("status"))


#: changed files that a note names
NAMED_FILES = 20


def manifest_notes(changes: DataFrame) -> list[str]:
    """A sentence per kind of change, with the first files of it; none if every file is as expected."""
    found = changes.filter("status <> 'same'").groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("first")).orderBy("status")
    notes = []
    for r in found.collect():  # three kinds at most
        names = [x.file for x in changes.filter(F.col("status") == r.status).orderBy("file").limit(NAMED_FILES).collect()]
        more = f" and {r.n - len(names)} more" if r.n > len(names) else ""
        notes.append(f"The training data differs from what the bundle was made of: {r.n} {r.status} ({', '.join(names)}{more}).")
    return notes
