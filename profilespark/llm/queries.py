"""Registered queries of the training-data operators: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: SQL of the queries that have a SQL form; the others are held against brute force in tests/llm
ORACLES: dict[str, str] = {}

PIECE_MODEL = "piece_bpe_32k.model"


def query(name: str) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> str:
    """Where this machine keeps the public piece vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(PIECE_MODEL)


@query("op2_secrets")
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profilespark.llm import secrets

    return secrets.summary(table(spark, sf_dir, "documents"))


@query("op4_pieces")
def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profilespark.llm import pieces

    return pieces.digests(table(spark, sf_dir, "documents"), piece_model())


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profilespark.llm import quality

    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profilespark.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query("op10_mixing")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every draw: documents of a source appear once per epoch that draws them."""
    from profilespark.llm import mixing

    return mixing.mixed(table(spark, sf_dir, "documents"))


@query("op7_imatch")
def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profilespark.llm import imatch

    docs = table(spark, sf_dir, "documents")
    return imatch.compare_neighbours(docs, imatch.lexicon(docs))


@query("op8_jaccard")
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profilespark.llm import jaccard

    return jaccard.join(table(spark, sf_dir, "documents"))


@query("op9_relative")
def op9_relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profilespark.llm import relative

    return relative.dedup(table(spark, sf_dir, "documents"))


@query("op1_suffix")
def op1_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profilespark.llm import substring

    return substring.dedup(table(spark, sf_dir, "documents"))


@query("op3_pitman")
def op3_pitman(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profilespark.llm import pitman

    docs = table(spark, sf_dir, "documents")
    return pitman.score(docs, pitman.fit(docs))


@query("op11_resample")
def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profilespark.llm import resample

    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_pages")
def op12_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profilespark.llm import pages

    rows = table(spark, sf_dir, "pages")
    return pages.extract(rows, pages.fit(rows))


@query("op13_periodic")
def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, by id, has its tail made periodic first."""
    from profilespark.llm import periodic

    return periodic.detect(table(spark, sf_dir, "documents"), change=periodic.planted)
