"""The corpus pipeline: five stages, each on everything that the stage before has kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. All but the last return the columns of `documents`.

Every stage reads the columns of `documents` alone, so that other columns, whatever their names, are left out. Null and empty texts
pass through all stages. A row's identity is its id and its text: rows that share an id, or have none, are kept or dropped each by itself.
An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from profilespark.llm import jaccard, mixing, pieces, secrets, toxicity
from profilespark.llm.queries import piece_model, table
from profilespark.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; fitted on the labels of these documents.

    Texts without words stay. Labels of one kind only, or too few of either to fit on, stop the run; if no document has a label, all stay.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs.select(*COLUMNS), model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id (a null id comes last), then by a hash of the text.

    Of rows equal in id and text one stays; texts without words are near duplicates of nothing else.
    """
    return jaccard.one_of_each(docs.select(*COLUMNS))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by the name of its kind; a null text stays null."""
    return secrets.redacted(docs.select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and those of sources below their target weight again as often as it asks for. A null source is one of its own."""
    return mixing.repeated_rows(docs.select(*COLUMNS))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, ending with the end id, beside the documents' other columns; a null text has the end id alone."""
    return pieces.with_ids(docs.select(*COLUMNS), piece_model())


STAGES = [
    ("toxicity", without_toxic),
    ("jaccard", one_of_each_group),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("pieces", encoded),
]

#: no stage but the mixing has a SQL form; tests/llm holds the pipeline against the operators' brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written to the checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
