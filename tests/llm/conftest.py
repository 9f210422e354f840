import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conftest_llm import EDGES, SCHEMA, corpus, table  # noqa: E402


@pytest.fixture(scope="session")
def documents(spark):
    return table(spark, corpus()).cache()


@pytest.fixture(scope="session")
def edges(spark):
    """Edge rows with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    clash = ["id", "node", "bucket", "block", "seed", "version", "spans", "term", "token", "row", "place", "range", "set", "epoch", "part",
             "copy", "times", "copy number", "one", "kept_id", "own_source", "text_", "rank", "score"]
    return table(spark, EDGES).withColumns({c: F.lit(c) for c in clash}).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 1), (3, 1, 1)], "doc_id bigint, quality int, toxic int")
