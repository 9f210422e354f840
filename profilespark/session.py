"""Session helpers: a local builder for tests and bench, and durable cut points."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "profilespark", **conf) -> SparkSession:
    """A local session; on a cluster the caller's own session is used as it is."""
    settings = {
        "spark.sql.shuffle.partitions": str(cpus if str(cpus).isdigit() else 8),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Directory for cut points: what `spark.checkpoint.dir` names; on a cluster it has to name one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach.")
        # one machine, no setting: a folder of this run's own, which goes when it ends
        shared = tempfile.mkdtemp(prefix="profilespark-checkpoint-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    sc.setCheckpointDir(shared)
    return shared


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared checkpoint folder and read it back as a table.

    Used where one result feeds many jobs (folds, fits, restarts). The data is in
    reliable storage, so a lost executor never makes the lineage run again, and later
    jobs still read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
