"""Session settings and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app: str = "adsettle", **extra: str) -> SparkSession:
    """A session with the settings above. Master, memory and shuffle width belong to the cluster."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def activate(spark: SparkSession) -> None:
    """Make the session that of the current thread, where Spark looks for a registered format that is written."""
    spark.sparkContext._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(spark._jsparkSession)


def staging_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder of its own, once.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return qualified(spark, folder)
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "file:" + _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"adsettle-{application}-")


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme, as Spark resolves it, so that tasks opening files agree with Spark."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return store.makeQualified(hadoop).toString().rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the staging folder."""
    return f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: what follows survives lost executors without redoing the work above it, and
    every later pass sees the same rows.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
