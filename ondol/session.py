"""Session factory and the few places that need the session's settings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TESTDATA = "/root/testdata"


def session(app: str = "ondol", master: str | None = None, **conf: object) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` overrides single settings (dots as ``__``)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    settings |= {k.replace("__", "."): str(v) for k, v in conf.items()}
    return b.config(map=settings).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); a temporary one only where the session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        # executors of a cluster can't see each other's folders; only a session in one process may do without a shared one
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = os.path.join(tempfile.gettempdir(), f"ondol-{os.getpid()}")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder for a table that cuts lineage."""
    return f"{_own(spark)}/{what}-{uuid.uuid4().hex}"


def _own(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/ondol-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete all tables that this application wrote to the shared folder; frames that read them are of no more use."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage and survives the loss of executors."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The frame over at least as many partitions as there are cores, for Python passes over a few files that can't be split.
    Inputs of as many partitions as cores, hence all large ones, aren't moved."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
