"""The log of runs as JSON lines: append and read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "dag_id string, run_id string, status string, started_at timestamp, finished_at timestamp, log_path string, tasks array<struct<name:string,attempt:int,exit_code:int>>"


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Damaged lines come out as rows of NULLs."""
    return spark.read.schema(SCHEMA).json(path)


def last(df: DataFrame, n: int = 20) -> DataFrame:
    return df.orderBy(F.desc_nulls_last("started_at"), "run_id").limit(n)
