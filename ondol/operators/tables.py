"""Insert-ignore, upsert, update and delete on snapshots: read, compute the new snapshot, write a version, move the pointer."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _same(keys: list[str], a: str, b: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


def last_writer(new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key: the one with the largest order. A hot key costs one aggregate, not a sort of its rows."""
    rest = [c for c in new.columns if c not in keys]
    return new.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*new.columns)


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The rows of ``new`` to append: the first by ``order`` of each key that ``old`` lacks. NULL keys are equal to each other."""
    rest = [c for c in new.columns if c not in keys]
    first = new.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*new.columns)
    return first.alias("n").join(old.select(*keys).alias("o"), _same(keys, "n", "o"), "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep: list[str] = (), on_update: dict[str, Column] | None = None) -> DataFrame:
    """The merged snapshot with the columns of ``old``. ``new`` has one row a key. A match takes the columns of ``new`` (NULLs
    too), but for ``keep``; ``on_update`` gives columns of matches and of inserted rows, over the new row's columns."""
    on_update = on_update or {}
    o, n = old.withColumn("_o", F.lit(1)).alias("o"), new.withColumn("_n", F.lit(1)).withColumns(on_update).alias("n")
    both = o.join(n, _same(keys, "o", "n"), "full")
    columns = []
    for c in old.columns:
        mine, theirs = F.col(f"o.{c}"), F.col(f"n.{c}") if c in n.columns else F.lit(None)
        value = F.when(F.col("n._n").isNull(), mine).when(F.col("o._o").isNull(), theirs).otherwise(mine if c in keep or c not in n.columns else theirs)
        columns.append(value.alias(c))
    return both.select(*columns)


def update_where(df: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in changes.items()})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(~F.coalesce(condition, F.lit(False)))


class SnapshotTable:
    """A versioned Parquet table: each write is a new directory, a small pointer file names the current one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int:
        pointer = self._path(f"{self.path}/current.json")
        if not self._fs.exists(pointer):
            return 0
        return json.loads(self.spark.read.text(f"{self.path}/current.json").first()[0])["version"]

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v{self.version()}")

    def write(self, df: DataFrame) -> int:
        v = self.version() + 1
        df.write.mode("overwrite").parquet(f"{self.path}/v{v}")
        # the pointer is written beside the old one and renamed over it, so that no reader finds it missing or empty
        aside, pointer = self._path(f"{self.path}/current-{v}.tmp"), self._path(f"{self.path}/current.json")
        out = self._fs.create(aside, True)
        out.write(bytearray(json.dumps({"version": v}).encode()))
        out.close()
        gateway = self.spark.sparkContext._gateway
        rename = gateway.jvm.org.apache.hadoop.fs.Options.Rename
        options = gateway.new_array(rename, 1)
        options[0] = rename.valueOf("OVERWRITE")
        context = gateway.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(aside, pointer, options)
        return v
