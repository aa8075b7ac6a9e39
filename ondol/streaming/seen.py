"""Streams of page sightings: first sightings by source and URL, the late gate, and the sets of URLs with a time to live."""

from __future__ import annotations

import os
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch


def read_table(spark: SparkSession, sf_dir: str, name: str, max_files: int = 4) -> DataFrame:
    """A table of a data directory as a stream of its files."""
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return reader.parquet(path if os.path.isdir(path) else f"{sf_dir}/{name}.parque[t]")


def run(stream: DataFrame, what: str, mode: str = "append") -> DataFrame:
    """Processes all that is there and returns the sink's table."""
    path = scratch(stream.sparkSession, what)
    query = stream.writeStream.outputMode(mode).format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


def first_sightings(stream: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key ever seen; the state holds the keys."""
    return stream.select(*keys).dropDuplicates(keys)


def admitted(stream: DataFrame, day: Column, today: Column, days: int) -> DataFrame:
    """The late gate: rows older than the cutoff are dropped, rows without a day pass. It needs no watermark."""
    return stream.where(day.isNull() | (day >= F.date_sub(today, days)))


class SeenSet:
    """The URLs seen, a set for each source, as two append-only tables in the shared folder.

    A set lives ``ttl`` seconds after the last time that it got a new URL; then all of it is forgotten: the source goes on with a
    new generation. Sets are spread by URL, so that a source of any size is joined, never grouped. Times are epoch seconds.
    """

    URLS, MARKS = "source string, url string, generation long", "source string, generation long, at long"

    def __init__(self, spark: SparkSession, path: str | None = None, ttl: int = 14 * 86400):
        self.spark, self.path, self.ttl = spark, path or scratch(spark, "seen"), ttl

    def _table(self, name: str, schema: str) -> DataFrame:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        there = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if there else self.spark.createDataFrame([], schema)

    def generations(self, now: int) -> DataFrame:
        """(source, generation, alive): the last generation of each source and whether it still lives."""
        last = self._table("marks", self.MARKS).groupBy("source").agg(F.max("generation").alias("generation"), F.max_by("at", F.struct("generation", "at")).alias("at"))
        return last.select("source", "generation", (F.lit(now) - F.col("at") <= self.ttl).alias("alive"))

    def current(self, now: int) -> DataFrame:
        """(source, url): what the sets hold."""
        return self._table("urls", self.URLS).join(self.generations(now).where("alive"), ["source", "generation"]).select("source", "url")

    def unseen(self, rows: DataFrame, now: int) -> DataFrame:
        """The rows (source, url) whose URL isn't in the set of their source."""
        return rows.join(self.current(now), ["source", "url"], "left_anti")

    def mark(self, rows: DataFrame, now: int) -> DataFrame:
        """Adds the URLs of rows (source, url); gives those that are new, each once. NULLs are no URLs."""
        new = self.unseen(rows.select(F.col("source").cast("string"), F.col("url").cast("string")).where("source is not null and url is not null").distinct(), now)
        next_ = F.coalesce(F.when(F.col("alive"), F.col("generation")).otherwise(F.col("generation") + 1), F.lit(0))
        new = materialize(new.join(self.generations(now), "source", "left").select("source", "url", next_.cast("long").alias("generation")), "new")
        new.write.mode("append").parquet(f"{self.path}/urls")
        new.groupBy("source", "generation").agg(F.lit(now).cast("long").alias("at")).write.mode("append").parquet(f"{self.path}/marks")
        return new.select("source", "url")

    def count(self, now: int) -> DataFrame:
        """(source, n)."""
        return self.current(now).groupBy("source").agg(F.count(F.lit(1)).alias("n"))

    def clear(self, source: str, now: int) -> None:
        """Forgets the set of a source: its generation ends."""
        old = self.generations(now).where(F.col("source") == source).select("source", (F.col("generation") + 1).alias("generation"), F.lit(now).cast("long").alias("at"))
        materialize(old, "cleared").write.mode("append").parquet(f"{self.path}/marks")


def mark_after_sink(stream: DataFrame, source: str, url: str, at: str, seen: SeenSet) -> DataFrame:
    """The new (source, url) of each micro-batch, written first and marked after it: a batch that fails before its mark is done
    again, and its part of the output is overwritten. The time of a batch is the latest of its rows."""
    out = scratch(stream.sparkSession, "marked")

    def batch(rows: DataFrame, number: int) -> None:
        rows = materialize(rows.select(F.col(source).cast("string").alias("source"), F.col(url).cast("string").alias("url"), F.unix_seconds(F.col(at).cast("timestamp")).alias("at")), "batch")
        now = rows.agg(F.max("at")).first()[0]
        if now is None:
            return
        wanted = rows.where("source is not null and url is not null").select("source", "url").distinct()
        seen.unseen(wanted, now).write.mode("overwrite").parquet(f"{out}/{number:09d}")
        seen.mark(wanted, now)

    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return stream.sparkSession.read.schema("source string, url string").option("recursiveFileLookup", "true").parquet(out)


def windowed_counts(stream: DataFrame, at: str, kind: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts by tumbling window and kind, rows later than the watermark left out."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), kind, "n")
