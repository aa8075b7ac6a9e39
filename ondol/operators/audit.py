"""The audit of runs as an append-only table of events; the state of a run is a view of its events.

A run is started, its counters are incremented, and it is finished once. Increments are rows, so that writers never update.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COUNTERS = ("rows_extracted", "rows_transformed", "rows_loaded", "rows_failed")
EVENTS = "id long, event string, dag_id string, task_id string, run_id string, source_name string, status string, at timestamp, " + ", ".join(f"{c} long" for c in COUNTERS) + ", error_message string"


def run_id(now: Column, kind: str = "scheduled") -> Column:
    """'scheduled__<UTC time in ISO form>' or 'cli_<time>'."""
    return F.concat(F.lit("scheduled__"), F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")) if kind == "scheduled" else F.concat(F.lit("cli_"), F.date_format(now, "yyyyMMdd_HHmmss"))


def _event(spark: SparkSession, **values: object) -> DataFrame:
    names = [p.split()[0] for p in EVENTS.split(", ")]
    return spark.createDataFrame([tuple(values.get(n) for n in names)], EVENTS)


def start(spark: SparkSession, id_: int, at, **named: object) -> DataFrame:
    """The event of a run that begins; ``named`` are dag_id, task_id, run_id and source_name."""
    return _event(spark, id=id_, event="start", status="running", at=at, **named)


def increment(spark: SparkSession, id_: int, at, **counters: int) -> DataFrame:
    """The event that adds to the counters of a run."""
    return _event(spark, id=id_, event="add", at=at, **counters)


def finish(spark: SparkSession, id_: int, at, status: str = "success", error_message: str | None = None, **counters: int) -> DataFrame:
    """The event of a run that ends; its counters (0 where none is given) replace what was added before."""
    return _event(spark, id=id_, event="finish", status=status, at=at, error_message=error_message, **({c: 0 for c in COUNTERS} | counters))


def runs(events: DataFrame) -> DataFrame:
    """One row a run: the start's names, the counters (those of the finish, else the sums of the increments), the status, the
    times and the seconds between them, NULL while the run goes on. Of several finishes the last counts."""
    is_ = lambda e: F.col("event") == e
    first = lambda c: F.max(F.when(is_("start"), F.col(c))).alias(c)
    ends = F.max_by(F.struct("status", "error_message", *COUNTERS), F.when(is_("finish"), F.col("at")))
    sums = [F.sum(F.when(is_("add"), F.coalesce(c, F.lit(0)))).alias(f"_{c}") for c in COUNTERS]
    wide = events.groupBy("id").agg(*[first(c) for c in ("dag_id", "task_id", "run_id", "source_name")], F.min(F.when(is_("start"), F.col("at"))).alias("started_at"), F.max(F.when(is_("finish"), F.col("at"))).alias("finished_at"), ends.alias("_end"), *sums)
    done = F.col("finished_at").isNotNull()
    counters = [F.coalesce(F.when(done, F.col(f"_end.{c}")).otherwise(F.col(f"_{c}")), F.lit(0)).alias(c) for c in COUNTERS]
    seconds = (F.unix_seconds("finished_at") - F.unix_seconds("started_at")).alias("duration_sec")
    return wide.select("id", "dag_id", "task_id", "run_id", "source_name", F.when(done, F.col("_end.status")).otherwise("running").alias("status"), *counters, F.when(done, F.col("_end.error_message")).alias("error_message"), "started_at", "finished_at", seconds)


def last(view: DataFrame, n: int, source: str | None = None) -> DataFrame:
    """The last n runs, of one source if it is named."""
    return optional(view, "source_name", source).orderBy(F.desc("started_at"), F.desc("id")).limit(n)


def resolve(view: DataFrame, name: str, task: str = "transform") -> DataFrame:
    """The run that a text names: the one with this number if there is one, else the latest with this run id and task."""
    number = view.where(F.col("id") == F.lit(name).try_cast("long")).select(F.col("id"), F.lit(0).alias("_k"))
    named = view.where((F.col("run_id") == name) & F.col("task_id").startswith(task)).select("id", F.lit(1).alias("_k"))
    return number.unionByName(named).orderBy("_k", F.desc("id")).limit(1).select("id")


def optional(df: DataFrame, column: str, value: object | None) -> DataFrame:
    """The rows with a value, all of them where none is asked for."""
    return df if value is None else df.where(F.col(column) == F.lit(value))


def in_interval(rows: DataFrame, at: str, intervals: DataFrame, start_: str, end: str, keys: list[str], hours: int = 24) -> DataFrame:
    """The pairs of rows and intervals of equal keys with ``at`` between start and end, both included: an equality join on slots
    of ``hours``, so that an interval meets only the rows of its slots. Intervals that end before they start hold nothing."""
    slot = lambda c: F.floor(F.unix_seconds(c) / (3600 * hours))
    wide = intervals.where(F.col(end) >= F.col(start_)).withColumn("_slot", F.explode(F.sequence(slot(start_), slot(end))))
    return rows.withColumn("_slot", slot(at)).join(wide, [*keys, "_slot"]).where(F.col(at).between(F.col(start_), F.col(end))).drop("_slot")
