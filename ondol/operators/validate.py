"""Checks of a run's quality as one-row frames (check, passed, hard, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _check(df: DataFrame, name: str, value: Column, passed: Column, hard: bool) -> DataFrame:
    return df.select(F.lit(name).alias("check"), F.coalesce(passed, F.lit(True)).alias("passed"), F.lit(hard).alias("hard"), F.round(value, 6).alias("value"))


def null_rate(df: DataFrame, columns: list[str], limit: float = 0.20) -> DataFrame:
    """The largest share of NULLs of the columns; passes without rows."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"_{k}") for k, c in enumerate(columns)])
    worst = F.greatest(*[F.col(f"_{k}") for k in range(len(columns))]) if len(columns) > 1 else F.col("_0")
    rate = F.try_divide(worst, F.col("n"))
    return _check(counts, "null_rate", rate, rate <= limit, True)


def orphans(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    n = df.join(other.select(*keys), keys, "left_anti").agg(F.count(F.lit(1)).cast("double").alias("n"))
    return _check(n, "fk_integrity", F.col("n"), F.col("n") == 0, True)


def success_rate(df: DataFrame, good: str, bad: str, least: float = 0.10) -> DataFrame:
    sums = df.agg(F.sum(good).alias("g"), F.sum(bad).alias("b"))
    rate = F.try_divide(F.col("g"), F.col("g") + F.col("b"))
    return _check(sums, "success_rate", rate, rate >= least, True)


def row_count(df: DataFrame, current: Column, average: Column, least: float = 0.5) -> DataFrame:
    """Soft: a run's rows against the average of earlier runs; passes without an average."""
    ratio = F.try_divide(current, average)
    return _check(df, "parsed_rows", ratio, ratio >= least, False)


MESSAGES = {  # check -> the format of its message and the factor of its value
    "parsed_rows": ("rows are %.0f%% of the average of earlier runs", 100.0), "transform_success_rate": ("%.1f%% of the rows were transformed", 100.0), "success_rate": ("%.1f%% of the rows were transformed", 100.0),
    "null_rate": ("%.2f%% of the values of the worst column are missing", 100.0), "fk_integrity": ("%.0f rows of unknown sources", 1.0),
}


class ValidationError(ValueError):
    """A hard check failed."""


def with_messages(checks: DataFrame) -> DataFrame:
    """Adds ``message``; a check without a value says so."""
    out = F.lit("nothing to check")
    for name, (form, factor) in MESSAGES.items():
        out = F.when((F.col("check") == name) & F.col("value").isNotNull(), F.format_string(form, F.col("value") * factor)).otherwise(out)
    return checks.withColumn("message", out)


def summary(checks: DataFrame) -> DataFrame:
    """(passed, total)."""
    return checks.agg(F.count_if("passed").alias("passed"), F.count(F.lit(1)).alias("total"))


def run(checks: DataFrame, run_id: object = None) -> dict:
    """The report of a run (run_id, checks, passed, soft_warning) in the order of the checks; a hard check that failed raises. The
    checks are a handful of rows."""
    rows = with_messages(checks).collect()
    hard = [r["check"] for r in rows if r.hard and not r.passed]
    if hard:
        raise ValidationError(f"Validation failed on hard constraints: {', '.join(hard)}")
    return {"run_id": run_id, "checks": [{"name": r["check"], "passed": r.passed, "message": r.message} for r in rows], "passed": True, "soft_warning": any(not r.passed for r in rows)}


def report(*checks: DataFrame) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out
