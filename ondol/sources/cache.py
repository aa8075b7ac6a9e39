"""A lookup cache with a time to live: cached rows are joined, only distinct misses are looked up; failures aren't cached."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CACHE = "key string, value string, cached_at timestamp"


def query_text(*parts: Column) -> Column:
    """The parts joined by ', ', without leading and trailing commas and blanks."""
    return F.regexp_replace(F.concat_ws(", ", *[F.coalesce(p, F.lit("")) for p in parts]), r"^[, ]+|[, ]+$", "")


def cache_key(text: Column, prefix: str = "geocode:") -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, 16))


def fresh(cache: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """The newest value of each key that has not expired."""
    return cache.where(F.col("cached_at") >= now - F.make_dt_interval(F.lit(days))).groupBy("key").agg(F.max_by("value", "cached_at").alias("value"))


def point(value: Column) -> Column:
    """'lat,lon' as a point, NULL where it isn't one."""
    p = F.split(value, ",")
    lat, lon = F.get(p, F.lit(0)).try_cast("double"), F.get(p, F.lit(1)).try_cast("double")
    return F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat")))


def resolve(rows: DataFrame, text: Column, cache: DataFrame, now: Column, lookup: Callable[[str], str | None] | None = None, days: int = 30, interval: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """(rows with ``point``, new cache rows). ``lookup`` gives 'lat,lon' or None and runs once for each distinct miss;
    with an ``interval`` (seconds between two lookups) all misses are asked by one task, since the service's limit is global."""
    keyed = rows.withColumns({"_text": text, "key": cache_key(text)})
    known = fresh(cache, now, days)
    misses = keyed.where("_text <> ''").select("key", "_text").distinct().join(known, "key", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = []
            for t in pdf["_text"]:
                began = time.monotonic()
                values.append(lookup(t) if lookup else None)
                time.sleep(max(0.0, interval - (time.monotonic() - began)))
            yield pd.DataFrame({"key": pdf["key"], "value": values}).dropna()

    new = (misses.coalesce(1) if interval else misses).mapInPandas(run, "key string, value string")
    joined = keyed.join(known.unionByName(new), "key", "left").withColumn("point", point(F.col("value"))).drop("_text", "key", "value")
    return joined, new.withColumn("cached_at", now)
