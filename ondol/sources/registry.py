"""The registry of boards: a YAML or JSON file, validated, as a small frame."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession

FETCHERS = ("Fetcher", "StealthyFetcher", "DynamicFetcher")
STATUSES = ("active", "disabled")
SCHEMA = "name string, display_name string, base_url string, list_path string, fetcher_type string, delay_sec double, concurrent_requests int, status string"
ENV, PLACES = "ONDOL_SOURCES", ("config/sources.yml", "/app/config/sources.yml")


def load(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The registry at ``path``, at the place that the environment names, or at one of ``PLACES``. Unknown fetchers and states, negative delays and
    repeated names are refused."""
    path = path or os.environ.get(ENV) or next((p for p in PLACES if os.path.exists(p)), None)
    if not path:
        raise FileNotFoundError(f"no registry: name one, set {ENV}, or put it at one of {', '.join(PLACES)}")
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            data = json.load(f)
        else:
            import yaml

            data = yaml.safe_load(f)
    rows, names = [], set()
    for x in data["sources"]:
        row = {"display_name": x["name"], "list_path": "/", "fetcher_type": FETCHERS[0], "delay_sec": 2.0, "concurrent_requests": 1, "status": "active"} | x
        problems = [
            row["fetcher_type"] not in FETCHERS and f"unknown fetcher {row['fetcher_type']}",
            row["status"] not in STATUSES and f"unknown status {row['status']}",
            row["delay_sec"] < 0 and "negative delay",
            row["concurrent_requests"] < 1 and "no concurrent request",
            row["name"] in names and "repeated name",
        ]
        if any(problems):
            raise ValueError(f"{row['name']}: {', '.join(p for p in problems if p)}")
        names.add(row["name"])
        rows.append(tuple(float(row[c]) if c == "delay_sec" else row[c] for c in (part.split()[0] for part in SCHEMA.split(", "))))
    return spark.createDataFrame(rows, SCHEMA)


def active(df: DataFrame) -> DataFrame:
    return df.where("status = 'active'")
