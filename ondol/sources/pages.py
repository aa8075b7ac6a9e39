"""A page source for Spark: ``spark.read.format("pages")`` fetches URLs in partitions, with retries and a pluggable fetcher.

Options: ``urls`` (lines), ``fetcher`` (directory: files under ``root``; http: plain requests), ``root``, ``attempts``,
``backoff`` (seconds, doubling), ``partitions``. A page with a ban or challenge isn't retried.
"""

from __future__ import annotations

import time
from pathlib import Path
from urllib.parse import urlsplit

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "url string, html_content string, http_status int, error string"
#: Marks of challenge pages, in lower case.
CHALLENGES = ["cf-browser-verification", "cf-chl-bypass", "__cf_chl_jschl_tk__", "checking your browser before accessing", 'name="cf-turnstile-response"']


def banned(status: Column, html: Column) -> Column:
    """Whether a page is a refusal or a challenge."""
    low = F.lower(F.coalesce(html, F.lit("")))
    out = F.coalesce(status.isin(403, 429), F.lit(False))
    for mark in CHALLENGES:
        out = out | low.contains(mark)
    return out


def _directory(url: str, options: dict) -> tuple[int, str]:
    name = urlsplit(url).path.strip("/").replace("/", "_") or "index"
    file = Path(options["root"]) / f"{name}.html"
    return (200, file.read_text(encoding="utf-8")) if file.is_file() else (404, "")


def _http(url: str, options: dict) -> tuple[int, str]:
    from urllib.error import HTTPError
    from urllib.request import urlopen

    try:
        with urlopen(url, timeout=30) as r:
            return r.status, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")
    except HTTPError as e:
        return e.code, ""


FETCHERS = {"directory": _directory, "http": _http}


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        if options.get("fetcher", "directory") not in FETCHERS:
            raise ValueError(f"unknown fetcher {options['fetcher']}")

    def partitions(self):
        urls = [u for u in self.options.get("urls", "").split("\n") if u.strip()]
        n = max(1, min(int(self.options.get("partitions", 8)), len(urls)))
        return [InputPartition(urls[k::n]) for k in range(n)]

    def read(self, partition):
        fetch, attempts = FETCHERS[self.options.get("fetcher", "directory")], int(self.options.get("attempts", 3))
        for url in partition.value:
            status, html, error = None, None, None
            for n in range(attempts):
                try:
                    status, html = fetch(url, self.options)
                    error = None
                    break
                except Exception as e:  # the page is retried, then reported
                    error = f"{type(e).__name__}: {e}"
                    if n + 1 < attempts:
                        time.sleep(float(self.options.get("backoff", 5)) * 2**n)
            yield url, html, status, error


class PageSource(DataSource):
    @classmethod
    def name(cls):
        return "pages"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PageSource)
