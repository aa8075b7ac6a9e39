from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ondol.operators.timestamps import TimestampDictionary, normalised_times, statements, utc_text

LA, SEOUL = "America/Los_Angeles", "Asia/Seoul"
CASES = [
    ("2024-06-01T16:10:02-04:00", LA, "2024-06-01T20:10:02Z"),
    ("2024-05-31 22:47:36", LA, "2024-06-01T05:47:36Z"),
    ("2024-06-01 18:44:05 KST", LA, "2024-06-01T09:44:05Z"),
    ("Sun, 02 Jun 2024 12:42:14 -0700", SEOUL, "2024-06-02T19:42:14Z"),
    ("Jun 10, 2024 1:44 AM PDT", SEOUL, "2024-06-10T08:44:00Z"),
    ("1717213598", LA, "2024-06-01T03:46:38Z"),
    ("1717398122578", LA, "2024-06-03T07:02:02Z"),
    ("20240602T220611Z", LA, "2024-06-02T22:06:11Z"),
    ("24.06.04 05:51", SEOUL, "2024-06-03T20:51:00Z"),
    ("2024. 06. 01. 14:09", LA, "2024-06-01T21:09:00Z"),
    ("06/12/2024 12:19 AM", LA, "2024-06-12T07:19:00Z"),
    ("06/12/2024", LA, "2024-06-12T07:00:00Z"),
    ("2024년 6월 15일(토) 오후 12시 22분", SEOUL, "2024-06-15T03:22:00Z"),
    ("2024-06-02T02:42:53.960535Z", LA, "2024-06-02T02:42:53Z"),
    ("2024-11-03 01:30", LA, "2024-11-03T08:30:00Z"),  # twice: the first
    ("2025-03-09 02:30", LA, "2025-03-09T10:30:00Z"),  # skipped: the offset before
    ("0000-00-00", LA, None),
    ("2024-02-30", LA, None),
    ("2024-06-01 10:00", None, None),
    ("상시", LA, None),
    ("", LA, None),
    (None, LA, None),
]


def test_forms(spark):
    df = spark.createDataFrame([(k, t, z) for k, (t, z, _) in enumerate(CASES)], "k int, raw string, zone string")
    book = TimestampDictionary(spark)
    book.extend(df)
    got = {r.k: r.t for r in book.normalise(df).select("k", utc_text(F.col("epoch")).alias("t")).collect()}
    assert got == {k: t for k, (_, _, t) in enumerate(CASES)}


def test_dictionary_grows_only_by_what_is_new(spark):
    book = TimestampDictionary(spark)
    one = spark.createDataFrame([("2024-06-01", LA)] * 3, "raw string, zone string")
    book.extend(one)
    book.extend(one.unionByName(spark.createDataFrame([("2024-06-02", LA), ("2024-06-01", None)], "raw string, zone string")))
    assert rows(book.table(), "raw", "zone") == [("2024-06-01", LA), ("2024-06-01", None), ("2024-06-02", LA)]


def test_relative_times_count_from_the_fetch(spark):
    at = datetime(2024, 6, 12, 12, 0, tzinfo=timezone.utc)
    df = spark.createDataFrame([("14 hours ago", LA, at), ("9분 전", LA, at), ("어제 05:52", LA, at), ("Yesterday 23:10", SEOUL, at)], "raw string, zone string, f timestamp")
    book = TimestampDictionary(spark)
    book.extend(df)
    got = {r.raw: r.t for r in book.normalise(df, F.col("f")).select("raw", utc_text(F.col("epoch")).alias("t")).collect()}
    assert got == {"14 hours ago": "2024-06-11T22:00:00Z", "9분 전": "2024-06-12T11:51:00Z", "어제 05:52": "2024-06-11T12:52:00Z", "Yesterday 23:10": "2024-06-11T14:10:00Z"}


def test_the_more_exact_statement_counts(spark):
    html = "<meta property='article:published_time' content='2024-06-03T05:01:32Z'><span>등록일</span> <span>2024.06.02</span> <span>수정</span> <span>2024-06-08</span>"
    df = spark.createDataFrame([(1, 1, html, datetime(2024, 6, 4, tzinfo=timezone.utc)), (2, 1, None, None), (3, 9, "<p>none</p>", None)], "id long, source_id int, html_content string, fetched_at timestamp")
    assert sorted(df.select(statements(F.col("html_content"))).first()[0]) == ["2024-06-03T05:01:32Z", "2024.06.02"]
    sources = spark.createDataFrame([(1, LA)], "id int, time_zone string")
    listings = spark.createDataFrame([(7, 1, "2024-06-01T00:00:00Z"), (8, 1, "2024-06-01"), (9, 5, "2024-06-01"), (10, None, "2024-06-01T00:00:00+09:00")], "id long, source_id int, posted_at_utc string")
    out = rows(normalised_times(listings, df, sources))
    assert out == [("listings", 10, "2024-05-31T15:00:00Z"), ("listings", 8, "2024-06-01T07:00:00Z"), ("scraped_pages", 1, "2024-06-03T05:01:32Z")]
    assert normalised_times(listings.limit(0), df.limit(0), sources).count() == 0
