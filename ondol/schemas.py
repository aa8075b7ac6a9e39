"""The tables of the pipeline and their set-up, which may be repeated at will."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .operators.tables import SnapshotTable

TEXTS = "source_listing_id string, url string"
CONTACT = "phone string, kakao_id string, email string, category string"
PLACE = "city string, state_or_province string, country string, address_raw string"
MONEY = "rent_monthly_usd decimal(10,2), deposit_usd decimal(10,2), lease_type string, currency_raw string, price_raw_ko string"
TABLES = {
    "sources": "id int, name string, display_name string, base_url string, fetcher_type string, schedule_cron string, is_active boolean, created_at timestamp, updated_at timestamp",
    "scraped_pages": "id long, source_id int, url string, html_content string, content_hash string, http_status int, list_page_location string, fetched_at timestamp",
    "listings_staging": f"id long, source_id int, {TEXTS}, content_hash string, title_ko string, body_ko string, raw_price string, raw_location string, raw_posted_at string, contact_block string, {MONEY}, posted_at_utc timestamp, {PLACE}, {CONTACT}, geo_point struct<lon:double,lat:double>, is_duplicate boolean, duplicate_of long, canonical_id long, parsed_at timestamp, loaded_at timestamp, errors string",
    "listings": f"id long, source_id int, {TEXTS}, title_ko string, title_en string, body_ko string, body_en string, {MONEY}, posted_at_utc timestamp, first_seen_at timestamp, last_seen_at timestamp, {PLACE}, geo_point struct<lon:double,lat:double>, {CONTACT}, is_canonical boolean, duplicate_count int, is_active boolean, created_at timestamp, updated_at timestamp",
    "etl_runs": "id long, dag_id string, task_id string, run_id string, source_name string, status string, rows_extracted int, rows_transformed int, rows_loaded int, rows_failed int, error_message string, started_at timestamp, finished_at timestamp, duration_sec decimal(10,2)",
}


def ensure_tables(spark: SparkSession, root: str) -> dict[str, SnapshotTable]:
    """The tables under ``root``; those that don't exist yet are made empty, the others are left as they are."""
    out = {}
    for name, schema in TABLES.items():
        out[name] = SnapshotTable(spark, f"{root.rstrip('/')}/{name}")
        if not out[name].version():
            out[name].write(spark.createDataFrame([], schema))
    return out
