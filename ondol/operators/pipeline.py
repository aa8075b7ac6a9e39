"""Raw pages to staging rows: parse, require, normalise, mark duplicates, resolve canonical rows, count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify, contact, dates, location, price
from . import boards, fuzzy, tables

PARSED = ("title_ko", "body_ko", "raw_price", "raw_location", "raw_posted_at", "contact_block")
#: The columns of a staging row in their order.
STAGING = (
    "source_id", "source_listing_id", "url", "content_hash", *PARSED, "rent_monthly_usd", "deposit_usd", "lease_type", "currency_raw", "price_raw_ko", "posted_at_utc", "city", "state_or_province",
    "country", "address_raw", "phone", "kakao_id", "email", "category", "geo_point", "is_duplicate", "duplicate_of", "canonical_id", "parsed_at", "loaded_at", "errors",
)


def has_content(title: Column, body: Column, raw_price: Column) -> Column:
    """Whether a row has any of the required fields."""
    return F.concat_ws("", *[F.trim(F.coalesce(c, F.lit(""))) for c in (title, body, raw_price)]) != ""


def project(parsed: DataFrame, now: Column, lat: Column | None = None, lon: Column | None = None) -> DataFrame:
    """The staging columns of parsed rows (source_id, source_listing_id, url, content_hash and the PARSED columns), as native
    expressions. Duplicate marks are set later; ``geo_point`` is a point where both coordinates are known."""
    none = lambda t: F.lit(None).cast(t)
    money, place = price.normalized(F.col("raw_price")), location.normalized(F.col("raw_location"))
    everything = F.col("contact_block")
    point = F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))) if lat is not None and lon is not None else none("struct<lon:double,lat:double>")
    values = {
        "rent_monthly_usd": money["rent_usd"].cast("decimal(12,2)"), "deposit_usd": money["deposit_usd"].cast("decimal(12,2)"), "lease_type": money["lease_type"], "currency_raw": money["currency_raw"], "price_raw_ko": F.col("raw_price"),
        "posted_at_utc": dates.posted_at(F.col("raw_posted_at"), now), **place, "address_raw": F.col("raw_location"), "phone": contact.phone(everything), "kakao_id": contact.messenger(everything), "email": contact.email(everything),
        "category": classify.category(F.col("title_ko"), F.col("body_ko")), "geo_point": point, "is_duplicate": F.lit(False), "duplicate_of": none("long"), "canonical_id": none("long"), "parsed_at": now, "loaded_at": none("timestamp"), "errors": F.lit("{}"),
    }
    return parsed.select(*[values[c].alias(c) if c in values else F.col(c) for c in STAGING])


def transform(pages: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(staging rows, rejects). Pages have source_id, url, html_content, content_hash and board. A page that fails, of an unknown
    board, or without any required field is a reject with ``error``; it doesn't end the job."""
    done = boards.parse_details(pages)
    error = F.coalesce("error", F.when(~has_content(F.col("title_ko"), F.col("body_ko"), F.col("raw_price")), "no content"))
    done = done.withColumn("error", error)
    good = project(done.where("error is null").drop("error"), now)
    return good, done.where("error is not null").select("source_id", "url", "content_hash", "error")


def counters(pages: DataFrame, cutoff: Column, seen: DataFrame) -> DataFrame:
    """(extracted, stale, seen, failed) of a crawl: pages older than the cutoff, those of known urls, those that failed."""
    known = seen.select("source_id", "url", F.lit(True).alias("_seen")).distinct()
    failed = ~F.coalesce(F.col("http_status") == 200, F.lit(False))
    rows = pages.join(known, ["source_id", "url"], "left")
    return rows.agg(F.count(F.lit(1)).alias("extracted"), F.count_if(F.coalesce(F.col("fetched_at") < cutoff, F.lit(False))).alias("stale"), F.count_if("_seen").alias("seen"), F.count_if(failed).alias("failed"))


def with_recent(batch: DataFrame, recent: DataFrame) -> DataFrame:
    """A batch and the recent rows not yet loaded, which have fewer columns and lack the batch's own keys."""
    own = batch.select("source_id", "source_listing_id").distinct()
    others = recent.join(own, ["source_id", "source_listing_id"], "left_anti")
    return batch.withColumn("in_batch", F.lit(True)).unionByName(others.withColumn("in_batch", F.lit(False)), allowMissingColumns=True)


def duplicates(batch: DataFrame, recent: DataFrame) -> DataFrame:
    """The batch's rows (id, is_duplicate, canonical_id) after the fuzzy pass over batch and recent rows, batch first."""
    both = with_recent(batch, recent)
    text = F.concat_ws(" ", F.coalesce("title_ko", F.lit("")), F.coalesce(F.col("rent_monthly_usd").cast("decimal(10,2)").cast("string"), F.lit("")))
    marked = fuzzy.find_duplicates(both, F.struct(~F.col("in_batch"), F.col("id")), F.col("posted_at_utc"), F.col("city"), text)
    return marked.join(batch.select("id"), "id", "left_semi")


def duplicate_counts(marked: DataFrame) -> DataFrame:
    """(duplicates, in_batch): all of them, and those whose canonical row is of the same batch (an id below zero)."""
    return marked.agg(F.count_if("is_duplicate").alias("duplicates"), F.count_if(F.coalesce(F.col("canonical_id") < 0, F.lit(False))).alias("in_batch"))


def canonical_ids(batch: DataFrame, marked: DataFrame, stored: DataFrame) -> DataFrame:
    """(id, canonical_id): ids below zero stand for rows of the batch; they become the stored ids of these rows' natural keys.
    Other ids stay; a row whose canonical row isn't stored gets NULL."""
    keys = ["source_id", "source_listing_id"]
    real = batch.select(F.col("id").alias("canonical_id"), *keys).join(stored.groupBy(*keys).agg(F.min("id").alias("_real")), keys).select("canonical_id", "_real")
    out = marked.where("canonical_id is not null").select("id", "canonical_id").join(real, "canonical_id", "left")
    return out.select("id", F.when(F.col("canonical_id") < 0, F.col("_real")).otherwise(F.col("canonical_id")).alias("canonical_id"))


def set_canonical(staging: DataFrame, ids: DataFrame) -> DataFrame:
    """Staging with the canonical ids of ``ids`` (source_id, source_listing_id, canonical_id) written to the rows of these keys."""
    new = ids.select("source_id", "source_listing_id", F.col("canonical_id").alias("_new"))
    return tables.update_where(staging.join(new, ["source_id", "source_listing_id"], "left"), F.col("_new").isNotNull(), {"canonical_id": F.col("_new")}).select(*staging.columns)
