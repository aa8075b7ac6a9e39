"""Staging to serving: the rows to load, the rows that the serving table refuses, the upsert and its marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tables
from .audit import optional

#: The longest texts of the serving columns, and the first amount that numeric(10,2) can't hold.
LENGTHS = {"source_listing_id": 100, "lease_type": 30, "currency_raw": 10, "city": 100, "state_or_province": 100, "country": 10, "phone": 30, "kakao_id": 50, "email": 100, "category": 30}
TOO_LARGE, BATCH = 100_000_000, 500
KEYS = ["source_id", "source_listing_id"]
#: Columns that a match takes from the new row; all others stay.
TAKEN = ["title_ko", "body_ko", "rent_monthly_usd", "deposit_usd", "lease_type", "price_raw_ko", "posted_at_utc", "city", "state_or_province", "country", "address_raw", "phone", "kakao_id", "email", "category"]


def unloaded(staging: DataFrame, source_id: int | None = None, limit: int | None = BATCH) -> DataFrame:
    """The rows not yet loaded in order of id, of one source if it is named; ``limit`` rows a call is the batch of the loader."""
    rows = optional(staging.where(F.col("loaded_at").isNull()), "source_id", source_id)
    return rows.orderBy("id").limit(limit) if limit else rows


def refusal(columns: list[str]) -> Column:
    """Why the serving table refuses a row: a key without a value, a text too long, an amount too large; NULL if it doesn't."""
    out = F.lit(None).cast("string")
    for c in ("deposit_usd", "rent_monthly_usd"):
        if c in columns:
            out = F.when(F.abs(F.round(F.col(c), 2)) >= TOO_LARGE, f"overflow:{c}").otherwise(out)
    for c in reversed(LENGTHS):
        if c in columns:
            out = F.when(F.length(c) > LENGTHS[c], f"length:{c}").otherwise(out)
    for c in reversed(KEYS):
        out = F.when(F.col(c).isNull(), f"null:{c}").otherwise(out)
    return out


def split(rows: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, refused rows with ``reason``): a row is refused alone, the others go on. Unknown sources are refused."""
    known = sources.select(F.col("id").alias("source_id"), F.lit(True).alias("_known")).distinct()
    judged = rows.join(F.broadcast(known), "source_id", "left").withColumn("reason", F.coalesce(refusal(rows.columns), F.when(F.col("_known").isNull(), "source")))
    return judged.where("reason is null").select(*rows.columns), judged.where("reason is not null").select(*rows.columns, "reason")


def load(listings: DataFrame, rows: DataFrame, sources: DataFrame, now: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(the new serving snapshot, refused rows, ids loaded). Of rows with one key the one with the largest id is written; a match
    keeps id, url, currency_raw, first_seen_at, created_at and the flags of duplicates; matches become active again."""
    good, refused = split(rows, sources)
    new = tables.last_writer(good, KEYS, "id")
    keep = [c for c in listings.columns if c not in TAKEN]
    merged = tables.upsert(listings, new, KEYS, keep, {"is_active": F.lit(True), "last_seen_at": now, "updated_at": now, "first_seen_at": now, "created_at": now})
    again = new.select(*KEYS, F.lit(True).alias("_again"))
    fresh = {c: F.when(F.col("_again"), v).otherwise(F.col(c)) for c, v in {"is_active": F.lit(True), "last_seen_at": now, "updated_at": now}.items() if c in listings.columns}
    merged = merged.join(again, KEYS, "left").withColumns(fresh).select(*listings.columns)
    return merged, refused, good.select("id")


def mark(staging: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    """Staging with ``loaded_at`` set for the loaded ids."""
    hit = ids.select("id", F.lit(True).alias("_hit")).distinct()
    return tables.update_where(staging.join(hit, "id", "left"), F.col("_hit"), {"loaded_at": now}).select(*staging.columns)


def counts(rows: DataFrame, condition: Column) -> DataFrame:
    """(n): the rows that an update or delete with this condition touches."""
    return rows.agg(F.count_if(F.coalesce(condition, F.lit(False))).alias("n"))
