"""Queries of the data preparation operators of the core."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import timestamps, units
from ..session import table


def p1_found(spark, sf_dir):
    return units.misrecorded(table(spark, sf_dir, "listings"), table(spark, sf_dir, "unit_rates"))


def p5_found(spark, sf_dir):
    return timestamps.normalised_times(table(spark, sf_dir, "listings"), table(spark, sf_dir, "scraped_pages"), table(spark, sf_dir, "sources"))


def p1_undecided(spark, sf_dir):
    """Amounts of bare numbers (the unit tokens of every text taken away) that the columns' identities leave open."""
    bare = F.regexp_replace("price_raw_ko", r"[$₩]|불|달러|원|만|천|억|(?i:USD|KRW|k\b)", "")
    return units.undecided(table(spark, sf_dir, "listings").withColumn("price_raw_ko", bare), table(spark, sf_dir, "unit_rates"))


QUERIES = {"p1_found": p1_found, "p1_undecided": p1_undecided, "p5_found": p5_found}


def _amount(x: str) -> str:
    """Dollars of a clause in SQL, read by its own grammar."""
    num = f"replace(regexp_extract({x}, '[0-9][0-9,]*([.][0-9]+)?', 0), ',', '')"
    eok = f"replace(regexp_extract({x}, '([0-9.,]+) *억', 1), ',', '')"
    man = f"replace(regexp_extract({x}, '([0-9.,]+) *천?만', 1), ',', '')"
    dec = lambda t: f"coalesce(try_cast({t} AS DECIMAL(16,4)), 0)"
    krw = "(SELECT max(factor)::DECIMAL(9,5) FROM unit_rates WHERE unit_name = 'KRW')"
    usd = "(SELECT max(factor)::DECIMAL(9,5) FROM unit_rates WHERE unit_name = 'USD')"
    return (
        f"CASE WHEN {x} IS NULL OR NOT regexp_matches({x}, '[0-9]') THEN NULL WHEN contains({x}, '억') THEN ({dec(eok)} * 10000 + {dec(man)} * CASE WHEN regexp_matches({x}, '[0-9]천만') THEN 1000 ELSE 1 END)::DECIMAL(20,4) * 10000 * {krw}"
        f" WHEN man OR regexp_matches({x}, '[0-9]만') THEN {dec(num)} * 10000 * {krw} WHEN regexp_matches({x}, '원|₩') THEN {dec(num)} * {krw} WHEN regexp_matches({x}, '[0-9] *[kK]|천') THEN {dec(num)} * 1000 * {usd} ELSE {dec(num)} * {usd} END"
    )


def _per_year(x: str) -> str:
    names = {"week": "wk|week|주", "day": "day|night|하루|박", "year": "yr|year|년|연"}
    return "(SELECT max(factor)::INTEGER FROM unit_rates WHERE unit_name = CASE " + " ".join(f"WHEN regexp_matches({x}, '{p}') THEN '{n}'" for n, p in names.items()) + " ELSE 'month' END)"


BARE = "regexp_replace(r, '^1[박년] ', '')"
SQL = {
    "p1_found": rf"""
SELECT listing_id, quantity, usd_cents FROM (
  SELECT id AS listing_id, unnest([struct_pack(quantity := 'rent', usd_cents := rent_c, own := rent_monthly_usd), struct_pack(quantity := 'deposit', usd_cents := dep_c, own := deposit_usd)], recursive := true) FROM (
    SELECT id, rent_monthly_usd, deposit_usd, floor((yearly * 200 + 12) / 24)::BIGINT AS rent_c,
      CASE WHEN regexp_matches(p, '없음|no deposit') THEN 0 WHEN months IS NOT NULL THEN floor((yearly * months * 200 + 12) / 24)::BIGINT ELSE floor((dep * 200 + 1) / 2)::BIGINT END AS dep_c FROM (
      SELECT *, {_amount(BARE)} * {_per_year("r")} AS yearly, {_amount("d")} AS dep, try_cast(regexp_extract(d, '([0-9]+) ?(달분|개월치|months)', 1) AS INTEGER) AS months FROM (
        SELECT *, list_filter(parts, lambda x: regexp_matches(x, '^(보|deposit|전세|no dep)'))[1] AS d, list_filter(parts, lambda x: NOT regexp_matches(x, '^(보|deposit|전세|no dep)'))[1] AS r FROM (
          SELECT id, rent_monthly_usd, deposit_usd, p, regexp_matches(p, '단위: 만원|^[0-9,]+/[0-9,]+ 만원') AS man,
            CASE WHEN regexp_matches(p, '^[0-9,]+/[0-9,]+ 만원') THEN ['보 ' || split_part(p, '/', 1), split_part(split_part(p, '/', 2), ' ', 1)]
              WHEN contains(p, '단위: 만원') THEN ['보 ' || regexp_extract(p, '보증금 ([0-9,]+)', 1), regexp_extract(p, '월세 ([0-9,]+)', 1)]
              ELSE list_filter(regexp_split_to_array(p, ' / |, |\n| \+ | \(|\)'), lambda x: trim(x) <> '') END AS parts
          FROM (SELECT id, rent_monthly_usd, deposit_usd, trim(price_raw_ko) AS p FROM listings WHERE length(trim(price_raw_ko)) > 0)))))
) WHERE usd_cents IS NOT NULL AND (own IS NULL OR floor(own * 100)::BIGINT <> usd_cents)""",
}
