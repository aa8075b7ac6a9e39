"""Price texts by keyword and currency mark (amounts stay in the unit of the text; see ``operators.units`` for exact units)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: US dollars for a won.
USD_PER_KRW = "0.00075"
#: Amounts are digits and commas; decimals aren't read.
DOLLARS, WON_BEFORE, WON_AFTER = r"\$\s*([\d,]+)", r"₩\s*([\d,]+)", r"([\d,]+)\s*원"


def amounts(text: Column, pattern: str) -> Column:
    """All amounts of a pattern as decimals; what isn't a number is left out."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.array_compact(F.transform(found, lambda x: F.regexp_replace(x, "[, ]", "").try_cast("decimal(18,2)")))


def lease_type(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.contains("전세"), "jeonse").when(low.rlike("단기|서브렛|sublet"), "short_term").when(low.rlike("리스|lease"), "lease").otherwise("monthly")


def normalized(text: Column) -> dict[str, Column]:
    """rent, deposit (dollars), lease_type and currency. Dollars count before won; of several amounts the largest is the deposit
    and the smallest the rent; a single one is the rent, with jeonse the deposit. An empty text gives NULLs."""
    empty = F.coalesce(F.trim(text), F.lit("")) == ""
    usd, krw = amounts(text, DOLLARS), F.concat(amounts(text, WON_BEFORE), amounts(text, WON_AFTER))
    in_won = (F.size(usd) == 0) & (F.size(krw) > 0)
    values = F.when(in_won, F.transform(krw, lambda x: (x * F.lit(USD_PER_KRW).cast("decimal(8,5)")).cast("decimal(18,2)"))).otherwise(usd)
    lease, n = lease_type(text), F.size(values)
    rent = F.when(n > 1, F.array_min(values)).when((n == 1) & (lease != "jeonse"), F.get(values, F.lit(0)))
    deposit = F.when(n > 1, F.array_max(values)).when((n == 1) & (lease == "jeonse"), F.get(values, F.lit(0)))
    keep = lambda c: F.when(~empty, c)
    return {"rent_usd": keep(rent), "deposit_usd": keep(deposit), "lease_type": keep(lease), "currency_raw": keep(F.when(in_won, "KRW").otherwise("USD"))}
