"""The older readings of dates and prices, kept beside the current ones because stored rows were made with them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def legacy_date(text: Column, now: Column) -> Column:
    """ISO text: words for today and yesterday anywhere give a day, words for now the instant, a Korean date anywhere midnight
    UTC; NULL otherwise and for days that don't exist."""
    low = F.lower(text)
    parts = [F.regexp_extract(text, r"(\d{4})년\s*(\d{1,2})월\s*(\d{1,2})일", k).try_cast("int") for k in (1, 2, 3)]
    day = F.try_make_timestamp(*parts, F.lit(0), F.lit(0), F.lit(0).cast("decimal(8,6)"), F.lit("UTC"))
    iso = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
    return (
        F.when(text.contains("오늘") | low.contains("today"), F.date_format(now, "yyyy-MM-dd"))
        .when(text.contains("어제") | low.contains("yesterday"), F.date_format(now - F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd"))
        .when(text.contains("방금") | low.contains("just now"), F.date_format(now, iso))
        .otherwise(F.date_format(day, iso))
    )


def legacy_price(text: Column) -> dict[str, Column]:
    """rent, lease_type and currency: the first number only; won above 10000 are divided by 1200, whole dollars."""
    low, empty = F.lower(text), F.coalesce(text, F.lit("")) == ""
    # fixed values: the words of each kind of lease in their order, the bound and the rate of won
    lease = F.when(text.contains("월세"), "monthly_rent").when(text.contains("보증금"), "deposit").when(text.contains("전세"), "jeonse").when(low.rlike("단기|short"), "short_term").when(low.rlike("리스|lease"), "lease")
    number = F.regexp_replace(F.regexp_extract(text, r"([\d,]*\d[\d,]*)", 1), ",", "").try_cast("long")
    usd = text.contains("$") | low.contains("usd")
    rent = F.when(usd, number).otherwise(F.when(number > 10000, F.floor(number / 1200)).otherwise(number))
    keep = lambda c: F.when(~empty, c)
    return {"rent": keep(rent.cast("long")), "lease_type": keep(lease), "currency_raw": keep(F.when(number.isNotNull(), F.when(usd, "USD").otherwise("KRW")))}
