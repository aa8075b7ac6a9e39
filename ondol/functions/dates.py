"""Dates as boards write them. ``now`` and ``today`` are parameters, bound once for a run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _int(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(text, pattern, group).try_cast("int")


def _date(y: Column, m: Column, d: Column) -> Column:
    return F.try_make_timestamp(y, m, d, F.lit(0), F.lit(0), F.lit(0).cast("decimal(8,6)"), F.lit("UTC")).cast("date")


def posted_date(text: Column, today: Column) -> Column:
    """The day of a posting (date): words for today and yesterday, then the first of the prefixes Y년 M월 D일, Y-M-D, M-D (of this
    year) and M/D/Y that fits. A day that doesn't exist gives NULL."""
    t = F.trim(text)
    korean, iso, short, us = r"^(\d{4})년\s*(\d{1,2})월\s*(\d{1,2})일", r"^(\d{4})-(\d{2})-(\d{2})", r"^(\d{2})-(\d{2})", r"^(\d{1,2})/(\d{1,2})/(\d{4})"
    low = F.lower(t)
    return (
        F.when(low.isin("오늘", "today"), today)
        .when(low.isin("어제", "yesterday"), F.date_sub(today, 1))
        .when(low.rlike("방금|just now"), today)
        .when(t.rlike(korean), _date(_int(t, korean, 1), _int(t, korean, 2), _int(t, korean, 3)))
        .when(t.rlike(iso), _date(_int(t, iso, 1), _int(t, iso, 2), _int(t, iso, 3)))
        .when(t.rlike(short), _date(F.year(today), _int(t, short, 1), _int(t, short, 2)))
        .when(t.rlike(us), _date(_int(t, us, 3), _int(t, us, 1), _int(t, us, 2)))
    )


def posted_at(text: Column, now: Column) -> Column:
    """The instant of a posting (timestamp): ``now`` for the words for today and now, a day before it for those for yesterday,
    else midnight UTC of the first date that fits; see ``posted_date``."""
    low = F.lower(F.trim(text))
    day = posted_date(text, F.to_date(now))
    return (
        F.when(low.isin("오늘", "today"), now)
        .when(low.isin("어제", "yesterday"), now - F.expr("INTERVAL 1 DAY"))
        .when(low.rlike("방금|just now"), now)
        .otherwise(F.to_utc_timestamp(day.cast("timestamp"), F.current_timezone()))
    )


def resolved_date(detail: Column, listed: Column) -> Column:
    """The date of the detail page where it gives one, else that of the list row."""
    return F.coalesce(detail, listed)


def list_date(text: Column, today: Column) -> Column:
    """The day in a list row. Steps in order, each falling through if its day doesn't exist: Y-M-D, M-D-YY, M-D and M월D일 (this
    year, the last one if that is still to come), a time of day, words for now, days ago."""
    t = F.trim(text)
    # one separator at a time: what follows the second number repeats the one before it
    sep, again = r"\s*([-./])\s*", r"\s*\2\s*"
    full, short_year, short, korean = rf"^(\d{{4}}){sep}(\d{{1,2}}){again}(\d{{1,2}})", rf"^(\d{{1,2}}){sep}(\d{{1,2}}){again}(\d{{2}})(?:\s|$)", rf"^(\d{{1,2}}){sep}(\d{{1,2}})(?:\s|$)", r"^(\d{1,2})(\s*월\s*)(\d{1,2})\s*일"

    def past(pattern: str) -> Column:
        m, d = _int(t, pattern, 1), _int(t, pattern, 3)
        this = _date(F.year(today), m, d)
        return F.when(this > today, _date(F.year(today) - 1, m, d)).otherwise(this)

    return F.coalesce(
        F.when(t.rlike(full), _date(_int(t, full, 1), _int(t, full, 3), _int(t, full, 4))),
        F.when(t.rlike(short_year), _date(_int(t, short_year, 4) + 2000, _int(t, short_year, 1), _int(t, short_year, 3))),
        F.when(t.rlike(short), past(short)),
        F.when(t.rlike(korean), past(korean)),
        F.when(t.rlike(r"^\d{1,2}:\d{2}(?::\d{2})?$") | t.rlike("방금|오늘"), today),
        F.when(t.contains("어제"), F.date_sub(today, 1)),
        F.when(t.rlike(r"\d+\s*(?:분|시간)\s*전"), today),
        F.when(t.rlike(r"\d+\s*일\s*전"), F.date_sub(today, _int(t, r"(\d+)\s*일\s*전", 1))),
    )


def within_cutoff(day: Column, today: Column, days: int) -> Column:
    """Whether a row is recent enough; rows without a day pass."""
    return day.isNull() | (day >= F.date_sub(today, days))
