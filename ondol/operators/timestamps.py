"""Mixed timestamp formats and zones to UTC instants, through a dictionary of distinct raw strings.

The distinct (raw string, zone) pairs of a batch that the dictionary lacks are parsed once by column expressions and
appended to a table in the shared folder; rows get their instant by a join. Times told relative to a fetch are kept in the
dictionary as an offset (or a local time of the day before) and are resolved against the row's own fetch time.

Rules: without a zone the source's zone holds; a bare date is the start of that day there; a local time that occurs twice
is the first of the two; a skipped one takes the offset valid before the change; fractions of seconds are cut off;
two-digit years come first, and slashed dates that begin with the month end with the year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch

#: Zone abbreviations with their offsets in minutes.
ZONE_MINUTES = {
    "Z": 0, "UTC": 0, "GMT": 0, "KST": 540, "JST": 540,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
#: English month names.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
#: Labels that boards put before the posting time.
LABELS = ["등록일", "작성일", "게시", "게시일", "날짜", "올린 시각", "올린 날", "올린날", "등록 시각", "작성 시각", "Posted", "Posted on", "Date", "Published"]

ISO_UTC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
DATES = [  # pattern, groups of year, month, day
    (r"^(\d{4})\s*[-./년]\s*(\d{1,2})\s*[-./월]\s*(\d{1,2})(?!\d)", (1, 2, 3)),
    (r"^(\d{4})(\d{2})(\d{2})(?=T|$|\s)", (1, 2, 3)),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})(?!\d)", (3, 1, 2)),
    (r"^(\d{2})[./-](\d{1,2})[./-](\d{1,2})(?!\d)", (1, 2, 3)),
    (r"(?i)^(?:[a-z]{3,9},?\s+)?(\d{1,2})\s+([a-z]{3})[a-z]*\.?,?\s+(\d{4})(?!\d)", (3, 2, 1)),
    (r"(?i)^(?:[a-z]{3,9},\s+)?([a-z]{3})[a-z]*\.?\s+(\d{1,2}),?\s+(\d{4})(?!\d)", (3, 1, 2)),
]
TIME = r"(?i)(?:(오전|오후|am|pm)\s*)?(?<!\d)(\d{1,2})\s*(?::|시)\s*(\d{1,2})?(?:\s*분)?(?::(\d{2}))?(?:\s*(\d{1,2})초)?(?:[.,]\d+)?\s*(am|pm)?"
COMPACT_TIME = r"^T(\d{2})(\d{2})(\d{2})?"
ZONE = r"(?:\s*(Z)|\s*([+-]\d{2}):?(\d{2})|\s+([A-Z]{3,4}))\s*$"
AGO = r"(?i)(\d+)\s*(초|분|시간|일|주|seconds?|secs?|minutes?|mins?|hours?|hrs?|days?|weeks?)\s*(?:전|ago)"
DAY_TIME = r"(?i)^(오늘|어제|그저께|today|yesterday)"

DICTIONARY = "raw string, zone string, instant bigint, ago bigint, day_back int, day_seconds int, exactness int"


def _int(text: Column) -> Column:
    return text.try_cast("int")


def _group(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def parse(strings: DataFrame) -> DataFrame:
    """(raw, zone) -> the DICTIONARY columns.

    instant: epoch seconds; ago: seconds before the fetch; day_back and day_seconds: local day before the fetch day and time in
    it; all NULL where the string denotes no time. exactness: 4 seconds, 3 minutes, 2 relative, 1 a date, +10 with a zone.
    """
    df = strings.select("raw", "zone").withColumn("_t", F.trim(F.regexp_replace("raw", r"[ 　\s]+", " ")))
    t = F.col("_t")
    hit, year, month, day, rest = (F.lit(None).cast(x) for x in ("int", "int", "int", "int", "string"))
    number = F.lit(None).cast("int")
    for k, (pattern, _) in reversed(list(enumerate(DATES))):
        number = F.when(t.rlike(pattern), k).otherwise(number)
    df = df.withColumn("_f", number)

    def part(which: int) -> Column:
        out = F.lit(None).cast("string")
        for k, (pattern, groups) in enumerate(DATES):
            out = F.when(F.col("_f") == k, F.regexp_extract(t, pattern, groups[which])).otherwise(out)
        return out

    rest = F.lit(None).cast("string")
    for k, (pattern, _) in enumerate(DATES):
        rest = F.when(F.col("_f") == k, F.regexp_replace(t, pattern, "")).otherwise(rest)
    named = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(part(1))).cast("int")
    df = df.withColumns({"_y": _int(part(0)), "_m": F.coalesce(_int(part(1)), F.nullif(named, F.lit(0))), "_d": _int(part(2)), "_rest": F.trim(F.regexp_replace(rest, r"^\s*[.일]?\s*(?:\([^)]*\))?\.?\s*", "")), "_day": _group(t, DAY_TIME, 1)})
    df = df.withColumn("_rest", F.when(F.col("_day").isNotNull(), F.regexp_replace(t, DAY_TIME, "")).otherwise(F.col("_rest")))
    r = F.col("_rest")
    zone_text = F.coalesce(_group(r, ZONE, 1), _group(r, ZONE, 4))
    names = F.create_map(*[F.lit(x) for kv in ZONE_MINUTES.items() for x in kv])
    signed = _int(_group(r, ZONE, 2)) * 60 + F.when(_group(r, ZONE, 2).startswith("-"), -1).otherwise(1) * _int(_group(r, ZONE, 3))
    half = F.lower(F.coalesce(_group(r, TIME, 1), _group(r, TIME, 6)))
    hour = F.coalesce(_int(_group(r, COMPACT_TIME, 1)), _int(_group(r, TIME, 2)))
    hour = F.when(half.isin("오후", "pm"), hour % 12 + 12).when(half.isin("오전", "am"), hour % 12).otherwise(hour)
    df = df.withColumns(
        {
            "_zone_text": zone_text,
            "_off": F.coalesce(F.element_at(names, zone_text), signed),
            "_h": hour,
            "_mi": F.coalesce(_int(_group(r, COMPACT_TIME, 2)), _int(_group(r, TIME, 3))),
            "_s": F.coalesce(_int(_group(r, COMPACT_TIME, 3)), _int(_group(r, TIME, 4)), _int(_group(r, TIME, 5))),
            "_n": _group(t, AGO, 1).try_cast("long"),
            "_unit": F.lower(_group(t, AGO, 2)),
            "_epoch": _group(t, r"^(\d{10})(?:\d{3}|\d{6})?(?:\.\d+)?$", 1).try_cast("long"),
            "_now": t.rlike(r"(?i)^(?:방금|just now|now$)"),
        }
    )
    year = F.when(F.col("_y") < 100, F.col("_y") + 2000).otherwise(F.col("_y"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    local = F.try_make_timestamp(year, F.col("_m"), F.col("_d"), zero("_h"), zero("_mi"), zero("_s").cast("decimal(8,6)"), F.lit("UTC"))
    df = df.withColumn("_local", F.when(F.col("_f").isNotNull() & ~(F.col("_zone_text").isNotNull() & F.col("_off").isNull()), local))
    by_offset = F.unix_seconds("_local") - F.col("_off") * 60
    # to_utc_timestamp: the earlier offset where a local time occurs twice, the offset before the change where it is skipped
    by_zone = F.when(F.col("zone").isNotNull(), F.unix_seconds(F.to_utc_timestamp("_local", F.coalesce("zone", F.lit("UTC")))))
    seconds = F.when(F.col("_unit").rlike("^(?:분|m)"), 60).when(F.col("_unit").rlike("^(?:시간|h)"), 3600).when(F.col("_unit").rlike("^(?:일|d)"), 86400).when(F.col("_unit").rlike("^(?:주|w)"), 604800).when(F.col("_unit").isNotNull(), 1)
    instant = F.coalesce("_epoch", by_offset, by_zone)
    back = F.when(F.lower("_day").isin("어제", "yesterday"), 1).when(F.col("_day") == "그저께", 2).when(F.col("_day").isNotNull(), 0)
    ago = F.when(F.col("_now"), F.lit(0)).otherwise(F.col("_n") * seconds)
    zoned = F.col("_off").isNotNull() | F.col("_epoch").isNotNull()
    level = F.when(ago.isNotNull(), 2).when(F.col("_s").isNotNull() | F.col("_epoch").isNotNull(), 4).when(F.col("_h").isNotNull(), 3).otherwise(1)
    return df.select(
        "raw",
        "zone",
        F.when(ago.isNull() & back.isNull(), instant).cast("long").alias("instant"),
        ago.cast("long").alias("ago"),
        F.when(ago.isNull(), back).cast("int").alias("day_back"),
        F.when(back.isNotNull(), zero("_h") * 3600 + zero("_mi") * 60 + zero("_s")).cast("int").alias("day_seconds"),
        (level + F.when(zoned, 10).otherwise(0)).cast("int").alias("exactness"),
    )


class TimestampDictionary:
    """Parsed strings kept in the shared folder; ``extend`` adds what a batch brings new, ``normalise`` joins instants to rows."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch(spark, "timestamps")

    def table(self) -> DataFrame | None:
        from pyspark.errors import AnalysisException

        try:
            return self.spark.read.schema(DICTIONARY).parquet(self.path)
        except AnalysisException:
            return None

    def extend(self, rows: DataFrame) -> None:
        """``rows`` has raw and zone. NULL strings and strings without a digit or a word for now denote no time and stay out."""
        new = rows.select("raw", "zone").where(F.col("raw").rlike(r"\d|방금|(?i:just now)")).distinct()
        if (old := self.table()) is not None:
            new = new.join(old.select("raw", "zone"), new["raw"].eqNullSafe(old["raw"]) & new["zone"].eqNullSafe(old["zone"]), "left_anti")
        parse(new).write.mode("append").parquet(self.path)

    def normalise(self, rows: DataFrame, fetched: Column | None = None) -> DataFrame:
        """Adds ``epoch`` (seconds, NULL where there is no time) and ``exactness``. Rows have raw and zone; no row is lost."""
        known = self.table().select(F.col("raw").alias("_raw"), F.col("zone").alias("_zone"), "instant", "ago", "day_back", "day_seconds", "exactness")
        fetched = fetched if fetched is not None else F.lit(None).cast("timestamp")
        joined = rows.join(known, (F.col("raw") == F.col("_raw")) & F.coalesce("zone", F.lit("")).eqNullSafe(F.coalesce("_zone", F.lit(""))), "left")
        day = F.date_trunc("day", F.from_utc_timestamp(fetched, F.coalesce("zone", F.lit("UTC"))))
        before = F.to_utc_timestamp(F.timestamp_seconds(F.unix_seconds(F.date_trunc("day", day - F.make_dt_interval(F.col("day_back")))) + F.col("day_seconds")), F.coalesce("zone", F.lit("UTC")))
        epoch = F.coalesce("instant", F.unix_seconds(fetched) - F.col("ago"), F.unix_seconds(before))
        return joined.withColumn("epoch", epoch).drop("_raw", "_zone", "instant", "ago", "day_back", "day_seconds")


def utc_text(epoch: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(F.timestamp_seconds(epoch), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def statements(html: Column) -> Column:
    """The strings of a page that state when its posting was put up: the labelled one, its machine form and those of the head."""
    label = rf"(?i)>\s*(?:{'|'.join(LABELS)})\s*:?\s*</\w+>\s*<(?:span|time|td|dd|em|i|b)([^>]*)>([^<]*)<"
    attrs = F.regexp_extract(html, label, 1)
    return F.array_distinct(
        F.filter(
            F.array(
                F.regexp_extract(html, label, 2),
                F.regexp_extract(attrs, r"""datetime\s*=\s*["']?([^"'>]+)""", 1),
                F.regexp_extract(html, r'"datePublished"\s*:\s*"([^"]+)"', 1),
                F.regexp_extract(html, r"""(?i)published_time["']\s+content\s*=\s*["']([^"']+)""", 1),
            ),
            lambda x: F.trim(x) != "",
        )
    )


def normalised_times(listings: DataFrame, pages: DataFrame, sources: DataFrame, path: str | None = None) -> DataFrame:
    """(table_name, row_id, utc) for listings whose text is not already in the normal form and for all pages stating a time.

    Of several statements of a page the most exact counts (a zone, then the finer unit; ties by the earlier instant).
    Sources without a row give no zone: only strings with their own zone then denote an instant. Empty tables give no rows.
    """
    spark = listings.sparkSession
    zones = sources.select(F.col("id").alias("source_id"), F.col("time_zone").alias("zone")).dropDuplicates(["source_id"])
    own = listings.where(F.col("posted_at_utc").isNotNull() & ~F.col("posted_at_utc").rlike(ISO_UTC)).select("id", "source_id", F.col("posted_at_utc").alias("raw"))
    own = own.join(zones, "source_id", "left").select("id", "raw", "zone")
    said = pages.where("html_content is not null").select("id", "source_id", "fetched_at", F.explode(statements(F.col("html_content"))).alias("raw"))
    # the statements are needed twice; the pages are read once
    said = materialize(said.join(zones, "source_id", "left").select("id", "fetched_at", "raw", "zone"), "statements")
    book = TimestampDictionary(spark, path)
    book.extend(own)
    book.extend(said)
    a = book.normalise(own).where("epoch is not null").select(F.lit("listings").alias("table_name"), F.col("id").alias("row_id"), utc_text(F.col("epoch")).alias("utc"))
    best = F.max_by("epoch", F.struct("exactness", -F.col("epoch")))
    b = book.normalise(said, F.col("fetched_at")).where("epoch is not null").groupBy("id").agg(best.alias("epoch"))
    return a.unionByName(b.select(F.lit("scraped_pages").alias("table_name"), F.col("id").alias("row_id"), utc_text(F.col("epoch")).alias("utc")))
