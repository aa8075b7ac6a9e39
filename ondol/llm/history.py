"""Deduplicating new batches against all history, by a pivot-distance table.

An offer is read out of a row: building name and number, bedrooms, baths and rent of the title, the place of its city and the
posting time. The distance of two offers is a sum of metrics, hence a metric: ``WEIGHT`` times the edit distance of the names,
``WEIGHT`` times the differences of number, rooms, rent and place, plus the days between the postings. As ``WEIGHT`` exceeds
``DAYS``, two rows offer the same within ``DAYS`` days exactly if their distance is at most ``DAYS``.

The table keeps, for every offer already seen, its distances to fixed pivots (``PIVOTS``, offers without a time) and its day. By
the triangle inequality offers within ``DAYS`` have distances to every pivot that differ by less than ``WEIGHT``, that is, the same
whole number of ``WEIGHT``, and days that differ by at most ``DAYS``: the candidates come out of an equality join on the pivot
distances and a range join on the days, and the true distance verifies them. The table is partitioned by weeks, so that a batch
reads only the weeks around its own postings. Days that lie inside the bound need only the earliest row of an offer and a day, so
that a hot offer costs its days and not its pairs; the two days on the border are verified row by row, and only for rows that
nothing else has decided. New rows are appended; nothing stored is ever rewritten: the name that a spelling of a building got
when it was first seen is kept in an append-only table of aliases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.timestamps import ISO_UTC, TimestampDictionary
from ..operators.units import rates
from ..session import materialize, scratch
from . import addresses as A
from . import places as P

DAYS, WEIGHT = 7, 8
DAY = 86_400
#: The pivots: a name and the number, bedrooms, baths, rent and place of an offer. The last four lie beyond all offers in one
#: coordinate each, so that the distances to all of them pin the numbers down; the names are of different lengths and letters.
FAR = 1 << 40
PIVOTS = (("", 0, 0, 0, 0, 0), ("한빛파크", FAR, 0, 0, 0, 0), ("은하레지던스", 0, FAR, 0, 0, 0), ("달마루", 0, 0, FAR, 0, 0), ("푸른솔하이츠", 0, 0, 0, 0, FAR))
#: How much more frequent a building's name must be than a misspelling of it.
RATIO = 4
#: Rows of a misspelling beyond those that the slip rate of a name lets expect, rows up to which it is rare whatever its
#: neighbours, and letters that a name has at least where two edits are no other name.
SLACK, RARE, LONG = 3, 12, 6

BUILDING = r"([가-힣A-Za-z]+)?\s*?([가-힣]{2,12})\s*(\d+)\s*단\s*지"
ROOMS = [  # pattern, group of bedrooms (0: none), group of baths
    (r"(\d+)\s*베드\s*(\d+(?:\.\d+)?)\s*바스", 1, 2),
    (r"(?i)(?<![a-z0-9])(\d+)\s*b\s*(\d+(?:\.\d+)?)\s*b(?![a-z])", 1, 2),
    (r"방\s*(\d+)\s*화\s*(\d+(?:\.\d+)?)", 1, 2),
    (r"(?:스튜디오|원룸형)\s*(\d+(?:\.\d+)?)\s*바스", 0, 1),
    (r"(?:스튜디오|원룸형)\s*화\s*(\d+(?:\.\d+)?)", 0, 1),
]
RENT = r"(?i)(하루|일당|\d박|주당|주|연|월세|월)?\s*([$₩])?\s*(\d[\d,]*(?:\.\d+)?)\s*(만원|만|불|달러|원)?\s*(/\s*(?:wk|week|주|yr|year|년|night|day|박|일|mo|month|월))?"

OFFER = ["name", "number", "beds", "baths", "rent", "place"]


def titles(rows: DataFrame, unit_rates: DataFrame) -> DataFrame:
    """Adds prev, last (the two words before the building's number), number, beds, baths (tenths) and rent (US cents a month) of
    the column title; NULL where the title lacks them."""
    known = rates(unit_rates)
    per = {k: float(v) for k, v in known.get("units_per_year", {}).items()}
    krw = float(known.get("usd_per_unit", {}).get("KRW", "nan"))
    t = F.regexp_replace(F.translate(F.col("title"), P.WIDE, P.NARROW), r"[\s ​]+", " ")
    rows = rows.withColumn("_t", t)
    g = lambda c, p, k: F.nullif(F.regexp_extract(c, p, k), F.lit(""))
    beds, baths = F.lit(None).cast("int"), F.lit(None).cast("int")
    for pattern, b, h in reversed(ROOMS):
        hit = F.col("_t").rlike(pattern)
        beds = F.when(hit, F.regexp_extract("_t", pattern, b).try_cast("int") if b else F.lit(0)).otherwise(beds)
        baths = F.when(hit, (F.regexp_extract("_t", pattern, h).try_cast("double") * 10).cast("int")).otherwise(baths)
    bare = F.regexp_replace("_t", rf"[가-힣]{{2,12}}\s*\d+\s*단\s*지|{'|'.join(p.replace('(?i)', '') for p, _, _ in ROOMS)}", " ; ")
    rows = rows.withColumns({"prev": g("_t", BUILDING, 1), "last": g("_t", BUILDING, 2), "number": g("_t", BUILDING, 3).try_cast("int"), "beds": beds, "baths": baths, "_bare": bare})
    # the first amount with a currency sign, word or unit
    amounts = F.filter(F.regexp_extract_all("_bare", F.lit(RENT), F.lit(0)), lambda x: x.rlike(r"[$₩]\s*\d|\d\s*(?:만|불|달러|원)"))
    rows = rows.withColumn("_a", F.get(amounts, F.lit(0)))
    number = F.regexp_replace(g("_a", RENT, 3), ",", "").try_cast("double")
    unit, before, after = g("_a", RENT, 4), F.coalesce(g("_a", RENT, 1), F.lit("")), F.lower(F.coalesce(g("_a", RENT, 5), F.lit("")))
    usd = number * F.when(unit.startswith("만"), 10000 * krw).when((unit == "원") | (g("_a", RENT, 2) == "₩"), krw).otherwise(1.0)
    week, day, year = before.startswith("주") | after.rlike("wk|week|주"), before.rlike("하루|일당|박") | after.rlike("night|day|박|일"), (before == "연") | after.rlike("yr|year|년")
    yearly = F.when(week, per.get("week")).when(day, per.get("day")).when(year, per.get("year")).otherwise(per.get("month"))
    return rows.withColumn("rent", F.round(usd * yearly * 100 / 12).cast("long")).drop("_t", "_bare", "_a")


ALIASES = "prev string, last string, name string, n long"


def building_names(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(prev, last, name, n) of every distinct pair of words before a building's number, with its rows.

    A building is called by both words, unless the last alone is written elsewhere as two. A misspelling takes the name that is
    within two edits, at least ``RATIO`` times as frequent, and frequent enough for slips to explain the rows of the misspelling.
    Where these are more than ``RARE``, they must also be the name's offers about as often as its own rows repeat each other.

    With ``known`` (the ALIASES of earlier batches) pairs already known keep their names, known names stay names, and a new one of
    more than ``RARE`` rows is a name of its own: what was decided needs no history to be read again.
    """
    pairs = rows.where("last is not null").groupBy("prev", "last").agg(F.count(F.lit(1)).alias("n"))
    same = lambda x, y: x["prev"].eqNullSafe(y["prev"]) & (x["last"] == y["last"])
    if known is not None:
        known = materialize(known.groupBy("prev", "last", "name").agg(F.sum("n").alias("n")), "aliases")
        seen = known.select(F.col("prev").alias("_p"), F.col("last").alias("_l"), "name")
        again = pairs.join(seen, F.col("prev").eqNullSafe(F.col("_p")) & (F.col("last") == F.col("_l"))).select("prev", "last", "name", "n")
        pairs = pairs.join(known, same(pairs, known), "left_anti")
    # as in ``addresses``, what several branches read is written first, so that the driver's plans stay small
    pairs = materialize(pairs.withColumn("both", F.concat(F.coalesce("prev", F.lit("")), F.col("last"))), "pairs")
    every = pairs.select("both", "n")
    if known is not None:
        every = every.unionByName(known.select(F.concat(F.coalesce("prev", F.lit("")), F.col("last")).alias("both"), "n"))
    named = every.groupBy(F.col("both").alias("_b")).agg(F.sum("n").alias("_n"))
    alone = named.select(F.col("_b").alias("_l"), F.col("_n").alias("_m"))
    pairs = pairs.join(named, F.col("both") == F.col("_b")).join(alone, F.col("last") == F.col("_l"), "left")
    pairs = pairs.withColumn("name", F.when(F.col("_m") >= F.col("_n"), F.col("last")).otherwise(F.col("both"))).select("prev", "last", "name", "n")
    pairs = materialize(pairs, "buildings")
    names = pairs.select("name", "n") if known is None else pairs.select("name", "n").unionByName(known.select("name", "n"))
    names = materialize(names.groupBy("name").agg(F.sum("n").alias("n")), "names")
    # the word before the name may belong to something else, so the last word alone is tried too
    tried = pairs.select("name", F.explode(F.array_distinct(F.array("name", "last"))).alias("text")).distinct()
    if known is not None:
        tried = tried.join(known.select("name").distinct(), "name", "left_anti")
    tried = materialize(tried, "tried")
    near = A.near(tried.select(F.col("text").alias("name")).distinct(), names.where(F.col("n") >= RATIO).select(F.col("name").alias("entry")), 2).withColumnRenamed("name", "text")
    near = materialize(near, "near")
    near = tried.join(near, "text").join(names.withColumnRenamed("n", "own"), "name").join(names.select(F.col("name").alias("entry"), F.col("n").alias("of")), "entry").where(F.col("of") >= RATIO * F.col("own"))
    letters = lambda c: F.array_sort(F.split(F.col(c), ""))
    # letters in another order are one slip; two slips leave most of a name as it was
    near = near.withColumn("turned", letters("text") == letters("entry")).withColumn("slips", F.when(F.col("turned"), 1).otherwise(F.col("distance")))
    near = near.where((F.col("slips") < 2) | (F.length("entry") >= LONG)).where(F.col("own") <= SLACK + F.col("of") * F.pow(F.lit(2.0), -3 * F.col("slips") - 2))
    near = materialize(near, "near")
    if known is None:
        # what the name's own offers have in common decides for the names that aren't rare
        doubtful = near.where(F.col("own") > RARE).select("name", "entry").distinct()
        what = ["number", "beds", "baths", "rent", "city"]
        read = rows.where("last is not null and rent is not null").join((pairs.join(doubtful.select("name").unionByName(doubtful.select(F.col("entry").alias("name"))).distinct(), "name").select(F.col("prev").alias("_p"), F.col("last").alias("_l"), "name")), F.col("prev").eqNullSafe(F.col("_p")) & (F.col("last") == F.col("_l")))
        offered = materialize(read.groupBy("name", *what).agg(F.count(F.lit(1)).alias("n")), "offered")
        theirs = offered.select(F.col("name").alias("entry"), *what, F.lit(True).alias("hit"))
        shared = doubtful.join(offered, "name").join(theirs, ["entry", *what], "left").groupBy("name", "entry").agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("shared"))
        again = offered.groupBy(F.col("name").alias("entry")).agg((F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)) / F.sum("n")).alias("again"))
        alike = shared.join(again, "entry").where((F.col("shared") > 1) & (F.col("shared") >= A.ALIKE * F.col("again") * F.col("rows"))).select("name", "entry")
        near = near.where(F.col("own") <= RARE).unionByName(near.join(alike, ["name", "entry"], "left_semi"))
    else:
        near = near.where(F.col("own") <= RARE)
    # letters in another order are the likeliest slip, then the fewest edits, then the more frequent name
    order = F.struct(~F.col("turned"), "distance", -F.col("of"), "entry")
    best = near.groupBy("name").agg(F.min_by("entry", order).alias("entry"))
    out = pairs.join(best, "name", "left").select("prev", "last", F.coalesce("entry", "name").alias("name"), "n")
    return out if known is None else out.unionByName(again)


def coordinates(prefix: str = "") -> list[Column]:
    return [F.col(f"{prefix}{c}") for c in ("number", "beds", "baths", "rent", "place")]


def pivoted(offers_: DataFrame) -> DataFrame:
    """Adds the distances to the pivots in whole ``WEIGHT`` (d0, d1, ...), day and week."""
    out = {"day": F.floor(F.col("epoch") / DAY).cast("long")}
    for k, (name, *place) in enumerate(PIVOTS):
        out[f"d{k}"] = sum((F.abs(c - F.lit(x)) for c, x in zip(coordinates(), place)), F.levenshtein("name", F.lit(name)).cast("long")).cast("long")
    rows = offers_.withColumns(out)
    return rows.withColumn("week", F.floor(F.col("day") / 7).cast("int"))


def distance(a: str, b: str) -> Column:
    """The metric, in days, of two offers under prefixes a and b."""
    unlike = sum((F.abs(x - y) for x, y in zip(coordinates(a), coordinates(b))), F.levenshtein(F.col(f"{a}name"), F.col(f"{b}name")).cast("long"))
    return F.abs(F.col(f"{a}epoch") - F.col(f"{b}epoch")) / DAY + WEIGHT * unlike


DISTANCES = [f"d{k}" for k in range(len(PIVOTS))]
STORED = "id long, batch int, epoch long, name string, number int, beds int, baths int, rent long, place long, day long, " + ", ".join(f"{d} long" for d in DISTANCES) + ", week int"


class PivotTable:
    """The offers already seen, with their distances to the pivots, by weeks in the shared folder. Batches are appended, then
    checked; ``id``, ``batch`` say what is earlier."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch(spark, "pivots")

    def append(self, offers_: DataFrame) -> None:
        # a week that holds many rows is split by the engine, weeks of few rows share a task
        pivoted(offers_).hint("rebalance", "week").write.mode("append").partitionBy("week").parquet(self.path)

    def table(self, weeks: list[int] | None = None) -> DataFrame:
        """The stored offers, of these weeks only (a filter on the folders)."""
        rows = self.spark.read.schema(STORED).parquet(self.path)
        return rows if weeks is None else rows.where(F.col("week").isin(*weeks))

    def known(self, new: DataFrame) -> DataFrame:
        """(id) of the rows of ``new`` for which the table has an earlier row (by batch, id) within the bound. Reads the weeks of the
        new rows' postings and those next to them."""
        asked = materialize(pivoted(new).select("id", "batch", "epoch", *OFFER, *DISTANCES, "day", "week"), "asked")
        # one number for each week of the calendar that the batch touches
        weeks = sorted({w + k for (w,) in asked.select("week").distinct().collect() for k in (-1, 0, 1)})
        table = self.table(weeks)
        rank = F.struct("batch", "id")
        cells = table.groupBy(*OFFER, *DISTANCES, "day").agg(F.min(rank).alias("least"))
        old = cells.select(*[F.col(c).alias(f"o_{c}") for c in [*OFFER, *DISTANCES, "day"]], "least").withColumn("o_epoch", F.col("o_day") * DAY)
        wanted = asked.select(*OFFER, *DISTANCES, "day").distinct().withColumn("epoch", F.col("day") * DAY).withColumn("shift", F.explode(F.sequence(F.lit(-DAYS + 1), F.lit(DAYS - 1))))
        on = F.col("day") + F.col("shift") == F.col("o_day")
        for c in DISTANCES:
            on = on & (F.col(c) == F.col(f"o_{c}"))
        inside = wanted.join(old, on).where(distance("", "o_") <= DAYS).groupBy(*OFFER, "day").agg(F.min("least").alias("least"))
        first = inside.select(*[F.col(c).alias(f"w_{c}") for c in [*OFFER, "day"]], "least")
        on = F.col("day") == F.col("w_day")
        for c in OFFER:
            on = on & (F.col(c) == F.col(f"w_{c}"))
        # least is a row of at most six days away, possibly the row itself
        marked = asked.join(first, on, "left").withColumn("hit", F.coalesce(F.col("least") < rank, F.lit(False)))
        marked = materialize(marked.select("id", "batch", "epoch", *OFFER, *DISTANCES, "day", "hit"), "marked")
        rest = marked.where("not hit").withColumn("day_", F.explode(F.array(F.col("day") - DAYS, F.col("day") + DAYS)))
        border = table.select(*[F.col(c).alias(f"o_{c}") for c in ["id", "batch", "epoch", *OFFER, *DISTANCES, "day"]])
        on = F.col("day_") == F.col("o_day")
        for c in DISTANCES:
            on = on & (F.col(c) == F.col(f"o_{c}"))
        near = rest.join(border, on).where(distance("", "o_") <= DAYS).where(F.struct("o_batch", "o_id") < rank)
        return marked.where("hit").select("id").unionByName(near.select("id").distinct())


class History:
    """All that is kept between batches, under one path: the pivot table, the aliases of buildings' names and the timestamp
    dictionary. ``add`` takes rows with id, batch, title, city, state, epoch."""

    def __init__(self, spark: SparkSession, places: DataFrame, unit_rates: DataFrame, path: str | None = None):
        self.spark, self.places, self.unit_rates = spark, places, unit_rates
        self.path = path or scratch(spark, "history")
        self.pivots = PivotTable(spark, f"{self.path}/pivots")
        self.times = TimestampDictionary(spark, f"{self.path}/times")

    def aliases(self) -> DataFrame | None:
        from pyspark.errors import AnalysisException

        try:
            return self.spark.read.schema(ALIASES).parquet(f"{self.path}/aliases")
        except AnalysisException:
            return None

    def offers(self, rows: DataFrame) -> DataFrame:
        """(id, batch, epoch, name, number, beds, baths, rent, place) of the rows; the aliases of new spellings are appended.

        Rows without title, place or time, or whose title gives no building, rooms or rent, match nothing and are left out.
        """
        read = materialize(titles(rows.where("title is not null and city is not null and epoch is not null"), self.unit_rates).drop("title"), "offers")
        null = F.lit("\x00")
        named = materialize(building_names(read, self.aliases()), "named")
        named.write.mode("append").parquet(f"{self.path}/aliases")
        named = named.select(F.col("prev").alias("_p"), F.col("last").alias("_l"), "name")
        where = materialize(P.match_places(read.select("city", F.col("state").alias("state_or_province")), self.places, write=materialize).where("place_id > 0"), "places").select(F.col("city").alias("_c"), F.coalesce("state", null).alias("_s"), F.col("place_id").alias("place"))
        read = read.join(named, F.coalesce("prev", null).eqNullSafe(F.coalesce("_p", null)) & (F.col("last") == F.col("_l")))
        read = read.join(where, (F.col("city") == F.col("_c")) & (F.coalesce("state", null) == F.col("_s")))
        return read.select("id", "batch", "epoch", *OFFER).where("number is not null and beds is not null and baths is not null and rent is not null")

    def add(self, rows: DataFrame, check: bool = True) -> DataFrame | None:
        """Appends the rows; with ``check`` gives the ids of those that an earlier row offers already, the rows themselves included
        in their order of (batch, id). Only the weeks around the rows' postings are read of the history."""
        new = materialize(self.offers(rows), "batch")
        self.pivots.append(new)
        return self.pivots.known(new) if check else None

    def dated(self, listings: DataFrame, sources: DataFrame) -> DataFrame:
        """Listings (id, source_id, title_ko, city, state_or_province, posted_at_utc as text) as rows for ``add``, batch -2."""
        zones = sources.select(F.col("id").alias("source_id"), F.col("time_zone").alias("zone")).dropDuplicates(["source_id"])
        old = listings.select("id", "source_id", F.col("title_ko").alias("title"), "city", F.col("state_or_province").alias("state"), F.col("posted_at_utc").alias("raw"))
        old = old.join(zones, "source_id", "left")
        plain = F.unix_seconds(F.try_to_timestamp("raw", F.lit("yyyy-MM-dd'T'HH:mm:ssX")))
        other = old.where(F.col("raw").isNotNull() & ~F.col("raw").rlike(ISO_UTC))
        self.times.extend(other)
        dated = self.times.normalise(other).select("id", "title", "city", "state", "epoch")
        return dated.unionByName(old.where(F.col("raw").rlike(ISO_UTC)).select("id", "title", "city", "state", plain.alias("epoch"))).withColumn("batch", F.lit(-2))


def staged(staging: DataFrame) -> DataFrame:
    """Staging rows as rows for ``History.add``. NULL batches come before the first."""
    return staging.select("id", F.col("title_ko").alias("title"), "city", F.col("state_or_province").alias("state"), F.unix_seconds("posted_at_utc").alias("epoch"), F.coalesce("batch_no", F.lit(-1)).alias("batch"))


def repeated(listings: DataFrame, staging: DataFrame, sources: DataFrame, places: DataFrame, unit_rates: DataFrame) -> DataFrame:
    """(staging_id) of the staging rows that a listing or an earlier staging row (by batch, id) already offers.

    History is appended first, then all new rows with their order, so that one pass gives what adding batch by batch gives, but for
    names that a later batch spells for the first time. Empty tables give no rows.
    """
    history = History(staging.sparkSession, places, unit_rates)
    history.add(history.dated(listings, sources), check=False)
    return history.add(staged(staging)).select(F.col("id").alias("staging_id"))
