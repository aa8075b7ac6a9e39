"""Same postal address written differently: a gazetteer built from the data itself.

1. Every address is parsed into house number, direction, street spelling, street type and what is left of the locality.
2. Localities: a postal code or a spelling of the reference places names one (pigeonhole join, see ``places``); other
   localities are named by their own spelling, and a field spelling that goes with one address spelling becomes its alias.
3. Streets: within each locality and over all localities, spellings are counted; a spelling joins the entry that is the
   nearest within ``EDITS`` edits and at least ``RATIO`` times as frequent, entries of the same locality first. A spelling of
   more than ``RARE`` rows joins it only if slips give so many and its rows stand at the entry's houses (``explained``).
4. Every address is resolved by a beam search over the entries of its street and its locality: the ``BEAM`` best hypotheses of
   the street are extended by the locality of the address, or by the one in which the gazetteer knows that house, and the
   best pair of street and locality stays.
5. Rows join on locality, street identifier, direction, type and number. Units do not matter for a building.

Only distinct spellings take part in comparisons; the rows move in equality joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import places as P

EDITS, RATIO, BEAM = 3, 4, 3
#: Rows up to which a spelling is rare whatever its neighbours, and how often, as against the rows of the entry itself, a
#: misspelling's rows must stand at houses of the entry.
RARE, ALIKE = 12, 0.75
#: Rows of a building that one slice of its pairs has.
SLICE = 512

#: Directions and street types with their spellings.
DIRECTIONS = {
    "n": "n no north", "s": "s so south", "e": "e east", "w": "w west",
    "ne": "ne northeast", "nw": "nw northwest", "se": "se southeast", "sw": "sw southwest",
}
TYPES = {
    "st": "st str street", "ave": "av ave avenue aven", "blvd": "bl blvd boulevard boul", "dr": "dr drv drive", "rd": "rd road",
    "ln": "ln lane", "ct": "ct crt court", "pl": "pl place", "way": "way wy", "pkwy": "pkwy pky parkway", "ter": "ter terr terrace",
    "cir": "cir circle", "hwy": "hwy highway", "sq": "sq square", "trl": "trl trail",
}

#: A side of a join that grows with the data, whatever its estimate says, is sorted and merged, not broadcast.
LARGE = "merge"
_forms = lambda table: "|".join(sorted((f for v in table.values() for f in v.split()), key=len, reverse=True))
_NAME = r"(?:\d{1,3}(?:st|nd|rd|th)|[a-z][a-z'.-]*)(?: [a-z][a-z'.-]*){0,3}?"
#: number, direction, name of one to four words or a number in order, type; without a type a name that a comma ends, after a number
#: that is no postal code; a Korean road (its name with a branch, then the number).
STREET = rf"(?<![\d#])(\d{{1,6}}) (?:({_forms(DIRECTIONS)})\b\.? )?({_NAME}) ({_forms(TYPES)})\b\.?"
UNTYPED = rf"(?<![\d#])(?!\d{{5}} )(\d{{1,6}}) (?:({_forms(DIRECTIONS)})\b\.? )?([a-z][a-z'-]{{2,}}(?: [a-z'-]+)?)() ?(?=[,/])"
ROAD = r"([가-힣]+[로길]) ?(\d+ ?(?:번 ?)?길)? ?(\d+(?:-\d+)?)(?![\d호층동])"
UNIT = r"(?:\b(?:apt|apartment|unit|ste|suite|rm|room)\b\.? ?#? ?[0-9a-z-]+|# ?[0-9a-z-]+|\d+ ?호)"


def _map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for k, v in table.items() for f in v.split() for x in (f, k)])


def parsed(rows: DataFrame, forms: dict[str, str], address: str = "address_raw") -> DataFrame:
    """Adds number, dir, street, kind (NULL where there is no street with a number) and rest (the locality part)."""
    t = F.regexp_replace(F.regexp_replace(P.folded(F.col(address)), UNIT, " , "), r"\s+", " ")
    rows = rows.withColumn("_t", t)
    whole = lambda p: F.nullif(F.regexp_extract("_t", p, 0), F.lit(""))
    rows = rows.withColumn("_typed", whole(STREET)).withColumn("_road", F.when(F.col("_typed").isNull(), whole(ROAD)))
    rows = rows.withColumn("_bare", F.when(F.col("_typed").isNull() & F.col("_road").isNull(), whole(UNTYPED)))
    rows = rows.withColumn("_s", F.coalesce("_typed", "_road", "_bare")).withColumn("_rest", F.replace("_t", F.coalesce("_s", F.lit(" ")), F.lit(" , ")))
    # the pattern of a part without a type looks ahead to a comma
    part = lambda k: F.when(F.col("_typed").isNotNull(), F.regexp_extract("_s", STREET, k)).otherwise(F.regexp_extract(F.concat("_bare", F.lit(",")), UNTYPED, k))
    g = lambda k: F.nullif(part(k), F.lit(""))
    on_road = F.col("_road").isNotNull()
    known = P.forms_map(forms)
    words = F.split(F.regexp_replace("_rest", r"\bnew (york|jersey)\b", "new$1"), r"[ ,/]+")
    rows = rows.withColumn("_w", F.filter(words, lambda x: (x != "") & ~x.isin("usa", "u.s.a", "u.s.a.")))
    bare = lambda x: F.replace(x, F.lit("."), F.lit(""))
    rows = rows.withColumn("_states", F.array_compact(F.transform("_w", lambda x: F.try_element_at(known, bare(x)))))
    name = F.array_join(F.filter("_w", lambda x: ~x.rlike(r"^\d{5}$") & F.try_element_at(known, bare(x)).isNull()), " ")
    return rows.withColumns(
        {
            "number": F.when(on_road, F.regexp_extract("_road", ROAD, 3)).otherwise(F.regexp_replace(g(1), "^0+(?=.)", "")),
            "dir": F.coalesce(F.element_at(_map(DIRECTIONS), g(2)), F.lit("")),
            "street": F.when(on_road, F.regexp_replace(F.concat(F.regexp_extract("_road", ROAD, 1), F.regexp_extract("_road", ROAD, 2)), "[ 번]", "")).otherwise(F.regexp_replace(g(3), r"[ '.-]", "")),
            "kind": F.when(on_road, "road").when(F.col("_bare").isNotNull(), "none").otherwise(F.element_at(_map(TYPES), g(4))),
            "zip": F.get(F.filter("_w", lambda x: x.rlike(r"^\d{5}$")), F.lit(0)),
            "addr_state": F.get("_states", F.lit(0)),
            "addr_name": F.nullif(P.key(name), F.lit("")),
        }
    ).drop("_t", "_typed", "_road", "_bare", "_s", "_rest", "_w", "_states")


def localities(rows: DataFrame, places: DataFrame, forms: dict[str, str]) -> DataFrame:
    """(city, state, zip, addr_state, addr_name, locality, sure) for every distinct combination of locality evidence.

    locality is NULL where the evidence names none.
    """
    evidence = rows.select("city", "state", "zip", "addr_state", "addr_name").distinct()
    # the fields may be swapped, so both are read for a name; the state of the address counts before that of the fields
    evidence = evidence.withColumns({"_fields": F.concat_ws(" / ", "city", F.when(F.col("addr_state").isNull() | ~P.stated(F.col("state"), forms), F.col("state"))), "_told": F.coalesce("addr_state", F.when(P.stated(F.col("state"), forms), F.col("state")))})
    # what several branches read is written first: the plans, which the driver keeps, would hold it once for each branch
    evidence = materialize(evidence, "evidence")
    # one call for both, so that the references and the spellings are cut once
    asked = evidence.select(F.explode(F.array("_fields", "addr_name")).alias("city"), F.col("_told").alias("state_or_province"))
    answers = materialize(P.match_places(asked, places, write=materialize).where("place_id > 0"), "localities")
    zips = F.broadcast(places.select(F.col("zip").alias("_z"), F.col("place_id").alias("_by_zip")).where("_z is not null").dropDuplicates(["_z"]))

    def joined(left: DataFrame, city: str, to: str) -> DataFrame:
        r = answers.select(F.col("city").alias("_c"), F.coalesce("state", F.lit("\x00")).alias("_st"), F.col("place_id").alias(to))
        return left.join(r.hint(LARGE), (F.col(city) == F.col("_c")) & (F.coalesce("_told", F.lit("\x00")) == F.col("_st")), "left").drop("_c", "_st")

    e = joined(joined(evidence, "addr_name", "_by_addr"), "_fields", "_by_field").join(zips, F.col("zip") == F.col("_z"), "left").drop("_z")
    place = F.coalesce("_by_zip", "_by_addr", "_by_field")
    field_name = P.key(P.folded(F.regexp_replace("city", r"[`~\[\]()]", " ")))
    e = e.withColumns({"_place": place, "_own": F.when(place.isNull(), F.col("addr_name")), "_field": F.when(place.isNull() & (F.length(field_name) >= 2), field_name)})
    e = materialize(e.select("city", "state", "zip", "addr_state", "addr_name", "_place", "_own", "_field"), "named")
    # a field spelling that goes with an address spelling is its alias; the most frequent one counts
    alias = e.where("_own is not null and _field is not null and _own <> _field").groupBy("_field", "_own").count()
    alias = alias.groupBy("_field").agg(F.max_by("_own", F.struct("count", "_own")).alias("_alias"))
    named = e.where("_own is not null").select(F.col("_own").alias("_field")).distinct().withColumn("_is_name", F.lit(True))
    e = e.join(alias.hint(LARGE), "_field", "left").join(named.hint(LARGE), "_field", "left")
    own = F.coalesce("_own", F.when(F.col("_is_name"), F.col("_field")), F.col("_alias"))
    return e.select("city", "state", "zip", "addr_state", "addr_name", F.coalesce(F.concat(F.lit("p"), F.col("_place").cast("string")), F.concat(F.lit("n:"), own)).alias("locality"))


def near(texts: DataFrame, entries: DataFrame, k: int = EDITS) -> DataFrame:
    """(name, entry, distance) of distinct spellings within k edits, by segments (columns name and entry, both distinct)."""
    n = F.length("entry")
    seg = F.expr(
        f"transform(sequence(0, {k}), i -> struct(cast(i * floor(n / {k + 1}) + greatest(0, i - ({k + 1} - n % {k + 1})) as int) as at,"
        f" cast(floor(n / {k + 1}) + case when i >= {k + 1} - n % {k + 1} then 1 else 0 end as int) as size))"
    )
    pieces = entries.where(n > k).withColumn("n", n).withColumn("s", F.explode(seg)).select("entry", "n", F.col("s.at").alias("at"), F.expr("substring(entry, s.at + 1, s.size)").alias("piece"))
    # the segment sizes that references of about this length have
    low, high = F.floor((F.length("name") - k) / (k + 1)), F.floor((F.length("name") + k) / (k + 1)) + 1
    low, high = F.greatest(F.lit(1), low).cast("int"), F.least(F.length("name"), high).cast("int")
    grams = texts.where(F.length("name") > 0).withColumn("size", F.explode(F.sequence(low, high))).select("name", F.posexplode(F.expr("transform(sequence(1, length(name) - size + 1), p -> substring(name, p, size))")).alias("pos", "piece"))
    # the estimate of an exploded side is too small for the planner to be left to broadcast it
    met = grams.join(pieces.hint("shuffle_hash"), "piece").where(f"abs(pos - at) <= {k} and abs(length(name) - n) <= {k} and name <> entry")
    return met.select("name", "entry").distinct().withColumn("distance", F.levenshtein("name", "entry")).where(f"distance <= {k}")


def explained(rare: DataFrame, frequent: DataFrame, houses: DataFrame) -> DataFrame:
    """(name, entry, distance, of_entry) of the spellings that a much more frequent one explains; both have street and n.

    Frequency alone decides for spellings of up to ``RARE`` rows. More rows than the slip rate lets expect stand for a street of
    its own; as many as it lets expect are a misspelling only if they are found at the entry's houses about as often as the
    entry's own rows meet each other there.
    """
    pairs = near(rare.select(F.col("street").alias("name")), frequent.select(F.col("street").alias("entry")))
    pairs = pairs.join(rare.select(F.col("street").alias("name"), F.col("n").alias("own")).hint(LARGE), "name").join(frequent.select(F.col("street").alias("entry"), F.col("n").alias("of_entry")).hint(LARGE), "entry")
    pairs = pairs.where(F.col("of_entry") >= F.when(F.col("distance") > 2, 3 * RATIO).otherwise(RATIO) * F.col("own"))
    pairs = materialize(pairs.where((F.col("own") <= RARE) | (F.col("own") <= F.col("of_entry") * F.pow(F.lit(2.0), -3 * F.col("distance") - 2))), "explained")
    doubtful = pairs.where(F.col("own") > RARE).select("name", "entry")
    at = [c for c in houses.columns if c not in ("street", "n")]
    theirs = houses.select(F.col("street").alias("entry"), *at)
    mine = doubtful.join(houses.withColumnRenamed("street", "name"), "name")
    shared = mine.join(theirs.withColumn("hit", F.lit(True)), ["entry", *at], "left").groupBy("name", "entry").agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("shared"))
    again = houses.join(doubtful.select(F.col("entry").alias("street")).distinct(), "street").groupBy(F.col("street").alias("entry")).agg((F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)) / F.sum("n")).alias("again"))
    slips = shared.join(again, "entry").where((F.col("shared") > 1) & (F.col("shared") >= ALIKE * F.col("again") * F.col("rows"))).select("name", "entry")
    return pairs.where(F.col("own") <= RARE).unionByName(pairs.join(slips, ["name", "entry"], "left_semi")).drop("own")


def streets(rows: DataFrame) -> DataFrame:
    """(locality, street, entry, distance): up to ``BEAM`` gazetteer entries of every street spelling that isn't an entry itself.

    Entries are the spellings that no much more frequent entry explains. Equally near ones of the same locality come first.
    """
    here = materialize(rows.groupBy("locality", "street").agg(F.count(F.lit(1)).alias("n")), "streets")
    everywhere = materialize(here.groupBy("street").agg(F.sum("n").alias("n")), "streets")
    houses = materialize(rows.where("locality is not null").groupBy("locality", "number", "dir", "kind", "street").agg(F.count(F.lit(1)).alias("n")), "houses")
    # entries are found among the leading spellings first, then among those that these don't explain; the split only spares
    # comparisons, as every spelling meets the entries of both
    most = everywhere.agg(F.max("n")).first()[0] or 0
    lead = F.col("n") >= max(RATIO, RATIO * int(most**0.5))
    without = lambda frame, pairs: frame.join(pairs.select(F.col("name").alias("street")).distinct().hint(LARGE), "street", "left_anti")
    leading, others = everywhere.where(lead), everywhere.where(~lead)
    merged = materialize(explained(leading, leading, houses), "spellings")
    entries = without(leading, merged)
    first = materialize(explained(others, entries, houses), "spellings")
    left = materialize(without(others, first).where(F.col("n") >= RATIO), "left")
    lesser = without(left, materialize(explained(left, left, houses), "spellings"))
    pairs = merged.join(entries.select(F.col("street").alias("entry")).hint(LARGE), "entry", "left_semi").unionByName(first).unionByName(explained(others, lesser, houses))
    pairs = materialize(pairs, "spellings")
    known = here.select(F.col("locality").alias("_l"), F.col("street").alias("_s"), F.col("n").alias("local"))
    scored = here.join(pairs.hint(LARGE), F.col("street") == F.col("name")).join(known.hint(LARGE), F.col("_l").eqNullSafe(F.col("locality")) & (F.col("_s") == F.col("entry")), "left")
    order = F.struct("distance", F.col("local").isNull().alias("away"), (-F.coalesce("local", F.lit(0))).alias("l"), (-F.col("of_entry")).alias("o"), "entry")
    beam = scored.groupBy("locality", "street").agg(F.array_sort(F.collect_list(order)).alias("beam"))
    return beam.select("locality", "street", F.posexplode(F.slice("beam", 1, BEAM)).alias("rank", "h")).select("locality", "street", "rank", "h.entry", "h.distance")


def resolve(listings: DataFrame, places: DataFrame) -> DataFrame:
    """(id, locality, number, dir, entry, kind) of every listing whose address has a street and a house number.

    NULL and empty addresses and those without a number have none. Rows without a locality of their own take the only one in
    which the gazetteer knows their house; otherwise their locality stays NULL, which matches nothing.
    """
    forms = P.state_forms(places)
    rows = parsed(listings.select("id", "city", F.col("state_or_province").alias("state"), "address_raw").where(F.length(F.trim("address_raw")) > 0), forms).drop("address_raw")
    # the filter waits until the columns are written: pushed into the projection it would parse every address again
    rows = materialize(rows, "addresses").where("number is not null and kind is not null")
    keys = ["city", "state", "zip", "addr_state", "addr_name"]
    where = localities(rows, places, forms).withColumnsRenamed({k: f"_{k}" for k in keys})
    null = F.lit("\x00")
    cond = F.coalesce("city", null) == F.coalesce("_city", null)
    for k in keys[1:]:
        cond = cond & (F.coalesce(k, null) == F.coalesce(f"_{k}", null))
    rows = materialize(rows.join(where.hint(LARGE), cond, "left").select("id", "number", "dir", "street", "kind", "locality"), "located")
    house = ["number", "dir", "entry", "kind"]
    beams = materialize(streets(rows).withColumnsRenamed({"locality": "_l", "street": "_s"}), "gazetteer")
    typed = rows.join(beams.select("_l", "_s").distinct().hint(LARGE), F.coalesce("locality", null).eqNullSafe(F.coalesce("_l", null)) & (F.col("street") == F.col("_s")), "left")
    typed = materialize(typed, "typed")
    plain = typed.where("_s is null").select("id", "locality", "number", "dir", F.col("street").alias("entry"), "kind")
    # hypotheses of the misspelt rows; a house that the gazetteer knows outweighs one edit
    open_rows = typed.where("_s is not null").drop("_l", "_s").join(beams.hint(LARGE), F.coalesce("locality", null).eqNullSafe(F.coalesce("_l", null)) & (F.col("street") == F.col("_s")))
    houses = plain.where("locality is not null").select(F.col("locality").alias("_hl"), *[F.col(k).alias(f"_h{k}") for k in house]).distinct()
    same = F.col("locality") == F.col("_hl")
    for k in house:
        same = same & (F.col(k) == F.col(f"_h{k}"))
    scored = open_rows.join(houses.hint(LARGE), same, "left")
    # a row without a locality is weighed at every hypothesis with the only locality that has this house
    alone = houses.groupBy(*[F.col(f"_h{k}").alias(k) for k in house]).agg(F.min("_hl").alias("_one"), F.max("_hl").alias("_two")).where("_one = _two").drop("_two")
    scored = scored.join(alone.hint(LARGE), house, "left").withColumn("_at", F.coalesce("locality", "_one"))
    scored = scored.withColumn("_score", F.col("distance") - F.when(F.col("_hl").isNotNull() | (F.col("locality").isNull() & F.col("_one").isNotNull()), 1).otherwise(0))
    chosen = scored.groupBy("id").agg(F.min_by(F.struct(F.col("_at").alias("locality"), *house), F.struct("_score", "distance", "rank")).alias("h")).select("id", "h.*")
    rows = materialize(plain.unionByName(chosen), "settled")
    only = rows.where("locality is not null").groupBy(*house).agg(F.min("locality").alias("_one"), F.max("locality").alias("_two")).where("_one = _two").drop("_two")
    lost = rows.where("locality is null").join(only.hint(LARGE), house, "left").withColumn("locality", F.col("_one")).drop("_one")
    return rows.where("locality is not null").unionByName(lost).select("id", "locality", *house)


def unparsed(listings: DataFrame, places: DataFrame) -> DataFrame:
    """(listing_id, address_raw) of the listings whose address isn't blank but gives no house number with a street."""
    rows = parsed(listings.select("id", "address_raw").where(F.length(F.trim("address_raw")) > 0), P.state_forms(places))
    # as in ``resolve`` the filter waits until the columns are written
    rows = materialize(rows.select("id", "address_raw", "number", "kind"), "parsed")
    return rows.where("number is null or kind is null").select(F.col("id").alias("listing_id"), "address_raw")


HOUSE = ["locality", "number", "dir", "entry", "kind"]


def buildings(listings: DataFrame, places: DataFrame) -> DataFrame:
    """(listing_id, building, links): the class of every listing that stands at a building, named by its least listing, and the
    number of other listings there."""
    rows = materialize(resolve(listings, places).where("locality is not null"), "resolved")
    sizes = rows.groupBy(*HOUSE).agg(F.min("id").alias("building"), (F.count(F.lit(1)) - 1).alias("links"))
    return rows.join(sizes, HOUSE).select(F.col("id").alias("listing_id"), "building", "links")


def same_building(listings: DataFrame, places: DataFrame) -> DataFrame:
    """(listing_id_a, listing_id_b), a < b: all pairs of listings at the same house number, street and city.

    The pairs of a building are made in slices of about ``SLICE`` of its rows, so that one of many rows is no single task."""
    rows = materialize(buildings(listings, places), "buildings")
    slices = F.ceil((F.col("links") + 1) / SLICE).cast("int")
    a = rows.where("links > 0").select(F.col("listing_id").alias("listing_id_a"), "building", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
    b = rows.where("links > 0").select(F.col("listing_id").alias("listing_id_b"), "building", F.pmod(F.xxhash64("listing_id"), slices).cast("int").alias("slice"))
    return a.join(b, ["building", "slice"]).where("listing_id_a < listing_id_b").select("listing_id_a", "listing_id_b")
