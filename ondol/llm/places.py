"""Free-typed places to rows of a reference list, by a partition-based pigeonhole join.

Distinct field texts are cleaned and cut into name parts. A reference string of length n may differ by k(n) edits; it is cut
into k + 1 segments, so that any text within k edits keeps one segment unchanged, moved by at most k places. Texts and
references meet in an equality join on these substrings with a bound on the positions, and the built-in ``levenshtein``
verifies. States are read from either field, in the forms that the reference's own state codes have. Pairs of fields that name no place come out of an anti-join with place 0.
Only the reference side is broadcast; its rows are bounded by ``MAX_PLACES``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PLACES = 100_000
SALTS = 16

#: States of the United States with their names in English and Korean and the traditional abbreviation.
US_STATES = """AL Alabama 앨라배마 Ala; AK Alaska 알래스카; AZ Arizona 애리조나 Ariz; AR Arkansas 아칸소 Ark; CA California 캘리포니아 Calif; CO Colorado 콜로라도 Colo; CT Connecticut 코네티컷 Conn;
DE Delaware 델라웨어 Del; FL Florida 플로리다 Fla; GA Georgia 조지아; HI Hawaii 하와이; ID Idaho 아이다호; IL Illinois 일리노이 Ill; IN Indiana 인디애나 Ind; IA Iowa 아이오와; KS Kansas 캔자스 Kans; KY Kentucky 켄터키;
LA Louisiana 루이지애나; ME Maine 메인; MD Maryland 메릴랜드; MA Massachusetts 매사추세츠 Mass; MI Michigan 미시간 Mich; MN Minnesota 미네소타 Minn; MS Mississippi 미시시피 Miss; MO Missouri 미주리; MT Montana 몬태나 Mont;
NE Nebraska 네브래스카 Nebr; NV Nevada 네바다 Nev; NH NewHampshire 뉴햄프셔; NJ NewJersey 뉴저지; NM NewMexico 뉴멕시코; NY NewYork 뉴욕; NC NorthCarolina 노스캐롤라이나; ND NorthDakota 노스다코타; OH Ohio 오하이오;
OK Oklahoma 오클라호마 Okla; OR Oregon 오리건 Ore; PA Pennsylvania 펜실베이니아 Penn; RI RhodeIsland 로드아일랜드; SC SouthCarolina 사우스캐롤라이나; SD SouthDakota 사우스다코타; TN Tennessee 테네시 Tenn; TX Texas 텍사스 Tex;
UT Utah 유타; VT Vermont 버몬트; VA Virginia 버지니아; WA Washington 워싱턴 Wash; WV WestVirginia 웨스트버지니아; WI Wisconsin 위스콘신 Wis; WY Wyoming 와이오밍 Wyo"""
#: The letters of the romanisation of Korean, by the place of a sound in its syllable.
INITIALS = ("g", "kk", "n", "d", "tt", "r", "m", "b", "pp", "s", "ss", "", "j", "jj", "ch", "k", "t", "p", "h")
MEDIALS = ("a", "ae", "ya", "yae", "eo", "e", "yeo", "ye", "o", "wa", "wae", "oe", "yo", "u", "wo", "we", "wi", "yu", "eu", "ui", "i")
FINALS = ("", "k", "k", "k", "n", "n", "n", "t", "l", "k", "m", "l", "l", "l", "p", "l", "m", "p", "p", "t", "t", "ng", "t", "t", "k", "t", "p", "t")


def romanised(text: str) -> str:
    """Syllable by syllable; other characters stay."""
    out = []
    for c in text:
        n = ord(c) - 0xAC00
        out.append(INITIALS[n // 588] + MEDIALS[n % 588 // 28] + FINALS[n % 28] if 0 <= n < 11172 else c)
    return "".join(out)


def checked(places: DataFrame) -> DataFrame:
    """The reference, refused above ``MAX_PLACES`` rows: it is broadcast, and its states are read to the driver."""
    if places.limit(MAX_PLACES + 1).count() > MAX_PLACES:
        raise ValueError(f"more than {MAX_PLACES} places")
    return places


def state_forms(places: DataFrame) -> dict[str, str]:
    """The forms of the states of a reference (lower case, without blanks and stops) -> the code in lower case: those of the
    states of the United States; of Korean ones the name and its romanisation, with and without its last syllable; of others the
    code itself."""
    known = {words[0]: words[1:] for words in (x.split() for x in US_STATES.split(";"))}
    out: dict[str, str] = {}
    for (code,) in checked(places).select("state_code").where("state_code is not null").distinct().collect():
        low = code.strip().lower()
        forms = [low, *[f.lower() for f in known.get(code.strip(), ())]]
        forms += [f + "주" for f in forms if "가" <= f[:1] <= "힣" and code.strip() in known]
        if "가" <= low[:1] <= "힣" and len(low) > 1:
            stem, last = romanised(low[:-1]), romanised(low[-1])
            forms += [f"{stem}-{last}", stem + last, stem]
        for f in forms:
            out.setdefault(f.replace(" ", "").replace(".", ""), low)
    return out


def forms_map(forms: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in forms.items() for x in kv]) if forms else F.lit(None).cast("map<string,string>")


#: Words around a place's name that aren't part of it.
AROUND = r"\b(?:city of|downtown|city|area|near|town of)\b|근처|다운타운|한인타운|직거래|인근|주변|시내"

WIDE, NARROW = "".join(chr(0xFF01 + i) for i in range(94)) + "　 ", "".join(chr(0x21 + i) for i in range(94)) + "  "


def folded(text: Column) -> Column:
    """Lower case, full-width forms and odd blanks made plain."""
    return F.lower(F.trim(F.regexp_replace(F.translate(text, WIDE, NARROW), r"[\s​﻿]+", " ")))


def key(text: Column) -> Column:
    """A name without the words around it, blanks and punctuation."""
    return F.regexp_replace(F.regexp_replace(text, AROUND, " "), r"[^0-9a-zà-ɏㄱ-힣一-鿿぀-ヿ;]+|^;+", "")


def edits(length: Column, hangul: Column) -> Column:
    """k(n): the edits allowed to a reference string of n characters."""
    return F.when(hangul, F.when(length >= 4, 1).otherwise(0)).otherwise(F.when(length >= 9, 4).when(length >= 7, 3).otherwise(0))


def stated(text: Column, forms: dict[str, str]) -> Column:
    """Whether a field holds a state in one of its forms."""
    return F.try_element_at(forms_map(forms), F.regexp_replace(folded(text), r"[ .]", "")).isNotNull()


def references(places: DataFrame) -> DataFrame:
    """(place_id, state, name, n, k): every name of every place."""
    names = F.array("city_en", "city_ko", "other_name", "zip")
    state = folded(F.col("state_code"))
    rows = places.select("place_id", state.alias("state"), F.explode(names).alias("name"))
    rows = rows.withColumn("name", key(folded(F.col("name")))).where("name <> ''").distinct()
    hangul = F.col("name").rlike(r"[가-힣]")
    return rows.withColumns({"n": F.length("name"), "k": F.when(F.col("name").rlike("^[0-9]+$"), 0).otherwise(edits(F.length("name"), hangul))})


def match_places(rows: DataFrame, places: DataFrame, city: str = "city", state: str = "state_or_province", write: Callable[[DataFrame, str], DataFrame] = lambda frame, what: frame) -> DataFrame:
    """(city, state, place_id) for every distinct pair of fields whose city is neither NULL nor blank; place_id 0 names none.

    Of several places the ones whose state is told win, then the smaller distance; a remaining tie names none. Where a state is
    told that contradicts every place of the name, none is named. Empty tables give no rows. More than ``MAX_PLACES`` places
    are refused.

    Several branches read the name parts, the references and the matches of names. ``write`` (``materialize``) cuts the plan
    there; a query that matches places among many other steps needs it, as the driver holds each plan again at every stage.
    """
    known = forms_map(state_forms(places))
    fields = rows.select(F.col(city).alias("city"), F.col(state).alias("state")).where(F.length(F.trim(F.regexp_replace(F.col("city"), r"[\s 　]+", " "))) > 0).distinct()
    split = lambda c: F.split(folded(F.coalesce(F.col(c), F.lit(""))), r"\s*[/,()\[\]|]\s*")
    stateless = lambda x: F.regexp_replace(x, r"[ .]", "")
    parts = F.array_distinct(F.filter(F.concat(split("city"), split("state")), lambda x: F.length(x) >= 1))
    fields = fields.withColumn("parts", parts)
    told = F.array_distinct(F.array_compact(F.transform("parts", lambda x: F.try_element_at(known, stateless(x)))))
    # "Harborview CA": a last word that is a state
    last = F.array_compact(F.transform("parts", lambda x: F.when(F.length(F.regexp_extract(x, r"\s(\S{2,12})$", 1)) > 0, F.try_element_at(known, stateless(F.regexp_extract(x, r"\s(\S{2,12})$", 1))))))
    fields = fields.withColumn("told", F.array_distinct(F.concat(told, last)))
    names = F.filter(F.array_distinct(F.transform("parts", key)), lambda x: F.length(x) >= 2)
    fields = write(fields.withColumn("name", F.explode_outer(names)), "parts")
    named = write(references(places), "references")
    refs = F.broadcast(named)
    texts = fields.select("name").where("name is not null").distinct()

    exact = texts.join(refs.select("place_id", F.col("name")), "name").select("name", "place_id", F.lit(0).alias("distance"))
    fuzzy = texts.join(F.broadcast(named.select("name").distinct()), "name", "left_anti")
    # k + 1 segments of a reference: lengths differ by one at most, the longer ones last
    seg = F.expr(
        "transform(sequence(0, k), i -> struct(cast(i * floor(n / (k + 1)) + greatest(0, i - (k + 1 - n % (k + 1))) as int) as at,"
        " cast(floor(n / (k + 1)) + case when i >= k + 1 - n % (k + 1) then 1 else 0 end as int) as size))"
    )
    pieces = named.where("k > 0").withColumn("s", F.explode(seg)).select("place_id", F.col("name").alias("ref"), "n", "k", F.col("s.at").alias("at"), F.expr("substring(name, s.at + 1, s.size)").alias("piece"))
    # a text longer or shorter than every reference by more than its edits is near none
    lengths = named.where("k > 0").select(F.explode(F.sequence(F.col("n") - F.col("k"), F.col("n") + F.col("k"))).alias("size")).distinct()
    fuzzy = fuzzy.withColumn("size", F.length("name")).join(F.broadcast(lengths), "size", "left_semi").drop("size")
    # the sizes that the references' own segments have
    sizes = F.broadcast(pieces.select(F.length("piece").alias("size")).distinct())
    grams = fuzzy.join(sizes, F.col("size") <= F.length("name"))
    grams = grams.select("name", F.posexplode(F.expr("transform(sequence(1, length(name) - size + 1), p -> substring(name, p, size))")).alias("pos", "piece"))
    near = grams.join(F.broadcast(pieces), "piece").where("abs(pos - at) <= k and abs(length(name) - n) <= k")
    near = near.select("name", "ref", "place_id", "k").distinct().withColumn("distance", F.levenshtein("name", "ref")).where("distance <= k").select("name", "place_id", "distance")
    found = write(exact.unionByName(near).groupBy("name", "place_id").agg(F.min("distance").alias("distance")), "matches")

    state_of = places.select("place_id", folded(F.col("state_code")).alias("own"))
    scored = fields.join(found, "name").join(F.broadcast(state_of), "place_id").withColumn("agrees", F.array_contains("told", F.col("own")))
    rank = F.struct((~F.col("agrees")).cast("int").alias("off"), F.col("distance").alias("distance"))
    per = scored.groupBy("city", "state", "place_id").agg(F.min(rank).alias("r"), F.first(F.size("told")).alias("told"))
    best = per.groupBy("city", "state").agg(F.min(F.struct("r", "place_id")).alias("b"), F.min("r").alias("least"), F.collect_list("r").alias("all"), F.first("told").alias("told"))
    ties = F.size(F.filter("all", lambda x: x == F.col("least")))
    matched = best.where((ties == 1) & ((F.col("b.r.off") == 0) | (F.col("told") == 0))).select("city", "state", F.col("b.place_id").alias("place_id"))
    pairs = fields.select("city", "state").distinct()
    same = lambda a, b: (a["city"] == b["city"]) & a["state"].eqNullSafe(b["state"])
    unmatched = pairs.join(matched, same(pairs, matched), "left_anti").withColumn("place_id", F.lit(0).cast("long"))
    return matched.unionByName(unmatched)


def place_of_rows(listings: DataFrame, places: DataFrame) -> DataFrame:
    """(listing_id, place_id) of every listing with a city, but for those that already hold a reference row's names exactly."""
    clean = checked(places).select(F.col("city_en").alias("c"), F.col("state_code").alias("s")).distinct()
    rows = listings.select("id", "city", F.col("state_or_province").alias("state"))
    rows = rows.join(F.broadcast(clean), (F.col("city") == F.col("c")) & (F.col("state") == F.col("s")), "left_anti")
    pairs = match_places(rows.withColumnRenamed("state", "state_or_province"), places)
    # a hot spelling may hold a third of the rows: its rows are spread over salts, the pairs repeated
    salted = pairs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnsRenamed({"city": "c", "state": "s"})
    rows = rows.withColumn("salt", (F.xxhash64("id") % SALTS + SALTS) % SALTS)
    joined = rows.join(salted, (F.col("city") == F.col("c")) & F.coalesce("state", F.lit("\x00")).eqNullSafe(F.coalesce("s", F.lit("\x00"))) & (rows["salt"] == salted["salt"]))
    return joined.select(F.col("id").alias("listing_id"), "place_id")
