import pytest
from pyspark.sql import functions as F

from conftest import rows
from ondol.llm import addresses, places

REFS = [
    (1, "Harborview", "하버뷰", "CA", "10037", "HBV"), (6, "Maplemont", "메이플몬트", "NJ", "15622", None), (73, "Maplemont", "메이플몬트", "TX", "90461", None),
    (9, "Stonemont", "스톤몬트", "NY", "18973", None), (10, "Stoneport", "스톤포트", "TX", "20090", None), (67, "Darimok", "다리목구", "나래도", "83759", None),
]
CASES = [
    ("Harborview", "CA", None), ("HARBORVIEW", "California", 1), ("Ｈａｒｂｏｒｖｉｅｗ", None, 1), ("하 버뷰", None, 1), ("Harobrview", "ca", 1), ("HBV", "캘리포니아", 1),
    ("CA", "Harborview", 1), ("Harborview, CA", None, 1), ("City of 하버뷰", " CA", 1), ("하버뷰/Harborview", "Calif.", 1), ("[Harborview]", "", 1), ("`Harborview", "CA", 1),
    ("Maplemont", "N.J.", 6), ("메이플몬트 (직거래)", "텍사스", 73), ("Maplemont", None, 0), ("Stoneont", "NY", 9), ("Stone Port", "TEXAS", 10), ("Harborview", "TX", 0),
    ("Dairmok", "Narae-do", 67), ("Quagmere", "TX", 0), ("문의", None, 0), ("TX", None, 0), ("x" * 5000, "CA", 0), ("", "CA", None), ("  ", None, None), (None, "CA", None),
]


@pytest.fixture(scope="module")
def refs(spark):
    return spark.createDataFrame(REFS, "place_id long, city_en string, city_ko string, state_code string, zip string, other_name string")


def test_forms_of_places(spark, refs):
    df = spark.createDataFrame([(k, c, s) for k, (c, s, _) in enumerate(CASES)], "id long, city string, state_or_province string").withColumn("place_id", F.lit("clash"))
    df = df.unionByName(df.where("id = 4").withColumn("id", F.lit(99).cast("long")))
    got = {r.listing_id: r.place_id for r in places.place_of_rows(df, refs).collect()}
    assert got == {k: p for k, (_, _, p) in enumerate(CASES) if p is not None} | {99: 1}


def test_empty_tables(spark, refs):
    df = spark.createDataFrame([(1, "Harborview", None)], "id long, city string, state_or_province string")
    assert places.place_of_rows(df.limit(0), refs).count() == 0
    assert rows(places.place_of_rows(df, refs.limit(0))) == [(1, 0)]


def test_pigeonhole_join_finds_what_brute_force_finds(spark, refs):
    base = ["harborview", "maplemont", "stonemont", "stoneport"]
    texts = sorted({w[:a] + x + w[a + d :] for w in base for a in range(0, len(w), 2) for d in (0, 1, 2) for x in ("", "q", "zz")})
    names = spark.createDataFrame([(t,) for t in texts if t], "name string")
    entries = spark.createDataFrame([(b,) for b in base], "entry string")
    got = rows(addresses.near(names, entries, 3), "name", "entry")
    want = rows(names.crossJoin(entries).where("name <> entry").where(F.levenshtein("name", "entry") <= 3))
    assert got == want


ADDRESSES = [
    (1, "Harborview", "CA", "100 West Amberwick Avenue Apt 179 Harborview California 10037"), (2, "문의", None, "10037 / 100 W. AMBERWICK AVE"), (3, "Harborview", "CA", "#12, １００ w amberwick av, Harborveiw, CA"),
    (4, "Harborview", "CA", "100 East Amberwick Ave, Harborview, CA"), (5, "Harborview", "CA", "102 W Amberwick Ave"), (6, "Stoneport", "TX", "100 W Amberwick Ave, Stoneport, TX"),
    (7, "Harborview", "CA", "100 W Amberwick Street"), (8, "Tidewick", "TX", "5 Rowan Str, Tidewick"), (9, "타이드윅", "TX", "5 Rowan St., Tidewick 3호"), (10, "CA", "Harborview", "100 W. Amberwick Ave. 7호 CA"),
    (11, None, None, None), (12, None, None, ""), (13, None, None, "no street here"), (14, "Harborview", "CA", "100 West Amberwick Avenue Apt 179 Harborview California 10037"),
]


def test_pairs_of_the_same_building(spark, refs):
    df = spark.createDataFrame(ADDRESSES, "id long, city string, state_or_province string, address_raw string").withColumn("locality", F.lit(1))
    got = rows(addresses.same_building(df, refs))
    group = [1, 2, 3, 10, 14]
    assert got == sorted([(a, b) for a in group for b in group if a < b] + [(8, 9)], key=str)
    assert addresses.same_building(df.limit(0), refs).count() == 0


def test_misspelt_streets_join_the_frequent_spelling(spark, refs):
    right = [(k, "Harborview", "CA", f"{k} W Larkspurmoor Dr, Harborview") for k in range(1, 9)]
    df = spark.createDataFrame([*right, (20, "Harborview", "CA", "3 W Larkspumoor Dr, Harborview"), (21, "Harborview", "CA", "4 W Larkspurmoro Drive")], "id long, city string, state_or_province string, address_raw string")
    assert rows(addresses.same_building(df, refs)) == [(3, 20), (4, 21)]


def test_attested_streets_stand_beside_a_hot_one(spark, refs):
    # two rows at every house of the hot street; the first real street shares its numbers, the second is one edit away, the third
    # name is a frequent slip of the hot one and stands at its houses
    streets = [("Larkspurmoor", 1, 1000, 2), ("Larkspurmont", 1, 15, 2), ("Larkspurmoon", 5001, 15, 2), ("Larkspurmor", 101, 30, 1)]
    at = [(name, number) for name, first, n, times in streets for number in range(first, first + n) for _ in range(times)]
    df = spark.createDataFrame([(k, "Harborview", "CA", f"{number} W {name} Dr, Harborview") for k, (name, number) in enumerate(at)], "id long, city string, state_or_province string, address_raw string")
    real = [("Larkspurmoor" if name == "Larkspurmor" else name, number) for name, number in at]
    got = rows(addresses.same_building(df, refs))
    houses = {}
    for k, house in enumerate(real):
        houses.setdefault(house, []).append(k)
    assert sorted(got) == sorted((a, b) for ids in houses.values() for a in ids for b in ids if a < b)


def test_a_spelling_joins_the_nearest_street_though_another_leads(spark, refs):
    # the slip is one edit from a street of 40 rows and three from one of 2000
    at = [("Amberwickmoor", k, "Dr") for k in range(2000)] + [("Amberwickont", k, "Dr") for k in range(40)] + [("Amberwickoont", 7, "Dr")]
    df = spark.createDataFrame([(k, "Harborview", "CA", f"{number + 1} W {name} {kind}, Harborview") for k, (name, number, kind) in enumerate(at)], "id long, city string, state_or_province string, address_raw string")
    assert rows(addresses.same_building(df, refs)) == [(2007, 2040)]


def test_long_references_are_found(spark, refs):
    # four edits leave segments of seven letters, one edit one of six syllables
    long = spark.createDataFrame([(1, "Abcdefghijklmnopqrstuvwxyzabcdefghi", "가나다라마바사아자차카타", "CA", None, None)], refs.schema)
    df = spark.createDataFrame([(1, "abcdefXhijklmXopqrstXvwxyzaXcdefghi", None), (2, "가나다라마바사아자하카타", None), (3, "가나다라마바하아자하카타", None)], "id long, city string, state_or_province string")
    assert rows(places.place_of_rows(df, long)) == [(1, 1), (2, 1), (3, 0)]
    word = "abcdefghijklmnopqrstuvwxyzabcdefghijklmnopqr"
    slip = "".join("Q" if k in (9, 20, 31) else c for k, c in enumerate(word))
    assert rows(addresses.near(spark.createDataFrame([(slip,)], "name string"), spark.createDataFrame([(word,)], "entry string"), 3)) == [(slip, word, 3)]


def test_too_many_references_are_refused(spark, refs, monkeypatch):
    monkeypatch.setattr(places, "MAX_PLACES", 3)
    with pytest.raises(ValueError, match="places"):
        places.match_places(spark.createDataFrame([("Harborview", None)], "city string, state_or_province string"), refs)


FORMS = [
    (1, "123 Martin Luther King Blvd, Harborview"), (2, "123 Martin Luther King Boulevard Apt 4, Harborview"), (3, "45 5th Ave, Harborview, CA"), (4, "45 5th Avenue Harborview"), (5, "12 Broadway, Harborview"), (6, "12 Broadway , Harborview, CA"),
    (7, "하버뷰 해오름로 29길 65-4"), (8, "해오름로29길 65-4, 하버뷰"), (9, "하버뷰 해오름로 29번길 65-5"), (10, "하버뷰 해오름로 65"), (11, "10037 Harborview, CA"), (12, "near the park"), (13, ""), (14, None), (15, "7 St. James Pl, Harborview"), (16, "7 St James Place, Harborview"),
]


def test_forms_of_streets_and_the_rest_reported(spark, refs):
    df = spark.createDataFrame([(k, "Harborview", "CA", a) for k, a in FORMS], "id long, city string, state_or_province string, address_raw string")
    assert rows(addresses.same_building(df, refs)) == [(1, 2), (15, 16), (3, 4), (5, 6), (7, 8)]
    assert rows(addresses.unparsed(df, refs), "listing_id") == [(11,), (12,)]
    assert {r.listing_id: (r.building, r.links) for r in addresses.buildings(df, refs).collect()}[4] == (3, 1)


def test_a_large_building_is_paired_in_slices(spark, refs, monkeypatch):
    monkeypatch.setattr(addresses, "SLICE", 7)
    df = spark.createDataFrame([(k, "Harborview", "CA", "9 W Amberwick Ave, Harborview") for k in range(60)], "id long, city string, state_or_province string, address_raw string")
    assert rows(addresses.same_building(df, refs)) == sorted([(a, b) for a in range(60) for b in range(60) if a < b], key=str)


def test_states_of_the_reference(spark, refs):
    forms = places.state_forms(refs)
    assert forms["narae-do"] == forms["naraedo"] == forms["나래도"] == "나래도" and forms["california"] == forms["캘리포니아주"] == forms["calif"] == "ca" and "ohio" not in forms
    assert places.state_forms(refs.limit(0)) == {}


def test_plans_of_addresses_stay_small(spark, refs, monkeypatch):
    # the driver holds the plan of a write again at each of its stages; one read 27 tables
    read, write = [], addresses.materialize
    monkeypatch.setattr(addresses, "materialize", lambda df, what: read.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size()) or write(df, what))
    df = spark.createDataFrame(ADDRESSES, "id long, city string, state_or_province string, address_raw string")
    addresses.same_building(df, refs)
    assert max(read) <= 12


def test_places_are_the_same_with_written_steps(spark, refs):
    df = spark.createDataFrame([(c, s) for c, s, _ in CASES], "city string, state_or_province string")
    written = []
    got = places.match_places(df, refs, write=lambda frame, what: written.append(what) or addresses.materialize(frame, what))
    assert rows(got) == rows(places.match_places(df, refs)) and len(written) == 3
    none = places.match_places(df.limit(0), refs.limit(0), write=addresses.materialize)
    assert rows(none) == []
