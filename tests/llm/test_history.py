import datetime
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ondol.llm import history as H


@pytest.fixture(scope="module")
def small(spark):
    places = spark.createDataFrame([(1, "Harborview", "하버뷰", "CA", "10037", None), (9, "Stonemont", "스톤몬트", "NY", "18973", None)], "place_id long, city_en string, city_ko string, state_code string, zip string, other_name string")
    rates = spark.createDataFrame([("USD", "usd_per_unit", 1.0), ("KRW", "usd_per_unit", 0.00075), ("day", "units_per_year", 365.0), ("week", "units_per_year", 52.0), ("month", "units_per_year", 12.0), ("year", "units_per_year", 1.0)], "unit_name string, kind string, factor double")
    sources = spark.createDataFrame([(1, "America/Los_Angeles")], "id int, time_zone string")
    return places, rates, sources


TITLES = [
    ("한빛 파크 1단지 스튜디오 1바스 월세 650불", ("한빛", "파크", 1, 0, 10, 65000)), ("[하버뷰] $2,410 / 2b1.5b / 미르테라스 36단지", (None, "미르테라스", 36, 2, 15, 241000)), ("방3 화1 월151만 아파트 달빛맨션 26단지!!", ("아파트", "달빛맨션", 26, 3, 10, 113250)),
    ("원룸형 화2 - 주 $802 - 은하 코트 3단지", ("은하", "코트", 3, 0, 20, 347533)), ("4베드 2바스 연 $34,080 별하 힐스 4단 지", ("별하", "힐스", 4, 4, 20, 284000)),
]


def test_titles(spark, small):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(TITLES)] + [(90, "그냥 글"), (91, ""), (92, None)], "id long, title string")
    got = {r.id: (r.prev, r.last, r.number, r.beds, r.baths, r.rent) for r in H.titles(df, small[1]).collect()}
    assert {k: got[k][1:] for k in range(len(TITLES))} == {k: v[1:] for k, (_, v) in enumerate(TITLES)}
    assert got[90][2] is None and got[92] == (None,) * 6


def made(n, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        name = rng.choice(["한빛 파크", "한빛파크", "은하 코트", "은하 코브"])
        at = datetime.datetime(2025, 12, 1) + datetime.timedelta(hours=rng.randrange(24 * 40))
        out.append((k, f"{name} {rng.choice([1, 2])}단지 {rng.choice(['2b1b', '2베드 1바스', '방3 화1'])} {rng.choice(['$1,500', '1500불', '$1,600'])}", rng.choice(["하버뷰", "Harborview", "Stonemont"]), at))
    return out


def brute(old, new):
    """Staging ids that an earlier row already offers."""

    def key(t, city):
        name = t.split(" ")[0] + t.split(" ")[1] if t.split(" ")[1] in ("파크", "코트", "코브") else t.split(" ")[0]
        number = t.split("단지")[0].split(" ")[-1]
        return name, number, "3" if "방3" in t else "2", "1600" if "1,600" in t else "1500", "S" if city == "Stonemont" else "H"

    seen = [(key(t, c), at, (-2, k)) for k, t, c, at in old] + [(key(t, c), at, (b, k)) for k, b, t, c, at in new]
    return sorted(k for k, b, t, c, at in new if any(q == key(t, c) and abs((at - x).total_seconds()) <= 7 * 86400 and o < (b, k) for q, x, o in seen))


def test_against_brute_force(spark, small):
    places, rates, sources = small
    old = made(60, 1)
    new = [(k, k // 20, t, c, at) for k, t, c, at in made(80, 2)]
    listings = spark.createDataFrame([(k, 1, t, c, None, at.strftime("%Y-%m-%dT%H:%M:%SZ") if k % 2 else at.strftime("%Y%m%dT%H%M%SZ")) for k, t, c, at in old] + [(900, 1, None, None, None, None)], "id long, source_id int, title_ko string, city string, state_or_province string, posted_at_utc string")
    staging = spark.createDataFrame(new + [(901, 1, None, "하버뷰", None), (902, None, "", None, new[0][4])], "id long, batch_no int, title_ko string, city string, posted_at_utc timestamp").withColumn("state_or_province", F.lit(None).cast("string"))
    got = [r[0] for r in rows(H.repeated(listings, staging, sources, places, rates))]
    assert sorted(got) == brute(old, new)
    assert H.repeated(listings.limit(0), staging.limit(0), sources, places, rates).count() == 0


def test_batch_by_batch_gives_the_same(spark):
    rng = random.Random(4)
    data = [(k, k // 25, 1_700_000_000 + rng.randrange(40 * 86400), rng.choice("ab"), rng.choice([1, 2]), 2, 10, 150000, 1) for k in range(100)]
    df = spark.createDataFrame(data, "id long, batch int, epoch long, name string, number int, beds int, baths int, rent long, place long")
    whole = H.PivotTable(spark)
    whole.append(df)
    at_once = rows(whole.known(df))
    table, steps = H.PivotTable(spark), []
    for b in range(4):
        table.append(df.where(F.col("batch") == b))
        steps += rows(table.known(df.where(F.col("batch") == b)))
    assert sorted(at_once) == sorted(steps) and at_once
    close = [r for r in data if any(o[3:] == r[3:] and abs(o[2] - r[2]) <= 7 * 86400 and (o[1], o[0]) < (r[1], r[0]) for o in data)]
    assert sorted(k for (k,) in at_once) == sorted(r[0] for r in close)


def test_batches_end_to_end_read_their_weeks_only(spark, small):
    places, rates, sources = small
    old, new = made(120, 3), [(k, k // 20, t, c, at) for k, t, c, at in made(120, 5)]
    schema = "id long, batch_no int, title_ko string, city string, posted_at_utc timestamp"
    staging = spark.createDataFrame(new, schema).withColumn("state_or_province", F.lit(None).cast("string"))
    listings = spark.createDataFrame([(k, 1, t, c, None, at.strftime("%Y-%m-%dT%H:%M:%SZ")) for k, t, c, at in old], "id long, source_id int, title_ko string, city string, state_or_province string, posted_at_utc string")
    whole = [r[0] for r in rows(H.repeated(listings, staging, sources, places, rates))]
    h = H.History(spark, places, rates)
    h.add(h.dated(listings, sources), check=False)
    steps = [r[0] for b in range(6) for r in rows(h.add(H.staged(staging.where(F.col("batch_no") == b))))]
    assert sorted(steps) == sorted(whole) == brute(old, new)
    # a batch of one late week reads the folders of that week and the two beside it
    late = spark.createDataFrame([(9001, 12, new[0][2], "하버뷰", datetime.datetime(2025, 12, 2))], schema).withColumn("state_or_province", F.lit(None).cast("string"))
    every = len(h.pivots.table().inputFiles())
    week = H.pivoted(h.offers(H.staged(late))).first().week
    read = h.pivots.table([week - 1, week, week + 1])
    assert read.select("week").distinct().count() <= 3 and every > len({r.week for r in read.select("week").collect()})
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "week" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_names_once_given_stay(spark, small):
    # four rows of another name two edits away come later: the rows stored before keep their name
    places, rates, sources = small
    at = datetime.datetime(2025, 12, 1)
    schema = "id long, batch_no int, title_ko string, city string, posted_at_utc timestamp"
    batch = lambda b, names: spark.createDataFrame([(100 * b + k, b, f"{n} 1단지 2b1b $1500", "하버뷰", at) for k, n in enumerate(names)], schema).withColumn("state_or_province", F.lit(None).cast("string"))
    h = H.History(spark, places, rates)
    assert rows(h.add(H.staged(batch(1, ["은하코트"])))) == []
    assert rows(h.add(H.staged(batch(2, ["은하코브"] * 4)))) == [(201,), (202,), (203,)]
    assert rows(h.add(H.staged(batch(3, ["은하코트", "은하코브"])))) == [(300,), (301,)]


def test_the_metric_is_a_metric_and_pivots_bound_it(spark):
    rng = random.Random(9)
    data = [(k, rng.choice(["한빛파크", "한빛코브", "은하", "달빛맨션"]), rng.randrange(5), rng.randrange(3), 10 * rng.randrange(1, 3), rng.choice([150000, 160000]), rng.randrange(3), 1_700_000_000 + rng.randrange(10 * 86400)) for k in range(40)]
    df = H.pivoted(spark.createDataFrame(data, "id long, name string, number int, beds int, baths int, rent long, place long, epoch long"))
    a, b = (df.select(*[F.col(c).alias(f"{p}{c}") for c in df.columns]) for p in ("a_", "b_"))
    for r in a.crossJoin(b).withColumn("d", H.distance("a_", "b_")).collect():
        assert (r.d == 0) == (data[r.a_id][1:] == data[r.b_id][1:])
        assert all(H.WEIGHT * abs(r[f"a_{c}"] - r[f"b_{c}"]) <= r.d + 1e-9 for c in H.DISTANCES)


def test_a_hot_building_takes_no_rows_of_its_neighbours(spark, small):
    # a third of the rows and more is one building; a real one lies two edits away, others of few and of many rows one edit
    places, rates, sources = small
    at = datetime.datetime(2025, 12, 1)
    hot = [("한빛파크", k % 4 + 1, 1500 + k % 400) for k in range(800)]
    real = [(name, k % 4 + 1, rent + k) for name, n, rent in [("한빛코브", 60, 1500), ("한빛마크", 10, 4000), ("한빛포크", 20, 5000)] for k in range(n)]
    slips = [("한빛크파", 1, 1500), ("한빛팍", 2, 9999)]
    old = [(k, 1, f"{name} {number}단지 2b1b ${rent}", "하버뷰", None, at.strftime("%Y-%m-%dT%H:%M:%SZ")) for k, (name, number, rent) in enumerate(hot)]
    new = [(1000 + k, 0, f"{name} {number}단지 2b1b ${rent}", "하버뷰", at) for k, (name, number, rent) in enumerate(real + slips)]
    listings = spark.createDataFrame(old, "id long, source_id int, title_ko string, city string, state_or_province string, posted_at_utc string")
    staging = spark.createDataFrame(new, "id long, batch_no int, title_ko string, city string, posted_at_utc timestamp").withColumn("state_or_province", F.lit(None).cast("string"))
    assert rows(H.repeated(listings, staging, sources, places, rates)) == [(1000 + len(real),)]


def test_plans_of_the_history_stay_small(spark, small, monkeypatch):
    # the driver holds the plan of a write again at each of its stages; those of places read 9 tables, twice a run
    places, rates, sources = small
    read, write = [], H.materialize
    monkeypatch.setattr(H, "materialize", lambda df, what: read.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size()) or write(df, what))
    schema = "id long, source_id int, title_ko string, city string, state_or_province string, posted_at_utc string"
    listings = spark.createDataFrame([(k, 1, t, c, None, at.strftime("%Y-%m-%dT%H:%M:%SZ")) for k, t, c, at in made(20, 1)], schema)
    staging = spark.createDataFrame([(k, 0, t, c, None, at) for k, t, c, at in made(20, 2)], "id long, batch_no int, title_ko string, city string, state_or_province string, posted_at_utc timestamp")
    H.repeated(listings, staging, sources, places, rates)
    assert max(read) <= 7
