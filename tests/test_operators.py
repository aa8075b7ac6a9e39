import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ondol.functions.similarity import token_set
from ondol.operators import boards, fuzzy, relational, tables, validate
from ondol.sources import cache, history, pages, registry
from ondol.streaming import seen


def test_insert_ignore_takes_the_first_and_treats_nulls_as_equal(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "h")], "id long, url string, hash string")
    new = spark.createDataFrame([(3, "a", None), (5, "c", "x"), (4, "c", "x"), (6, None, None)], "id long, url string, hash string")
    assert rows(tables.insert_ignore(old, new, ["url", "hash"], "id")) == [(4, "c", "x"), (6, None, None)]
    assert tables.insert_ignore(old, new.limit(0), ["url"], "id").count() == 0


def test_upsert_keeps_and_overwrites(spark):
    old = spark.createDataFrame([(1, "k1", "u1", "t1"), (2, "k2", "u2", "t2")], "id long, k string, url string, title string")
    new = spark.createDataFrame([(9, "k1", "x", None), (10, "k3", "u3", "t3")], "id long, k string, url string, title string")
    assert rows(tables.upsert(old, new, ["k"], ["id", "url"])) == [(1, "k1", "u1", None), (10, "k3", "u3", "t3"), (2, "k2", "u2", "t2")]


def test_snapshot_table_moves_its_pointer(spark, tmp_path):
    t = tables.SnapshotTable(spark, f"file://{tmp_path}/t")
    t.write(spark.range(3))
    t.write(tables.delete_where(tables.update_where(t.read(), F.col("id") == 1, {"id": F.lit(7).cast("long")}), F.col("id") == 0))
    assert t.version() == 2 and rows(t.read()) == [(2,), (7,)]


def test_window_pairs_against_brute_force(spark):
    rng = random.Random(3)
    data = [(k, rng.choice("ab"), datetime.date(2024, 1, 1) + datetime.timedelta(days=rng.randrange(60))) for k in range(120)]
    got = rows(relational.window_pairs(spark.createDataFrame(data, "id long, g string, day date"), ["g"], "day", "id", 7, []), "a_id", "b_id")
    want = sorted(((x[0], y[0]) for x in data for y in data if x[0] < y[0] and x[1] == y[1] and abs((x[2] - y[2]).days) <= 7), key=str)
    assert got == want
    sliced = relational.window_pairs(spark.createDataFrame(data, "id long, g string, day date"), ["g"], "day", "id", 7, [], 3)
    assert rows(sliced, "a_id", "b_id") == want and "_x" not in sliced.columns


def greedy(data, days=7, threshold=0.9):
    """The plain pass over a block in input order."""
    out = {}
    for block in {(r[3] or "").lower() for r in data}:
        left = [r for r in data if (r[3] or "").lower() == block]
        done = set()
        for i in left:
            if i[0] in done:
                continue
            done.add(i[0])
            group = [i]
            for j in left:
                if j[0] not in done and i[2] and j[2] and abs((i[2].date() - j[2].date()).days) <= days and token_set(i[1], j[1]) >= threshold:
                    done.add(j[0])
                    group.append(j)
            best = min(group, key=lambda r: (r[2] is None, r[2], r[0])) if len(group) > 1 else None
            for r in group:
                out[r[0]] = (best is not None and r[0] != best[0], best[0] if best is not None and r[0] != best[0] else None)
    return out


def test_fuzzy_leaders_equal_the_greedy_pass(spark):
    rng = random.Random(5)
    words = ["아파트", "2룸", "역세권", "신축", "급매", "1500", "1600", "주차"]
    data = [(k, " ".join(rng.sample(words, rng.randrange(2, 5))), None if rng.random() < 0.1 else datetime.datetime(2024, 1, 1, 5) + datetime.timedelta(days=rng.randrange(30)), rng.choice(["La", "la", None, ""])) for k in range(80)]
    df = spark.createDataFrame(data, "id long, t string, at timestamp, city string")
    got = {r.id: (r.is_duplicate, r.canonical_id) for r in fuzzy.find_duplicates(df, F.col("id"), F.col("at"), F.col("city"), F.col("t")).collect()}
    assert got == greedy(data)
    assert fuzzy.find_duplicates(df.limit(0), F.col("id"), F.col("at"), F.col("city"), F.col("t")).count() == 0


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "source_id int, city string")
    out = {r.check: r.passed for r in validate.report(validate.null_rate(df, ["city"]), validate.orphans(df, spark.createDataFrame([(1,)], "source_id int"), ["source_id"]), validate.null_rate(df.limit(0), ["city"]).withColumn("check", F.lit("empty"))).collect()}
    assert out == {"null_rate": False, "fk_integrity": False, "empty": True}


DETAIL = "<html><title>t - Board</title><article><h1>[LA] 방 2개</h1><span>등록일</span> <span>2024-06-01</span><section><p>위치: 다운타운</p><p>연락처: 213-555-1234</p></section></article><table><tr><td>가격</td><td>$1,200</td></tr></table>"


def test_detail_pages_and_rejects(spark):
    df = spark.createDataFrame([("http://x/r/77?page=2", DETAIL, "default"), ("http://x/r/8", None, "default"), ("u", "<p>", "none")], "url string, html_content string, board string")
    a, b, c = boards.parse_details(df).collect()
    assert (a.title_ko, a.raw_price, a.raw_location, a.raw_posted_at, a.contact_block, a.source_listing_id, a.error) == ("[LA] 방 2개", "$1,200", "다운타운", "2024-06-01", "213-555-1234", "77", None)
    assert b.title_ko == "" and b.error is None and "KeyError" in c.error


def test_list_pages(spark):
    html = "<ul><li><a href='/r/1?page=2'>[OC] a</a><span class=date>05.18</span><li><a href='/r/1'></a><li><a href='http://x/r/2'>b</a></ul>"
    df = spark.createDataFrame([("http://x/list?page=1", html), ("http://x/l", None)], "url string, html_content string")
    assert rows(boards.parse_lists(df)) == [("http://x/r/1", "1", "[OC] a", "OC", "05.18"), ("http://x/r/2", "2", "b", "", "")]


def test_page_source(spark, tmp_path):
    (tmp_path / "a_1.html").write_text("<p>hi</p>", encoding="utf-8")
    pages.register(spark)
    df = spark.read.format("pages").option("root", str(tmp_path)).option("urls", "http://x/a/1\nhttp://x/b").load()
    assert rows(df, "url", "http_status") == [("http://x/a/1", 200), ("http://x/b", 404)]
    banned = spark.createDataFrame([(403, None), (200, "Checking YOUR browser before accessing"), (200, "ok"), (None, None)], "s int, h string")
    assert [r[0] for r in banned.select(pages.banned(F.col("s"), F.col("h"))).collect()] == [True, True, False, False]


def test_registry(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"sources": [{"name": "a", "base_url": "http://a"}, {"name": "b", "base_url": "http://b", "status": "disabled"}]}))
    assert [r.name for r in registry.active(registry.load(spark, str(path))).collect()] == ["a"]
    path.write_text(json.dumps({"sources": [{"name": "a", "base_url": "x", "fetcher_type": "?"}]}))
    with pytest.raises(ValueError):
        registry.load(spark, str(path))


def test_cache_expires_and_looks_up_misses_once(spark):
    at = datetime.datetime(2024, 6, 1)
    now = F.lit(datetime.datetime(2024, 6, 20)).cast("timestamp")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "")], "id long, t string")
    old = spark.createDataFrame([("a", "1,2", at), ("b", "3,4", datetime.datetime(2024, 1, 1))], "t string, value string, cached_at timestamp").select(cache.cache_key(F.col("t")).alias("key"), "value", "cached_at")
    out, new = cache.resolve(df, F.col("t"), old, now, lambda t: "5,6" if t == "b" else None)
    assert {r.id: (r.point.lat, r.point.lon) if r.point else None for r in out.collect()} == {1: (1.0, 2.0), 2: (5.0, 6.0), 3: (5.0, 6.0), 4: None}
    assert new.count() == 1


def test_history_lines(spark, tmp_path):
    df = spark.createDataFrame([("d", "r1", "success", datetime.datetime(2024, 1, 1), None, None, None)], history.SCHEMA)
    history.append(df, str(tmp_path / "h"))
    assert history.last(history.read(spark, str(tmp_path / "h"))).first().run_id == "r1"


def test_streams_equal_their_batches(spark, tmp_path):
    data = [(k, f"u{k % 7}", "s" if k % 3 else None, datetime.datetime(2024, 1, 1) + datetime.timedelta(days=k)) for k in range(30)]
    df = spark.createDataFrame(data, "id long, url string, source string, ts timestamp")
    df.repartition(3).write.parquet(f"{tmp_path}/x.parquet")
    s = lambda: seen.read_table(spark, str(tmp_path), "x", 1)
    assert rows(seen.run(seen.first_sightings(s(), ["source", "url"]), "t")) == rows(df.select("source", "url").distinct())
    assert rows(seen.mark_after_sink(s(), "source", "url", "ts", seen.SeenSet(spark, ttl=10**9))) == rows(df.where("source is not null").select("source", "url").distinct())
    late = seen.run(seen.admitted(s(), F.to_date("ts"), F.lit("2024-01-30").cast("date"), 5).select("id"), "t")
    assert rows(late) == rows(df.where("ts >= '2024-01-25'").select("id"))
