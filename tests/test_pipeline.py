import datetime
import json
import sys

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ondol import cli, workflow
from ondol.functions import dates, price
from ondol.operators import audit, boards, fuzzy, load, pipeline, relational, validate
from ondol.schemas import TABLES, ensure_tables
from ondol.sources import cache
from ondol.streaming import seen

LABELS = "<p>위치: {p}</p><p>월세: $800 (인터넷)</p><p>보증금: $800</p><p>작성일: 2024-05-01</p><p>연락처: 404-555-1111</p>"
PAGES = {  # board -> (url, page, what it gives)
    "meta_table": ("http://x/rent_housing/12345", "<h1 id=bo_v_title>[LA] 방 2개</h1><article id=bo_v_atc><time datetime='2024-05-01T10:00:00+09:00'>x</time><table><tr><td><span>가격</span></td><td><span class=na-bar></span> 월세 $1,500 / 보증금 $3,000</td></tr><tr><td>지역/위치</td><td>LA 다운타운</td></tr><tr><td>전화</td><td>213-555-1234</td></tr><tr><td>이메일</td><td>a@b.example</td></tr></table><div id=bo_v_con>첫 줄<br>둘째<table><tr><td>no</td></tr></table></div></article>", ("[LA] 방 2개", "첫 줄\n둘째", "월세 $1,500 / 보증금 $3,000", "LA 다운타운", "2024-05-01T10:00:00+09:00", "전화: 213-555-1234\n이메일: a@b.example", "12345")),
    "labelled_lines": ("http://x/b?bo=1&wr_id=1001", "<title>[둘루스] 방 > 렌트 | Board</title><div id=bo_v_atc><div id=bo_v_con>" + LABELS.format(p="") + "</div></div>", ("[둘루스] 방", "위치:\n월세: $800 (인터넷)\n보증금: $800\n작성일: 2024-05-01\n연락처: 404-555-1111", "$800 (인터넷)\n$800", "둘루스 위치:", "2024-05-01", "404-555-1111", "1001")),
    "read_content": ("http://x/board_read.asp?idx=m2001&p=1", "<div id=readcontent><h2>스튜디오 | Site</h2>" + LABELS.format(p="뉴욕") + "</div>", ("스튜디오", "위치: 뉴욕\n월세: $800 (인터넷)\n보증금: $800\n작성일: 2024-05-01\n연락처: 404-555-1111", "$800 (인터넷)\n$800", "뉴욕", "2024-05-01", "404-555-1111", "m2001")),
    "portal": ("http://x/v?wr_id=77", "<div class=realestate_over><h1>콘도</h1><div><p>OC 풀러턴</p><p>월세: $1</p></div></div>", ("콘도", "OC 풀러턴월세: $1", "", "OC 풀러턴월세: $1", "", "", "77")),
    "content_view": ("http://x/?mod=document&uid=13972", "<div class=kboard-title><h1>[어바나] 서브렛</h1></div><div class='detail-attr detail-date'>작성일: 2026-05-01</div><div class=kboard-content><div class=content-view>" + LABELS.format(p="어바나") + "</div></div>", ("[어바나] 서브렛", "위치: 어바나\n월세: $800 (인터넷)\n보증금: $800\n작성일: 2024-05-01\n연락처: 404-555-1111", "$800 (인터넷)\n$800", "어바나", "2026-05-01", "404-555-1111", "13972")),
    "value_ids": ("http://x/ad_rent/rentview?data=k3001#top", "".join(f"<span id=MainContent_lbl_{k}>{v}</span>" for k, v in {"title": "렌트", "pay": "", "pay2": "$1,500", "city": "Los Angeles", "state": "CA", "boardregdate": "02/01/2024", "joblist": "아파트", "bedroom": "2", "bathroom": "0", "sq": "0 sq ft", "telnum": "213-555-3001", "writer": "kim"}.items()), ("렌트", "렌트\n형태: 아파트\nBedrooms: 2", "$1,500", "Los Angeles, CA", "02/01/2024", "전화: 213-555-3001\n작성자: kim", "k3001")),
}


@pytest.mark.parametrize("board", PAGES)
def test_detail_layouts(board):
    url, html, want = PAGES[board]
    got = boards.detail(html, url, boards.REGISTRY[board])
    assert tuple(got[k] for k in ("title_ko", "body_ko", "raw_price", "raw_location", "raw_posted_at", "contact_block", "source_listing_id")) == want


LISTS = {
    "meta_table": ("<ul><li class='d-md-table-row'><a class=na-subject href='/rent_housing/1631?page=2'>[LA] a</a><span class=list_etc>등록일 16:53</span></li><li class=other><a class=na-subject href='/rent_housing/9'>n</a></li></ul>", [("http://x/rent_housing/1631", "1631", "[LA] a", "LA", "16:53")]),
    "labelled_lines": ("<div class=bo_tit><a href='http://x/b?wr_id=87660&page=1'>t</a><span class=bo_dt>05.19</span></div><div class=bo_tit><a href='/none'>u</a></div>", [("http://x/b?wr_id=87660", "87660", "t", "", "05.19")]),
    "read_content": ("<a href='/board_read.asp?idx=8'><img></a><a href='/board_read.asp?idx=8'>방</a><a href='/board_read.asp?idx=9'></a><table class=board_list><tbody><tr><td>1</td><td><a href='/board_read.asp?idx=8'>방</a></td><td>05/19</td></tr></tbody></table>", [("http://x/board_read.asp?idx=8", "8", "방", "", "05/19")]),
    "portal": ("<ul class=board_list><li class=notice><a class=thumb href='/v?wr_id=1'>n</a></li><li><a class=thumb href='/v?page=2&wr_id=4862'></a><div class=subject><h3>[OC] r</h3></div><span class=date>05.20.26</span></li></ul>", [("http://x/v?wr_id=4862", "4862", "[OC] r", "OC", "05.20.26")]),
    "content_view": ("<table><tbody><tr class=kboard-list-notice><td class=kboard-list-title><a href='/?mod=document&uid=1'>n</a></td></tr><tr><td class=kboard-list-title><a href='/?mod=document&pageid=3&uid=13972'>s</a></td><td class=kboard-list-date>2026.05.01</td></tr></tbody></table>", [("http://x/?mod=document&uid=13972", "13972", "s", "", "2026.05.01")]),
    "value_ids": ("<table class=table_board_2><tbody><tr><td>1</td><td><a href='/ad_rent/rentview?data=68531'></a></td><td>c</td><td>d</td><td>05/19</td></tr></tbody></table>", [("http://x/ad_rent/rentview?data=68531", "68531", "Listing 68531", "", "05/19")]),
}


@pytest.mark.parametrize("board", LISTS)
def test_list_layouts(board):
    html, want = LISTS[board]
    assert list(boards.list_rows(html, "http://x", boards.REGISTRY[board])) == want


NOW = datetime.datetime(2026, 6, 1, 12)


def lit(t):
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def test_transform_gives_rows_and_rejects(spark):
    data = [(1, u, h, f"h{k}", b) for k, (b, (u, h, _)) in enumerate(PAGES.items())] + [(1, "http://x/r/1", "<p></p>", "e", "portal"), (1, "http://x/r/2", None, "n", "portal"), (1, "u", "<p>x</p>", "q", "nowhere")]
    good, bad = pipeline.transform(spark.createDataFrame(data, "source_id int, url string, html_content string, content_hash string, board string"), lit(NOW))
    assert good.columns == list(pipeline.STAGING) and len(good.columns) == 31
    got = {r.source_listing_id: r for r in good.collect()}
    one = got["12345"]
    assert (float(one.rent_monthly_usd), float(one.deposit_usd), one.city, one.phone, one.email, one.posted_at_utc) == (1500.0, 3000.0, "La", "213-555-1234", "a@b.example", datetime.datetime(2024, 5, 1))
    assert one.errors == "{}" and one.geo_point is None and one.parsed_at == NOW
    assert sorted(r.error.split(":")[0] for r in bad.collect()) == ["KeyError", "no content", "no content"]


def test_posted_instants_and_separators(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(["오늘", "Yesterday", "방금 전", "2024-05-01", "2024년 2월 30일", "05-18", None])], "k int, t string")
    got = [r[0] for r in df.orderBy("k").select(dates.posted_at(F.col("t"), lit(NOW))).collect()]
    assert got == [NOW, NOW - datetime.timedelta(days=1), NOW, datetime.datetime(2024, 5, 1), None, datetime.datetime(2026, 5, 18), None]
    mixed = spark.createDataFrame([("2026-05.20",), ("2026. 05. 20",), ("05/18/25",), ("05/18.25",), ("5월 18일",)], "t string")
    assert [str(r[0]) for r in mixed.select(dates.list_date(F.col("t"), F.lit("2026-06-01").cast("date"))).collect()] == ["None", "2026-05-20", "2025-05-18", "None", "2026-05-18"]


def test_prices_read_digits_and_commas_only(spark):
    p = price.normalized(F.col("t"))
    df = spark.createDataFrame([("$1,500.50",), ("₩1,000,000원",), ("전세 $2,500",)], "t string")
    assert [(float(r[0]) if r[0] is not None else None, float(r[1]) if r[1] is not None else None) for r in df.select(p["rent_usd"], p["deposit_usd"]).collect()] == [(1500.0, None), (750.0, 750.0), (None, 2500.0)]


def test_blank_texts_and_repeated_words_in_the_fuzzy_pass(spark):
    at = datetime.datetime(2024, 1, 1)
    data = [(1, ""), (2, " "), (3, None), (4, "abcdefghi abcdefghi"), (5, "abcdefghij"), (6, "　")]
    df = spark.createDataFrame([(k, t, at, "La") for k, t in data], "id long, t string, at timestamp, city string")
    got = {r.id: (r.is_duplicate, r.canonical_id) for r in fuzzy.find_duplicates(df, F.col("id"), F.col("at"), F.col("city"), F.col("t")).collect()}
    assert got == {1: (False, None), 2: (False, None), 3: (False, None), 6: (False, None), 4: (False, None), 5: (True, 4)}


def test_numbered_equals_a_window(spark):
    data = [(k, k % 3 if k % 7 else None, k * 37 % 11 if k % 5 else None, k % 4) for k in range(200)]
    df = spark.createDataFrame(data, "id long, g int, c int, x int")
    got = {r.id: r.number for r in relational.numbered(df, ["g"], F.col("c"), F.col("x"), F.col("id")).collect()}
    want = {}
    for g in {r[1] for r in data}:
        for n, r in enumerate(sorted((r for r in data if r[1] == g), key=lambda r: (r[2] is None, -(r[2] or 0), r[3], r[0])), 1):
            want[r[0]] = n
    assert got == want


def test_audit_events(spark):
    events = audit.start(spark, 1, NOW, task_id="load", run_id="r", source_name="s").unionByName(audit.increment(spark, 1, NOW, rows_loaded=2)).unionByName(audit.increment(spark, 1, NOW, rows_loaded=3))
    open_ = audit.runs(events).first()
    assert (open_.status, open_.rows_loaded, open_.duration_sec, open_.source_name) == ("running", 5, None, "s")
    done = audit.runs(events.unionByName(audit.finish(spark, 1, NOW + datetime.timedelta(seconds=90), rows_failed=1))).first()
    assert (done.status, done.rows_loaded, done.rows_failed, done.duration_sec) == ("success", 0, 1, 90)
    view = audit.runs(events.unionByName(audit.start(spark, 2, NOW, run_id="r", task_id="load", source_name=None)))
    assert [r.id for r in audit.last(view, 1).collect()] == [2] and [r.id for r in audit.last(view, 5, "s").collect()] == [1]
    assert audit.resolve(view, "1").first().id == 1 and audit.resolve(view, "r", "load").first().id == 2 and audit.resolve(view, "x").count() == 0


def staged(spark, data):
    return spark.createDataFrame(data, "id long, source_id int, source_listing_id string, url string, city string, rent_monthly_usd double, title_ko string, currency_raw string")


def test_load_refuses_rows_one_by_one_and_is_idempotent(spark):
    sources = spark.createDataFrame([(1,)], "id int")
    old = spark.createDataFrame([(7, 1, "a", "old", "X", 1.0, "t", "USD", False, NOW, NOW)], "id long, source_id int, source_listing_id string, url string, city string, rent_monthly_usd double, title_ko string, currency_raw string, is_active boolean, last_seen_at timestamp, first_seen_at timestamp")
    rows_ = staged(spark, [(1, 1, "a", "new", "Y", 2.0, None, "KRW"), (2, 1, "b", "u", "Z", None, "t2", "USD"), (3, 99, "c", "u", "Z", 1.0, "t", "USD"), (4, 1, "d", "u", "Z" * 101, 1.0, "t", "USD"), (5, 1, "e", "u", "Z", 1e8, "t", "USD"), (6, 1, None, "u", "Z", 1.0, "t", "USD")])
    later = lit(NOW + datetime.timedelta(days=1))
    merged, refused, ids = load.load(old, rows_, sources, later)
    assert rows(refused, "id", "reason") == [(3, "source"), (4, "length:city"), (5, "overflow:rent_monthly_usd"), (6, "null:source_listing_id")]
    assert rows(ids) == [(1,), (2,)]
    assert rows(merged, "id", "url", "city", "title_ko", "currency_raw", "is_active", "first_seen_at") == [(2, "u", "Z", "t2", "USD", True, NOW + datetime.timedelta(days=1)), (7, "old", "Y", None, "USD", True, NOW)]
    again = load.load(merged, rows_, sources, later)[0]
    assert rows(again) == rows(merged)
    assert load.load(old.limit(0), rows_.limit(0), sources, later)[0].count() == 0


def test_seen_sets_die_whole(spark):
    s = seen.SeenSet(spark, ttl=10)
    df = lambda *x: spark.createDataFrame(list(x), "source string, url string")
    assert rows(s.mark(df(("a", "1"), ("a", "1"), ("b", "1"), (None, "x"), ("a", None)), 100)) == [("a", "1"), ("b", "1")]
    assert rows(s.mark(df(("a", "1"), ("a", "2")), 109)) == [("a", "2")]
    # a was renewed at 109 and lives, b died at 110
    assert rows(s.mark(df(("a", "1"), ("b", "1")), 115)) == [("b", "1")]
    assert rows(s.count(116)) == [("a", 2), ("b", 1)]
    s.clear("a", 116)
    assert rows(s.current(116)) == [("b", "1")] and rows(s.unseen(df(("a", "1"), ("b", "1")), 116)) == [("a", "1")]


def test_validation_raises_on_hard_failures(spark):
    checks = spark.createDataFrame([("parsed_rows", False, False, 0.25), ("null_rate", True, True, 0.1), ("fk_integrity", True, True, None)], "check string, passed boolean, hard boolean, value double")
    report = validate.run(checks, 5)
    assert report["soft_warning"] and report["checks"][0]["message"] == "rows are 25% of the average of earlier runs" and report["checks"][1]["message"].startswith("10.00%")
    with pytest.raises(validate.ValidationError, match="null_rate"):
        validate.run(checks.withColumn("passed", F.lit(False)))


def test_lookups_keep_their_distance(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "t string")
    _, new = cache.resolve(df, F.col("t"), spark.createDataFrame([], cache.CACHE), lit(NOW), lambda t: "1,2", interval=0.01)
    assert new.count() == 3 and new.rdd.getNumPartitions() == 1


def test_runner(tmp_path):
    ok, bad = workflow.Task("ok", (sys.executable, "-c", "print(1)")), workflow.Task("bad", (sys.executable, "-c", "raise SystemExit(3)"))
    told, slept = [], []
    r = workflow.Runner(tmp_path, lambda *x: told.append(x), slept.append)
    assert r.run(workflow.Workflow("w", (ok, bad, ok), retries=2, retry_delay=7)) == 3
    assert [a["exit_code"] for a in r.attempts] == [0, 3, 3, 3] and slept == [7, 7] and len(told) == 1
    assert r.run(workflow.Workflow("w", (workflow.Task("slow", (sys.executable, "-c", "import time; time.sleep(60)")),), retries=0, task_limit=0.3)) == workflow.TIMED_OUT
    h = workflow.History(tmp_path / "history.jsonl")
    assert [x["status"] for x in h.last(3)] == ["failed", "running", "failed"] and h.status("w")["status"] == "failed" and h.status("none") is None
    assert workflow.mail("s", "t") is False


def test_command_line_end_to_end(spark, tmp_path, capsys):
    root = f"file://{tmp_path}/t"
    t = ensure_tables(spark, root)
    assert set(ensure_tables(spark, root)) == set(TABLES) and t["sources"].version() == 1
    t["sources"].write(spark.createDataFrame([(1, "meta_table"), (2, "portal")], "id int, name string").select(*[F.col(c.name) if c.name in ("id", "name") else F.lit(None).cast(c.dataType).alias(c.name) for c in t["sources"].read().schema]))
    url, html, _ = PAGES["meta_table"]
    pages = [(1, 1, url, html, "a", 200, None, NOW), (2, 1, url.replace("12345", "12346"), html, "b", 200, None, NOW), (3, 2, "http://x/v?wr_id=1", None, "c", 200, None, NOW)]
    t["scraped_pages"].write(spark.createDataFrame(pages, TABLES["scraped_pages"]))
    run = lambda *x: cli.main(["--root", root, "--now", "2026-06-01T12:00:00", *x], spark)
    assert run("sources", "list") == 0 and run("sources", "check") == 0
    assert run("run-all") == 0
    said = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith('{"task"')]
    assert [(x["task"], x["status"]) for x in said] == [("transform", "success"), ("load", "success")] and said[0]["rows_transformed"] == 2 and said[0]["rows_failed"] == 1 and said[1]["rows_loaded"] == 2
    assert rows(t["listings_staging"].read(), "id", "is_duplicate", "canonical_id") == [(1, False, None), (2, True, 1)]
    assert run("transform") == 0 and t["listings_staging"].read().count() == 2
    assert run("cleanup", "purge-pages", "--days", "0") == 0 and t["listings"].read().count() == 2
    assert cli.main(["workflow", "list"]) == 0 and cli.main(["transform"]) == 2
