import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ondol.functions import classify, contact, dates, dom, location, price, similarity, text, urls


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("value, want", [("[LA] 방", "LA"), ("  [ 어바인 ] x", "어바인"), ("방 [LA]", ""), ("", ""), (None, "")])
def test_bracket(spark, value, want):
    assert one(spark, value, text.title_bracket) == want


@pytest.mark.parametrize("value, want", [("\n  \r\n a \nb", "a"), ("", ""), (None, ""), ("x\x0by", "x")])
def test_first_line(spark, value, want):
    assert one(spark, value, text.first_line) == want


def test_labelled_field(spark):
    f = lambda c: text.labelled_field(c, ["지역", "위치"])
    assert one(spark, "a\n위치： LA \n지역: NY", f) == "LA"
    assert one(spark, "지역:\n위치: X", f) == ""
    assert one(spark, None, f) == ""


def test_infer_location(spark):
    df = spark.createDataFrame([("[LA] x", "한인타운\nb", ""), ("[LA] x", "LA 타운", None), ("x", "", ""), ("[LA]", "", ""), ("t", "b", "NY")], "t string, b string, l string")
    assert [r[0] for r in df.select(text.infer_location(F.col("t"), F.col("b"), F.col("l"))).collect()] == ["LA 한인타운", "LA 타운", "", "LA", "NY"]


@pytest.mark.parametrize("value, want", [("http://a/b?page=2&x=1#top", "http://a/b?x=1#top"), ("http://a/b?page=2", "http://a/b"), ("http://a/b", "http://a/b"), (None, None)])
def test_without_parameter(spark, value, want):
    assert one(spark, value, lambda c: urls.without_parameter(c, "page")) == want


@pytest.mark.parametrize("value, want", [("http://a/b", "http://a/b?page=3"), ("http://a/b?page=1&x=2#f", "http://a/b?page=3&x=2#f"), ("http://a/b?x=1&x=2&y=", "http://a/b?x=2&page=3")])
def test_page_url(spark, value, want):
    assert one(spark, value, lambda c: urls.page_url(c, F.lit(3))) == want


@pytest.mark.parametrize("value, phone, messenger, email", [("전화 213-555-1234", "213-555-1234", None, None), ("(213) 555-1234 카카오: abc_1", "(213) 555-1234", "abc_1", None), ("010-1234-5678", None, None, None), ("a.b@c.example.org 카톡 x9", None, "x9", "a.b@c.example.org"), (None, None, None, None), ("", None, None, None)])
def test_contact(spark, value, phone, messenger, email):
    assert (one(spark, value, contact.phone), one(spark, value, contact.messenger), one(spark, value, contact.email)) == (phone, messenger, email)


@pytest.mark.parametrize("value, want", [("아파트 월세", "apartment"), ("콘도 주차", "condo"), ("Office space", "commercial_space"), ("룸메이트 방", "roommate_wanted"), ("", "other"), (None, "other")])
def test_category(spark, value, want):
    assert one(spark, value, classify.category) == want


@pytest.mark.parametrize("value, rent, deposit, lease, currency", [("월세 $1,500 / 보증금 $3,000", 1500, 3000, "monthly", "USD"), ("전세 $2,500", None, 2500, "jeonse", "USD"), ("월 1,000,000원", 750, None, "monthly", "KRW"), ("협의", None, None, "monthly", "USD"), ("", None, None, None, None), (None, None, None, None, None)])
def test_price(spark, value, rent, deposit, lease, currency):
    r = spark.createDataFrame([(value,)], "x string").select(*[v.alias(k) for k, v in price.normalized(F.col("x")).items()]).first()
    assert (r.rent_usd, r.deposit_usd, r.lease_type, r.currency_raw) == (rent, deposit, lease, currency)


TODAY = datetime.date(2024, 6, 15)


@pytest.mark.parametrize("value, want", [("오늘", TODAY), ("어제", datetime.date(2024, 6, 14)), ("2024년 5월 1일", datetime.date(2024, 5, 1)), ("2024-05-01T10:00", datetime.date(2024, 5, 1)), ("12-25", datetime.date(2024, 12, 25)), ("2/1/2024", datetime.date(2024, 2, 1)), ("2024-02-30", None), ("x", None), (None, None)])
def test_posted_date(spark, value, want):
    assert one(spark, value, lambda c: dates.posted_date(c, F.lit(TODAY))) == want


@pytest.mark.parametrize("value, want", [("2024. 5. 1", datetime.date(2024, 5, 1)), ("05.20.26", datetime.date(2026, 5, 20)), ("05. 18", datetime.date(2024, 5, 18)), ("12/25", datetime.date(2023, 12, 25)), ("12월 3일", datetime.date(2023, 12, 3)), ("16:53", TODAY), ("3일 전", datetime.date(2024, 6, 12)), ("2시간 전", TODAY), ("어제", datetime.date(2024, 6, 14)), ("", None), (None, None)])
def test_list_date(spark, value, want):
    assert one(spark, value, lambda c: dates.list_date(c, F.lit(TODAY))) == want


@pytest.mark.parametrize("value, want", [("Irvine, CA", ("Irvine", "CA", "US")), ("서울 마포구", ("서울", None, "KR")), ("Sunnyvale", ("Sunnyvale", "NY", "US")), ("x" * 60, ("x" * 50 + "...", None, "US")), ("", (None, None, None)), (None, (None, None, None))])
def test_location(spark, value, want):
    r = spark.createDataFrame([(value,)], "x string").select(*[v.alias(k) for k, v in location.normalized(F.col("x")).items()]).first()
    assert tuple(r) == want


@given(st.text(alphabet="abc가 ", max_size=12), st.text(alphabet="abc가 ", max_size=12))
@settings(max_examples=200, deadline=None)
def test_lcs_against_the_table(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    assert similarity.lcs(a, b) == t[-1][-1]


def test_token_set():
    assert similarity.token_set("아파트 2룸 1500", "2룸 아파트 1500 급") == 1.0
    assert similarity.token_set("", "a") == 0.0
    assert 0 < similarity.token_set("abc d", "abc e") < 1


def test_dom():
    root = dom.parse("<div id=a class='x y'><p>one<p>two<br>three</div><ul><li><a href='/r?id=1'>t</a><li class=notice>n</ul>")
    assert [e.text() for e in root.select("#a > p")] == ["one", "twothree"]
    assert root.first("li:not(.notice) a[href*='id=']").attrs["href"] == "/r?id=1"
    assert root.first(".x.y p").text() == "one" and root.first("table") is None
