import itertools
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ondol.llm import personal as P

KOREAN = [f + a + b for f in "김박최이강정" for a in "가나다마" for b in "온래솔람결"]
KOREAN += [f + a + b for f in ("남궁", "선우", "제갈") for a in "가나다" for b in "온래솔람"] + [f + b for f in "김박최" for b in "솔결람건설"]
LATIN = [f"{a} {b}" for a in ("Arden", "Elowen", "Kasper", "Minseo") for b in ("Parkhurst", "Gwonson", "Farlane", "Kimbrough", "Leeford")]
FRAMES = ["담당자는 {}입니다.", "집주인 {} 님께 연락 주세요.", "매니저 {} 드림", "문의는 {}씨에게", "Please ask for {}.", "저는 {}이고", "{} 213-555-0123", "Thanks, {}", "계약은 {} 이름으로", "조용한 동네 {}"]
SEEDS = [f.format(n) for k, n in enumerate(KOREAN + LATIN) for f in (FRAMES[k % 10], FRAMES[(k * 7 + 3) % 10], FRAMES[(k * 3 + 1) % 10])]
PLAIN = ["전기와 가스는 따로 내셔야 합니다.", "정류장이 도보 3분입니다.", "조용한 동네", "Harbor View Court near the park.", "전화 213-555-0123 로 주세요", "전화 2135550124", "이메일 a@b.example", "세탁기 있음", "담배 피우시는 분은 어렵습니다.", "이사 첫날 김치 냉장고를 봤습니다.", "주문번호 3334445555 입니다"] * 5
CASES = [
    ("전화 (213) 555-0123 로", [(3, "PHONE")]), ("급하시면 (268 555 0129) 여기로요.", [(6, "PHONE")]), ("급하시면 ((637) 555-0159)", [(6, "PHONE")]), ("+82 10-0855-9810", [(0, "PHONE")]), ("공일공-0754-7011번으로", [(0, "PHONE")]),
    ("메일 a.b1@c.example.org 로", [(3, "EMAIL")]), ("<moon5골뱅이inbox.example.net>", [(1, "EMAIL")]), ("lee (at) mail.example", [(0, "EMAIL")]), ("lee＠mail.example", [(0, "EMAIL")]),
    ("주민번호 871236-2362336 입니다", [(5, "ID_NUMBER")]), ("SSN 666-94-3051", [(4, "ID_NUMBER")]), ("여권번호 M33157874", [(5, "ID_NUMBER")]), ("주소는 12826 South Pumicemoor Bl 입니다.", [(4, "ADDRESS")]), ("방문 주소 해오름로 29길 65-4 (초인종)", [(6, "ADDRESS")]),
    ("담당자는 김다솔입니다.", [(5, "NAME")]), ("Thanks, Arden Gwonson", [(8, "NAME")]), ("방 좋음 박가람", [(5, "NAME")]), ("계약은 Arden Gwonson 이름으로.\n집주인 박다솔 님께", [(4, "NAME"), (28, "NAME")]), ("강마결 +1 691 555 0182", [(0, "NAME"), (4, "PHONE")]),
    ("카톡 아이디는 room452 입니다.", []), ("매물번호 963-62216 로 문의", []), ("우편번호는 41083", []), ("Willowgate Street near", []), ("은하 파크 36단지", []), ("전기와 가스는 정류장이 조용한", []), ("", []), (None, []),
]


EXTRA = [  # names of other lengths, a single given name, runs of digits that are no telephone number
    ("집주인 남궁가온 님께", [(4, "NAME")]), ("담당자는 김솔입니다.", [(5, "NAME")]), ("Please ask for Elowen.", [(15, "NAME")]), ("주문번호 3334445559 입니다", []), ("전화 2135550129", [(3, "PHONE")]),
]


@pytest.fixture(scope="module")
def found(spark):
    texts = CASES + EXTRA
    data = [(k, t, None) for k, (t, _) in enumerate(texts)] + [(1000 + k, None, t) for k, t in enumerate(SEEDS + PLAIN)]
    data += [(9000 + k, None, "주문번호 %d 입니다" % (3334446000 + k)) for k in range(40)] + [(None, "담당자는 김다솔입니다.", None), (None, "", None), (None, None, None)]
    df = spark.createDataFrame(data, "id long, title_ko string, body_ko string").withColumn("kind", F.lit("clash"))
    return df, P.materialize(P.find(df), "test")


def test_values_are_found_where_they_begin(spark, found):
    got: dict = {}
    for r in found[1].where("id < 1000").collect():
        got.setdefault(r.id, []).append((r.start_at, r.kind))
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, (_, v) in enumerate(CASES + EXTRA) if v}
    assert rows(found[1].where("id is null"), "field", "kind", "start_at", "end_at") == [("title_ko", "NAME", 5, 8)]


def test_recall_of_names_over_all_frames(found):
    got = {(r.id, r.start_at) for r in found[1].where("kind = 'NAME' and id >= 1000 and id < 9000").collect()}
    names = [n for n in KOREAN + LATIN for _ in range(3)]
    want = {(1000 + k, t.index(n)) for k, (t, n) in enumerate(zip(SEEDS, names))}
    assert len(want & got) >= 0.99 * len(want) and len(got - want) <= 0.01 * len(want)


def test_texts_stay_but_for_the_values(spark):
    long = "조용한 동네 " * 50_000
    data = [(1, "연락: a@b.example, 213-555-0123!\n끝 ０１", "x"), (2, None, "x"), (2, long + "a@b.example", None), (2, "", "전화 ２１３-555-0123"), (None, "없음", None), (1, "연락: a@b.example, 213-555-0123!\n끝 ０１", "x")]
    df = spark.createDataFrame(data, "id long, title_ko string, b string").toDF("id", "title_ko", "b.x").withColumns({"field": F.lit("f"), "_x": F.lit(1)})
    out = P.sanitised(df, ["title_ko", "b.x"])
    assert out.columns == df.columns
    want = [(1, "연락: [EMAIL], [PHONE]!\n끝 ０１", "x"), (2, None, "x"), (2, long + "[EMAIL]", None), (2, "", "전화 [PHONE]"), (None, "없음", None), (1, "연락: [EMAIL], [PHONE]!\n끝 ０１", "x")]
    assert rows(out.select("id", "title_ko", F.col("`b.x`").alias("b"))) == sorted(want, key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, title_ko string, body_ko string")
    assert P.find(df).count() == 0
    assert P.sanitised(df, ["title_ko"]).count() == 0


@pytest.mark.parametrize("text", ["a" * 50_000 + " @", "1 " * 20_000, "Aa " * 20_000, "(" * 20_000, "김" * 50_000, "a." * 20_000 + "@", "1 Aa Aa " * 5000, "가 " * 20_000, "로" * 20_000, "213-555-0123 " * 3000])
def test_hostile_texts_end_soon(text):
    began = time.perf_counter()
    P.candidates(text)
    assert time.perf_counter() - began < 10


def test_what_recurs_is_read_once(monkeypatch):
    calls = {"word": 0, "key": 0, "structured": 0}

    def counting(name, f):
        def counted(*x):
            calls[name] += 1
            return f(*x)

        return counted

    for name in calls:
        monkeypatch.setattr(P, name, counting(name, getattr(P, name)))
    vocabulary = ["김다솔이", "집주인", "조용한", "동네", "세탁기", "남궁가온", "보증금", "전기와", "요금"]
    segments = [f"{a} {b} {c} {d} {n:05} {e}" for n, (a, b, c, d, e) in enumerate(itertools.product(vocabulary, repeat=5)) if n % 7 == 0]
    reader = P.Reader()
    hits = [list(reader.text(s)) for s in segments]
    assert all(len(x) == 1 and x[0][0] == 0 for x in hits)
    # the words and the number, digits aside; a word between two others once; no number here can be a value
    assert calls["word"] == len(vocabulary) + 1 and calls["structured"] == 0
    assert calls["key"] <= 2 * (len(vocabulary) + 2) ** 3 < len(segments)
    assert len(reader.read) == len({h[0][1] for h in hits}) and sum(len(k) for _, k, _ in reader.read) > calls["key"]


@pytest.mark.parametrize("text", [t for t, _ in CASES + EXTRA if t] + ["  김다솔이\t남궁가온씨에게 (김다솔)님. 다음 ", "a김다솔 12김다솔이3 김다솔-남궁가온,최온래", "최온래213-555-0123김다솔 남궁가온", "Arden K. Gwonson South Elowen-Kim Lee-Arden 김다솔", "\r\n김다솔.. 최온래"])
def test_reader_gives_the_candidates_of_each_segment(text):
    reader = P.Reader()
    want = []
    for at, s in P.segments(P.plain(text)):
        values = P.structured(s)
        s = s if values else P.DIGIT.sub("0", s)
        want.append((at, sorted((P.key(*x[3:7]), P.placed(x[0], x[1], x[2])) for x in P.candidates(s, values))))
    got = list(reader.text(text))
    read = {k: sorted(zip(keys, places)) for k, keys, places in reader.read}
    assert [(at, read[k]) for at, k in got] == [x for x in want if x[1]]


def test_digits_aside_a_segment_with_a_value_is_another(spark):
    # only the second is a telephone number, though the digits of the first put as 0 give the second
    df = spark.createDataFrame([(1, "번호 12-345-6789 로"), (2, "번호 00-000-0000 로"), (3, "번호 12-345-6789 로")], "id long, title_ko string").coalesce(1)
    assert rows(P.spans(df, "id", ["title_ko"]).where("kind = 'PHONE'"), "id", "start_at", "end_at") == [(2, 3, 14)]
