import itertools
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import rows
from ondol.llm import mixing, sentences, tokens

PT = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def machine():
    return tokens.Transducer(tokens.vocabulary(tokens.vocabulary_path()))


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PT.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


TEXTS = ["", "Hello world's  end\n\n", "한빛 파크 1단지 ㅠㅠ", "駅から徒歩8分。", "<|endoftext|> x", "a" * 3000, " " * 99, "👩‍👩‍👧 🏡", "ค่าเช่า 3588", "﻿ㅤx", "-" * 200 + "=" * 77, "1234567890" * 30, "\r\n\t x"]


def test_ids_equal_the_library(machine, reference):
    for t in TEXTS:
        assert machine.encode(t) == reference.encode(t, add_special_tokens=False).ids, t
        assert machine.decode(machine.encode(t)) == t


@given(st.text(max_size=80))
@settings(max_examples=300, deadline=None)
def test_random_texts(machine, reference, t):
    assert machine.encode(t) == reference.encode(t, add_special_tokens=False).ids
    assert machine.decode(machine.encode(t)) == t


def test_a_full_machine_starts_afresh_with_the_same_output(machine, monkeypatch):
    want = [machine.encode(t) for t in TEXTS]
    monkeypatch.setattr(tokens, "MAX_STATES", 20)
    monkeypatch.setattr(tokens, "MAX_WORDS", 3)
    machine.words.clear()
    assert [machine.encode(t) for t in TEXTS] == want


@given(st.binary(max_size=40))
@settings(max_examples=300, deadline=None)
def test_utf8_machine(data):
    u = tokens.Utf8()
    assert "".join([*(u.feed(data[k : k + 1]) for k in range(len(data))), u.end()]) == data.decode("utf-8", "replace")


def test_encoded_rows(spark, reference):
    df = spark.createDataFrame([(1, "a b", 3), (2, "", 3), (3, None, 3), (1, "a b", 3)], "doc_id long, text string, ids int")
    assert rows(tokens.encoded(df)) == [(1, [64, 275]), (1, [64, 275]), (2, []), (3, [])]
    assert tokens.encoded(df.limit(0)).count() == 0


def test_water_filling():
    sizes, targets = {"a": 1000, "b": 100, "c": 50}, {"a": (0.5, 1), "b": (0.3, 2), "c": (0.2, 4)}
    got = mixing.water_fill(sizes, targets)
    total = sum(got.values())
    assert all(abs(got[s] / total - targets[s][0]) < 1e-9 for s in targets) and all(got[s] <= sizes[s] * targets[s][1] + 1e-9 for s in targets)
    got = mixing.water_fill(sizes, targets, 1200)
    assert got["b"] == 200 and got["c"] == 200 and abs(got["a"] - 800) < 1e-6
    assert mixing.water_fill({}, targets) == {"a": 0.0, "b": 0.0, "c": 0.0}
    assert mixing.water_fill({"a": 10}, targets)["b"] == 0.0


def test_mix_reaches_the_shares_and_respects_the_caps(spark):
    rng = random.Random(1)
    docs = [(k, " ".join(["word"] * rng.randrange(1, 30)), "a" if k % 10 < 7 else "b" if k % 10 < 9 else "c") for k in range(1500)] + [(5000, None, "a"), (5001, "", "b"), (5002, "x", None), (5003, "x", "z")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3), ("none", 0.0, 1)], "source string, target_share double, max_repeats int")
    mixed, report = mixing.mix(df, targets)
    shares = {r.source: (r.share, r.epochs, r.max_repeats) for r in report.collect() if r.size}
    assert all(abs(shares[s][0] - t) < 0.005 for s, t in (("a", 0.5), ("b", 0.3), ("c", 0.2))) and all(e <= m + 0.01 for _, e, m in shares.values())
    again = mixing.mix(df.repartition(7), targets)[0]
    assert rows(mixed) == rows(again) and {r.source for r in mixed.collect()} == {"a", "b", "c"}
    assert max(r.copies - m for r in mixed.collect() for m in [dict(a=1, b=2, c=3)[r.source]]) <= 0
    assert mixing.mix(df.limit(0), targets)[0].count() == 0


def test_water_filling_against_bisection():
    rng = random.Random(7)
    for _ in range(200):
        n = rng.randrange(1, 7)
        sizes = {str(k): rng.choice([0, 1, 10, 500, 10_000]) for k in range(n)}
        targets = {str(k): (rng.choice([0.0, 0.05, 0.2, 0.5]), rng.randrange(0, 5)) for k in range(n)}
        total = rng.randrange(1, 60_000)
        cap = {s: sizes[s] * targets[s][1] if targets[s][0] else 0 for s in targets}
        low, high = 0.0, 1e9
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(cap[s], mid * targets[s][0]) for s in targets) < total else (low, mid)
        want = {s: min(cap[s], low * targets[s][0]) for s in targets}
        got = mixing.water_fill(sizes, targets, total)
        assert all(abs(got[s] - want[s]) < 1e-3 * max(1, want[s]) for s in targets), (sizes, targets, total)


def test_a_given_total_clamps_and_is_reported(spark):
    df = spark.createDataFrame([(k, "word " * 10, "a" if k < 800 else "b" if k < 950 else "c") for k in range(1000)], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 0.4, 2), ("b", 0.3, 2), ("c", 0.3, 3)], "source string, target_share double, max_repeats int")
    report = {r.source: r for r in mixing.mix(df, targets, epochs=1.2)[1].collect()}
    sizes = {s: r.size for s, r in report.items()}
    assert report["b"].tokens == 2 * sizes["b"] and report["c"].tokens == 3 * sizes["c"] and report["c"].missed == 0
    rest = 1.2 * sum(sizes.values()) - 2 * sizes["b"] - 3 * sizes["c"]
    assert abs(report["a"].wanted - rest) < 1 and abs(report["a"].missed) <= 11 and report["a"].missed == report["a"].tokens - report["a"].wanted


DOCS = [
    ("Rent is $1651.50 per month, i.e. less than last year. Wait, what?! The U.S. credit history was not needed.", 3), ('"It is quiet here. You will like it," the owner told us. Is parking included?', 2), ("At about 3 p.m. Ms. Baekmore counted 4 spots.\n\nThey open at 8 and close at 6 p.m.", 2),
    ("집주인이 \"바로 입주하셔도 됩니다.\"라고 말했습니다. 이사 날짜는 2025. 6. 20. 로 정했습니다.", 2), ("여성분만 연락 주세요\n반려동물은 안 됩니다\n가격은 조금 조정해 드려요", 3), ("여성분만 연락 주세요 반려동물은 안 됩니다 가격은 조금 조정해 드려요", 3), ("とても明るい部屋です！大家さんは「いつでも。どうぞ。」と言いました。駐車場はありますか？", 3),
    ("房东说：“随时可以看房。欢迎联系。”水电费另算，网络免费。", 2), ("เจ้าของบ้านใจดีค่ะ มีที่จอดรถไหมคะ ห้องกว้าง 41 ตารางเมตร", 3), ("## Amenities\n- no smoking\n[가격]\n1. 주차 자리가 있나요?", 4), ("The landlord moved the\nsofa though nobody had asked.", 1), ("방이 생각보다 작았어요 ㅠㅠ. 관심 있는 분은 쪽지 주세요 ^^ 👍 주차 자리가 있나요?", 3),
    ("La Sra. Moonfield vive en el núm. 80. ¡Qué buena vista!", 2), ("", 0), ("   \n ", 0), (None, 0),
]


@pytest.fixture(scope="module")
def model(spark):
    """Trained on paragraphs of the same kind."""
    rng = random.Random(2)
    latin = ["Rent is $1651.50 per month, i.e. less than last year.", "Wait, what?!", "The U.S. credit history was not needed.", '"It is quiet here. You will like it," the owner told us.', "Is parking included?", "At about 3 p.m. Ms. Baekmore counted 4 spots.", "They open at 8 and close at 6 p.m.", "The landlord moved the sofa though nobody had asked.", "La Sra. Moonfield vive en el núm. 80.", "¡Qué buena vista!"]
    korean = ['집주인이 "바로 입주하셔도 됩니다."라고 말했습니다.', "이사 날짜는 2025. 6. 20. 로 정했습니다.", "방이 생각보다 작았어요 ㅠㅠ.", "관심 있는 분은 쪽지 주세요 ^^", "주차 자리가 있나요?"]
    thai, chat = ["เจ้าของบ้านใจดีค่ะ", "มีที่จอดรถไหมคะ", "ห้องกว้าง 41 ตารางเมตร"], ["여성분만 연락 주세요", "반려동물은 안 됩니다", "가격은 조금 조정해 드려요"]
    docs = []
    for _ in range(400):
        kind = rng.choice([latin, latin, korean, thai])
        docs.append("\n\n".join(" ".join(rng.choice(kind) for _ in range(rng.randrange(1, 5))) for _ in range(3)))
        docs.append("\n".join(rng.choice(chat) for _ in range(5)))
    return sentences.Model(sentences.fit(spark.createDataFrame([(d,) for d in docs], "text string").repartition(3)))


def test_sentences(spark, model):
    df = spark.createDataFrame([(k, t, 1) for k, (t, _) in enumerate(DOCS)], "doc_id long, text string, start_at int")
    got: dict = {}
    for r in sentences.split(df, model).collect():
        t = DOCS[r.doc_id][0][r.start_at : r.end_at]
        assert t and t == t.strip()
        got.setdefault(r.doc_id, []).append(t)
    assert {k: len(v) for k, v in got.items()} == {k: n for k, (_, n) in enumerate(DOCS) if n}, got
    assert sentences.found(df.limit(0)).count() == 0


def test_long_text_is_read_whole(model):
    text = "The sofa was old. " * 20_000
    out = sentences.sentences(text, model)
    assert len(out) == 20_000 and out[-1][1] == len(text) - 1


@pytest.mark.parametrize("text", ["ㅋ" * 5000 + "입니다", "." * 20_000 + "x", "😂" + "!" * 5000 + "x", "=" * 20_000 + "x", "'" * 5000, "가" * 100_000, "(" * 5000, "\n " * 5000 + "x"])
def test_hostile_texts_end_soon(model, text):
    assert sentences.sentences(text, model)[-1][1] == len(text.rstrip())


def test_posteriors_equal_enumeration(model):
    import itertools
    import math

    _, gaps, _ = sentences.units("Apt. No. 9 faces p.m. The x ok", 0, 30)
    own = [1.0 if g.fixed else 0.0 if g.fixed is False else model.probability(g) for g in gaps]
    short = [sentences.SHORT if i and all(g.fixed is None and g.kind != "line" for g in gaps[i - 1 : i + 1]) else 1.0 for i in range(len(gaps))]
    total, mass = 0.0, [0.0] * len(gaps)
    for labels in itertools.product((0, 1), repeat=len(gaps)):
        w = math.prod((p if y else 1 - p) * (short[i] if i and y and labels[i - 1] else 1.0) for i, (p, y) in enumerate(zip(own, labels)))
        total += w
        mass = [m + w * y for m, y in zip(mass, labels)]
    assert all(abs(a - m / total) < 1e-9 for a, m in zip(sentences.posteriors(gaps, model), mass))


def test_contexts_of_other_words_do_not_count(spark):
    # words that always end a paragraph, and whose contexts fell on the 2^18 counters of "saw Apt. No." and of its parts
    slot = lambda *parts: zlib.crc32("\x01".join(parts).encode()) % (1 << 18)
    wanted = {slot("m", "1", "No."), slot("m", "2", "Apt.", "No."), slot("m", "3", "saw", "Apt.", "No.")}
    foreign = {slot("m", "1", w): w for w in ("".join(x) + "z." for x in itertools.product("abcdefghijklmnop", repeat=5)) if slot("m", "1", w) in wanted}
    assert len(foreign) == 3
    docs = ["we saw Apt. No. 9 there"] * 100 + [w for w in foreign.values() for _ in range(2000)]
    df = spark.createDataFrame([(k, d) for k, d in enumerate(docs)], "doc_id long, text string")
    assert rows(sentences.found(df).where("doc_id = 0")) == [(0, 0, 23)]


def test_chunks_give_what_one_model_gives(spark, monkeypatch):
    docs = [(k, d) for k, (d, _) in enumerate(DOCS * 5)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    whole = rows(sentences.split(df, sentences.Model(sentences.fit(df))))
    monkeypatch.setattr(sentences, "CHUNK", 100)
    assert rows(sentences.found(df)) == whole and len(whole) > 100
