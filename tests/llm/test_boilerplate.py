import random

from conftest import rows
from ondol.llm import boilerplate as B


def page(k: int, rng: random.Random, body: list[str]) -> str:
    nav = "".join(f"<li><a href='/{i}'>menu{i}</a></li>" for i in range(5))
    tease = "".join(f"<li><a href='/r/{i}'>집 {i}단지</a><p>{rng.choice(BODY)}</p></li>" for i in range(3))
    if k % 2:
        main = "<article><h1>집 %d단지</h1><div><span>등록일</span> <span>2024-06-01</span></div><section>" % k + "".join(f"<p>{b}" for b in body) + "</section></article>"
    else:
        main = "<div id=cont><strong>집 %d단지</strong><br><span>Posted</span> <span>2024-06-01</span></div><div>" % k + "<br>\n".join(body) + "</div>"
    return f"<html><head><title>집 {k}단지 - B</title><script>var a='<p>x</p>';</script></head><body><div><ul>{nav}</ul></div>{main}<section><h4>댓글</h4><div><b>손님</b><p>{rng.choice(BODY)}</p></div></section><div><h4>Related</h4><ul>{tease}</ul></div><footer><p>© 2025 Board. All rights reserved.</p></footer></body></html>"


BODY = [f"방 {i}개에 거실이 넓고 햇볕이 잘 듭니다 {i}." for i in range(40)]


def made(n: int, seed: int):
    rng = random.Random(seed)
    for k in range(n):
        body = rng.sample(BODY, 3)
        yield k, page(k, rng, body), body


def test_held_out_pages(spark):
    data = list(made(300, 1))
    pages = spark.createDataFrame([(k, f"u{k}", h, 200) for k, h, _ in data], "id long, url string, html_content string, http_status int")
    listings = spark.createDataFrame([(f"u{k}", "\n".join(b)) for k, _, b in data], "url string, body_ko string")
    model = B.fit(pages, listings)
    good = wrong = missed = 0
    for _, h, body in made(100, 2):
        got, want = set(B.content(h, model)), set(body)
        good, wrong, missed = good + len(got & want), wrong + len(got - want), missed + len(want - got)
    assert good / (good + wrong) > 0.95 and good / (good + missed) > 0.95
    more = pages.unionByName(spark.createDataFrame([(900, "u", None, 200), (901, "u", "", 200), (902, "u", data[0][1], 404), (903, "u", "<p>" * 3000, 200)], pages.schema))
    out = rows(B.found(more, listings), "page_id")
    assert len(out) == len(set(rows(B.found(more, listings)))) and not {r[0] for r in out} & {900, 901, 902}


def test_blocks():
    root, blocks = B.tree("<title>t</title><p>a <b>b</b>&nbsp;c<p>d<br>e&amp;f<!-- x --><script>if(a<b){}</script><li><a href=x>g</a>")
    assert [b.text for b in blocks] == ["a b c", "d", "e&f", "g"] and blocks[3].links == 1 and root.text == "t"


def test_marginals_equal_enumeration():
    root, blocks = B.tree("<div><p>a</p><p>b</p></div><ul><li>c</ul>")
    d = B.described(root, blocks)
    rng = random.Random(0)
    model = B.Model.__new__(B.Model)
    model.pair, model.bias, model.weight, model._seen = [[0.4, -0.7], [-0.3, 0.9]], 0.0, {}, {}
    own = {id(x): rng.uniform(-2, 2) for x, _ in d}
    model.logit = lambda fs: own[next(id(x) for x, f in d if f is fs)]
    got = B.marginals(root, d, model)
    order = [x for x, _ in d]
    import itertools
    import math

    total, mass = 0.0, {id(x): 0.0 for x in order}
    for labels in itertools.product((0, 1), repeat=len(order)):
        of = {id(x): y for x, y in zip(order, labels)}
        w = math.exp(sum(own[id(x)] * of[id(x)] for x in order) + sum(model.pair[of[id(x.parent)]][of[id(x)]] for x in order if x.parent))
        total += w
        for x in order:
            mass[id(x)] += w * of[id(x)]
    assert all(abs(got[k] - mass[k] / total) < 1e-9 for k in mass)


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "id long, url string, html_content string, http_status int")
    listings = spark.createDataFrame([], "url string, body_ko string")
    assert B.found(pages, listings).count() == 0


def test_pages_without_any_label_fall_back_to_long_blocks(spark):
    long = "The room is bright and quiet, and the bus stop is near the house."
    page = f"<body><nav><a href=/a>{'home ' * 20}</a></nav><p>{long}</p><p>short</p></body>"
    pages = spark.createDataFrame([(1, "u", page, 200), (2, "v", None, 200)], "id long, url string, html_content string, http_status int")
    listings = spark.createDataFrame([("w", "other")], "url string, body_ko string")
    assert [r.paragraph for r in B.main_content(pages, B.fit(pages, listings)).collect()] == [long]
