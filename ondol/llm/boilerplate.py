"""Main content of web pages by a tree-structured graphical model.

Every page becomes a tree of DOM elements whose text blocks are leaves. Each node has a hidden label, content or not; leaves
and inner nodes have potentials from their features, and parent-child potentials connect the labels. Sum-product message
passing, once upward and once downward, gives every block its marginal; blocks above one half are content.

The potentials are fitted on labelled pages: pages whose listing is known are labelled by whether a block's text occurs in the
listing's body. Node potentials come from a logistic regression over hashed features, the parent-child potentials from label
counts. ``TRAIN_PAGES`` bounds that sample; it is drawn by the hash of the page id. Everything else runs over all pages, each
page alone in one pass without a shuffle.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

#: The bound of the labelled sample.
TRAIN_PAGES = 2000
#: Pages of the sample with more nodes than this don't train the model (all pages are labelled by it).
TRAIN_NODES = 500
#: Characters of a block that counts as content where nothing could be learnt.
PLAIN = 40
#: Hash buckets of the features, steps and regularisation of the fit, and the weight of the parent-child potentials.
BUCKETS, STEPS, DECAY, PAIR_WEIGHT = 1 << 18, 120, 1e-4, 0.5

#: Elements by their role in the tree.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SKIPPED = {"script", "style", "noscript", "template", "head", "title", "svg", "iframe"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "em", "font", "i", "label", "mark", "q", "s", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "button"}
CLOSED_BY = {  # an open element (key) ends where one of these starts
    "p": {"address", "article", "aside", "blockquote", "center", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "tr": {"tr", "tbody", "tfoot"},
}
SCOPE = {"table", "div", "section", "article", "main", "body", "html", "ul", "ol", "dl"}

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
SPACE = re.compile(r"[\s\xa0 ]+")
ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.S | re.I)
DATE = re.compile(r"\d{1,4}[-./년월]\s?\d{1,2}|\d{1,2}:\d{2}|ago\b|시간 전|분 전")


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "text", "links", "inline", "up", "down")

    def __init__(self, tag: str, attrs: str, parent: "Node | None"):
        self.tag, self.attrs, self.parent, self.children, self.text, self.links, self.inline = tag, attrs, parent, [], "", 0, ""
        if parent:
            parent.children.append(self)


def tree(html: str) -> tuple[Node, list[Node]]:
    """The tree of block elements (its root holds the title as text) and its text blocks in document order. A block is the text of a stretch between block
    boundaries or line-break elements; inline elements don't cut. Sloppy markup is taken as browsers do: open elements are
    closed by those that can't stand in them, unknown end tags are ignored."""
    root = Node("html", "", None)
    here, blocks, parts = root, [], []
    links = skip = at = 0
    in_link = 0
    inline: list[str] = []

    def flush() -> None:
        nonlocal links
        text = SPACE.sub(" ", unescape("".join(parts))).strip()
        parts.clear()
        if text:
            leaf = Node("#", "", here)
            leaf.text, leaf.links, leaf.inline = text, links, " ".join(inline[:3])
            blocks.append(leaf)
        links = 0
        inline.clear()

    head = TITLE.search(html)
    root.text = SPACE.sub(" ", unescape(head[1])).strip() if head else ""
    skipping = ""
    for m in TOKEN.finditer(html):
        if not skipping and m.start() > at:
            piece = html[at : m.start()]
            parts.append(piece)
            if in_link:
                links += len(piece)
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if skipping:
            if m[1] and name == skipping:
                skipping = ""
            continue
        if not m[1] and name in SKIPPED:
            if name != "head" and not m[3].endswith("/"):
                skipping = name
            continue
        if name in INLINE:
            if name == "a":
                in_link = max(0, in_link + (-1 if m[1] else 1))
            if not m[1] and not "".join(parts).strip():
                inline.append(name)
            continue
        if name == "br" or name == "hr":
            flush()
            continue
        if name in VOID or name in SKIPPED:
            continue
        flush()
        in_link = 0
        if m[1]:
            node = here
            while node.parent and node.tag != name:
                node = node.parent
            if node.parent:
                here = node.parent
            continue
        node = here
        while node.parent and node.tag not in SCOPE or node.tag in CLOSED_BY and name in CLOSED_BY[node.tag]:
            if node.tag in CLOSED_BY and name in CLOSED_BY[node.tag]:
                here = node.parent
                node = here
                continue
            node = node.parent
        here = Node(name, m[3] or "", here)
        if m[3] and m[3].endswith("/"):
            here = here.parent
    if not skipping and at < len(html):
        parts.append(html[at:])
    flush()
    return root, blocks


def _bucket(n: int) -> int:
    return min(8, n.bit_length())


def features(node: Node, position: float, header: int, title: str, stats: dict[int, list]) -> list[str]:
    """The features of a node. Those that begin with a minus sign are words: the model lets them speak against content only,
    since the words of a posting also stand in teasers and comments."""
    up = node.parent
    above = up.parent.tag if up and up.parent else ""
    if node.tag != "#":
        size, links, first = stats[id(node)]
        out = [f"t:{node.tag}", f"d:{node.tag}<{up.tag if up else ''}<{above}", f"k:{node.tag}:{_bucket(len(node.children))}", f"L:{node.tag}:{int(4 * links / max(1, size))}", f"z:{_bucket(size)}", f"-h:{first[:14]}"]
        for k, a, b, c in ATTR.findall(node.attrs):
            value = (a or b or c).lower()
            for word in re.split(r"[^a-z]+", value):
                if len(word) > 3 or (len(word) > 1 and value == word):
                    out.append(f"{k.lower()}:{word}")
        return out
    t = node.text
    kin = up.children
    at = next(k for k, x in enumerate(kin) if x is node)
    before = kin[at - 1] if at else None
    texts = sum(1 for c in kin if c.tag == "#")
    linked = max((int(4 * c.links / max(1, len(c.text))) for c in kin if c.tag == "#" and c is not node), default=-1)
    around = [x for x in (up.parent.children if up.parent else []) if x is not up]
    size, links, _ = stats[id(up.parent)] if up.parent else stats[id(up)]
    return [
        f"p:{up.tag}<{above}", f"pp:{up.tag}<{above}<{up.parent.parent.tag if up.parent and up.parent.parent else ''}", f"n:{_bucket(len(t))}", f"l:{int(4 * node.links / max(1, len(t)))}",
        f"i:{node.inline}:{up.tag}", f"e:{t[-1] if not t[-1].isalnum() else 'w'}", f"date:{bool(DATE.search(t)) and len(t) < 40}", f"y:{header}:{up.tag}",
        f"s:{up.tag}:{_bucket(texts)}", f"b:{before.tag if before else ''}:{up.tag}", f"x:{linked}", f"a:{above}:{int(8 * links / max(1, size))}", f"o:{up.tag}:{'.'.join(sorted({x.tag for x in around})[:4])}",
        f"q:{int(position * 5)}", f"T:{len(t) > 5 and (t in title or title.startswith(t))}", f"-w:{t.split(' ')[0][:12]}", f"-f:{t[:24]}", f"-v:{t[-14:]}",
    ]


def nodes(root: Node) -> list[Node]:
    """Parents before children."""
    out = [root]
    for n in out:
        out += n.children
    return out


def described(root: Node, blocks: list[Node]) -> list[tuple[Node, list[str]]]:
    place = {id(b): k for k, b in enumerate(blocks)}
    n = max(1, len(blocks))
    # where a block stands to the statement of the posting time and to the headline
    header = next((k for k, b in enumerate(blocks) if DATE.search(b.text) and len(b.text) < 60 and b.links == 0), -1)
    order = nodes(root)
    stats: dict[int, list] = {id(x): [len(x.text), x.links, x.text] if x.tag == "#" else [0, 0, ""] for x in order}
    for x in reversed(order):
        if x.parent:
            own, above = stats[id(x)], stats[id(x.parent)]
            above[0] += own[0]
            above[1] += own[1]
            above[2] = own[2] or above[2]
    return [(x, features(x, place.get(id(x), 0) / n, (place[id(x)] > header) - (place[id(x)] < header) if id(x) in place and header >= 0 else 2, root.text, stats)) for x in order]


def hashed(fs: list[str]) -> list[int]:
    """Buckets of features; the upper half is that of words, whose weights stay at or below zero."""
    half = BUCKETS // 2
    return [zlib.crc32(f.encode()) % half + (half if f[0] == "-" else 0) for f in fs]


class Model:
    """Weights of the node features and parent-child potentials."""

    def __init__(self, weight: np.ndarray, bias: float, pairs: dict[tuple[int, int], int]):
        self.weight = {int(k): float(weight[k]) for k in np.flatnonzero(weight)}
        self.bias = bias
        self._seen: dict[str, float] = {}
        total = sum(pairs.values()) + 4
        child = [sum(pairs.get((p, c), 0) for p in (0, 1)) + 2 for c in (0, 1)]
        parent = [sum(pairs.get((p, c), 0) for c in (0, 1)) + 2 for p in (0, 1)]
        self.pair = [[PAIR_WEIGHT * math.log((pairs.get((p, c), 0) + 1) * total / (parent[p] * child[c])) for c in (0, 1)] for p in (0, 1)]

    def logit(self, fs: list[str]) -> float:
        seen, out = self._seen, self.bias
        for f in fs:
            w = seen.get(f)
            if w is None:
                if len(seen) > 300_000:
                    seen.clear()
                w = seen[f] = self.weight.get(hashed([f])[0], 0.0)
            out += w
        return out


def regression(rows: np.ndarray, buckets: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch gradient steps with momentum and per-weight rates; word weights are kept at or below zero."""
    w, g2, speed = np.zeros(BUCKETS), np.full(BUCKETS, 1e-8), np.zeros(BUCKETS)
    bias, n = 0.0, max(1, len(labels))
    half = BUCKETS // 2
    for _ in range(STEPS):
        z = np.bincount(rows, weights=w[buckets], minlength=len(labels)) + bias
        off = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - labels
        grad = np.bincount(buckets, weights=off[rows], minlength=BUCKETS) / n + DECAY * w / 100
        g2 = 0.9 * g2 + 0.1 * grad * grad
        speed = 0.8 * speed + 0.2 * grad
        w -= 0.1 * speed / (np.sqrt(g2) + 1e-6)
        np.minimum(w[half:], 0.0, out=w[half:])
        bias -= 0.5 * off.mean()
    w[np.abs(w) < 1e-3] = 0.0
    return w, float(bias)


def marginals(root: Node, described_nodes: list[tuple[Node, list[str]]], model: Model) -> dict[int, float]:
    """id(node) -> probability of content, by one upward and one downward pass."""
    order = [x for x, _ in described_nodes]
    pair = model.pair
    up: dict[int, tuple[float, float]] = {}
    belief: dict[int, list[float]] = {id(x): [0.0, model.logit(fs)] for x, fs in described_nodes}
    for x in reversed(order):
        b = belief[id(x)]
        if x.parent is not None:
            u = up[id(x)] = (_sum(pair[0][0] + b[0], pair[0][1] + b[1]), _sum(pair[1][0] + b[0], pair[1][1] + b[1]))
            pb = belief[id(x.parent)]
            pb[0] += u[0]
            pb[1] += u[1]
    out: dict[int, float] = {}
    down: dict[int, tuple[float, float]] = {id(root): (0.0, 0.0)}
    for x in order:
        d, b = down[id(x)], belief[id(x)]
        f0, f1 = b[0] + d[0], b[1] + d[1]
        out[id(x)] = 1.0 / (1.0 + math.exp(max(-60.0, min(60.0, f0 - f1))))
        for c in x.children:
            u = up[id(c)]
            e0, e1 = f0 - u[0], f1 - u[1]
            top = max(e0, e1)
            down[id(c)] = (_sum(e0 - top + pair[0][0], e1 - top + pair[1][0]), _sum(e0 - top + pair[0][1], e1 - top + pair[1][1]))
    return out


def _sum(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def squeezed(text: str) -> str:
    return SPACE.sub(" ", text).strip()


def labelled(html: str, body: str) -> list[tuple[Node, list[str], int]] | None:
    """The nodes of a page with their labels: a block is content where its text is a piece of the listing's body; an inner node
    where most of its text is. None where the body isn't found on the page."""
    root, blocks = tree(html)
    whole = squeezed(body)
    lines = {squeezed(x) for x in body.split("\n")}
    label = {id(b): int(b.text in lines or (len(b.text) > 11 and b.text in whole)) for b in blocks}
    if sum(len(b.text) for b in blocks if label[id(b)]) < 0.5 * len(whole):
        return None
    done = described(root, blocks)
    size: dict[int, list[int]] = {id(x): [0, 0] for x, _ in done}
    for x, _ in reversed(done):
        if x.tag == "#":
            size[id(x)][label[id(x)]] += len(x.text)
        if x.parent:
            for k in (0, 1):
                size[id(x.parent)][k] += size[id(x)][k]
    return [(x, fs, label.get(id(x), int(size[id(x)][1] > size[id(x)][0]))) for x, fs in done]


def fit(pages: DataFrame, listings: DataFrame) -> Model | None:
    """Potentials from at most ``TRAIN_PAGES`` pages whose url is that of a listing with a body."""
    good = pages.where("html_content is not null and http_status = 200").select("id", F.col("url").alias("_u"), "html_content")
    # the sample: the pages with the smallest hashes; only their ids and urls are broadcast, at most TRAIN_PAGES of each
    sample = F.broadcast(good.select("id", F.xxhash64("id").alias("h")).orderBy("h", "id").limit(TRAIN_PAGES).select("id"))
    chosen = good.join(sample, "id", "left_semi")
    urls = F.broadcast(chosen.select(F.col("_u").alias("_v")).distinct())
    bodies = listings.where("length(trim(body_ko)) > 0").select(F.col("url").alias("_v"), "body_ko").join(urls, "_v", "left_semi")
    bodies = bodies.groupBy("_v").agg(F.min("body_ko").alias("body_ko"))
    both = chosen.hint("shuffle_hash").join(bodies, F.col("_u") == F.col("_v")).select("html_content", "body_ko")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for html, body in zip(pdf.html_content, pdf.body_ko):
                rows = labelled(html, body) or []
                rows = rows if len(rows) <= TRAIN_NODES else []
                of = {id(x): y for x, _, y in rows}
                out += [(hashed(fs), y, of[id(x.parent)] if x.parent else -1) for x, fs, y in rows]
            yield pd.DataFrame(out, columns=["buckets", "label", "parent"])

    return trained(both.mapInPandas(run, "buckets array<int>, label int, parent int").toPandas())


def trained(nodes_of_sample: pd.DataFrame) -> Model | None:
    """The model of labelled nodes (buckets, label, parent: the label of the parent or -1), None without any."""
    sizes = nodes_of_sample.buckets.map(len).to_numpy(dtype=np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    buckets = np.concatenate([np.asarray(b, dtype=np.int64) for b in nodes_of_sample.buckets]) if len(sizes) else np.zeros(0, dtype=np.int64)
    if not len(sizes):
        return None
    w, bias = regression(rows, buckets, nodes_of_sample.label.to_numpy(dtype=float))
    pairs = nodes_of_sample[nodes_of_sample.parent >= 0].groupby(["parent", "label"]).size()
    return Model(w, bias, {(int(p), int(c)): int(n) for (p, c), n in pairs.items()})


def content(html: str, model: Model | None) -> list[str]:
    """The paragraphs of the main content of one page, in order. Without a model, where no page could be labelled, these are the
    blocks of at least ``PLAIN`` characters of which less than a third are links."""
    root, blocks = tree(html)
    if not blocks:
        return []
    if model is None:
        return [b.text for b in blocks if len(b.text) >= PLAIN and 3 * b.links < len(b.text)]
    p = marginals(root, described(root, blocks), model)
    return [b.text for b in blocks if p[id(b)] > 0.5]


def main_content(pages: DataFrame, model: Model | None) -> DataFrame:
    """(page_id, position, paragraph) of all pages. NULL, empty and failed pages (status other than 200) have no content."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            rows = [(i, k, t) for i, html in zip(pdf.id, pdf.html_content) for k, t in enumerate(content(html, m))]
            yield pd.DataFrame(rows, columns=["page_id", "position", "paragraph"])

    return spread(pages.where("html_content is not null and http_status = 200").select("id", "html_content")).mapInPandas(run, "page_id bigint, position int, paragraph string")


def found(pages: DataFrame, listings: DataFrame) -> DataFrame:
    """(page_id, para_md5), one row per distinct paragraph of a page."""
    rows = main_content(pages, fit(pages, listings))
    # only the hashes are shuffled, not the texts
    return rows.groupBy("page_id").agg(F.collect_set(F.md5(F.encode("paragraph", "UTF-8"))).alias("m")).select("page_id", F.explode("m").alias("para_md5"))
