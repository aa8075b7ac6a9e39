"""Sentence boundaries across languages and scripts, by a hidden-event n-gram language model.

Between two words there may be a hidden event, the end of a sentence. The model counts, over all documents, how often word
contexts of up to three words stand before a certain end (a paragraph's end, or a line's end for words without a mark) and how
often words stand at a certain beginning. Contexts back off to shorter ones and to the word's ending. A forward-backward pass
over the gaps of a paragraph gives the posterior of each event; gaps above one half end a sentence.

Some events are certain: paragraphs end sentences, so do headings and list lines; stops inside a quotation do not end the
sentence around it; emoticons and closing quotes belong to what stands before them, a leading list number to what follows.
Scripts without spaces get gaps after their full stops; scripts without stops (Thai, chat) get theirs from the model.

Counts are kept by key, a 64-bit hash of the context, in a table: nothing is pruned, and no two contexts share a count but by a
collision of 64 bits. Documents are dealt into chunks of about ``CHUNK`` characters; each chunk gets the counts of its own
keys by a join, so that no process holds the counts of the whole corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, spread

#: Characters of a chunk, and keys that a Python worker counts before it passes them on.
CHUNK, HELD = 1 << 22, 1 << 18
#: Strength of the back-off, bound of the odds of the following word, chance of one-word sentences, and of an end at a space.
BACK_OFF, BOUND, SHORT, AT_SPACE = 6.0, 6.0, 0.1, 0.3
#: Characters at the end of a word that are looked at for marks and emoticons.
TAIL = 64

CLOSERS = "\"'”’»」』）)】》〉]"
STOPS = ".!?。！？…．｡"
PARAGRAPH = re.compile(r"(?:\r\n|\r|\n| | )[ \t 　]*(?:(?:\r\n|\r|\n| | )[ \t 　]*)+")
LINE = re.compile(r"\r\n|\r|\n| | |\x0b|\x0c|\x85")
TOKEN = re.compile(rf"[^\s。！？｡]+(?:[。！？｡]+[{re.escape(CLOSERS)}]*)?|[。！？｡]+[{re.escape(CLOSERS)}]*")
ENDS = re.compile(rf"[{re.escape(STOPS)}]+[{re.escape(CLOSERS)}]*(?:[ㅋㅎㅠㅜ^~♥☀-➿\U0001f000-\U0001faff️‍]*)$")
EMOTICON = re.compile(r"(?:[:;=8][-^']?[)(DPp3oO/\\|\]\[*]+|[\^ㅋㅎㅠㅜㅇ~♥♡!?.…]++|\^[_.\-]?\^|[TㅜㅠQ][_.]?[TㅜㅠQ]|[←-⇿⌀-⏿☀-➿⬀-⯿\U0001f000-\U0001faff️‍⃣\U000e0020-\U000e007f]++[!?.~]*+)++$")
TRAILING = re.compile(r"(?:[ㅋㅎㅠㅜ]{2,}|\^\^|~+|[☀-➿\U0001f000-\U0001faff️‍]+)$")
NUMBER_LEAD = re.compile(r"(?:\(?\d{1,3}[.)]|[①-⑳]|\d{1,3}\))$")
BULLET = re.compile(r"\s*(?:[-*•■●▪◦○□◆◇▶►※·☞✔✓]|#{1,6})(?=\s|[^\s\d*#-])")
BRACKETED = re.compile(r"\s*(?:\[[^\]]*\]|<[^<>]*>|【[^】]*】|\([^)]*\))\s*$")
PAIRS = {"“": "”", "「": "」", "『": "』", "«": "»", "‘": "’", "《": "》", "（": "）", "(": ")"}
#: Words that go on after a quotation, and polite endings that close a Korean clause.
GOES_ON = re.compile(r"(?:하고|라고|라며|라면서|이라고|하며|하는|라는|하면서|고|며|との|と|って|そう|등|는|은|을|를|의|도|만)(?![가-힣]{3})")
POLITE = re.compile(r"[가-힣](?:요|니다|니까)$")
QUOTE = re.compile("[\"'" + "".join(PAIRS) + "".join(PAIRS.values()).replace("]", "") + "]")
#: Scripts that put spaces between sentences and not between words.
SPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff]")
DIGITS = re.compile(r"\d+")


def shape(word: str) -> str:
    """Numbers made alike."""
    return DIGITS.sub("0", word) if any(c.isdigit() for c in word) else word


@lru_cache(maxsize=1 << 17)
def key(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x01".join(parts).encode("utf-8", "replace")) - (1 << 63)


@lru_cache(maxsize=1 << 17)
def looked_up(word: str) -> tuple[str, str, bool, bool]:
    """The shape of a word, the shape without what trails it, whether it ends with a mark, whether it is an emoticon."""
    form = shape(word)
    # marks and emoticons stand at the end; a bounded tail keeps runs of thousands of marks cheap
    tail = form[-TAIL:]
    bare = form[:-TAIL] + TRAILING.sub("", tail)
    emoticon = len(word) <= TAIL and EMOTICON.match(word) is not None and word.strip(".…!?") != ""
    return form, bare or form, ENDS.search(word[-TAIL:]) is not None, emoticon


class Gap:
    __slots__ = ("kind", "fixed", "contexts", "following", "word", "after")


def quoted(text: str) -> list[tuple[int, int]]:
    """The spans of quotations that are opened and closed in a paragraph."""
    out: list[tuple[int, int]] = []
    open_, close = -1, ""
    for m in QUOTE.finditer(text):
        k, c = m.start(), m[0]
        after = text[k + 1 : k + 2]
        if open_ >= 0:
            if c == close and (c != "'" or not after.isalnum() or "가" <= after <= "힣"):
                out.append((open_, k + 1))
                open_ = -1
        elif c in PAIRS or (c in "\"'" and not (k and (text[k - 1].isalnum() or text[k - 1] in STOPS)) and after.strip()):
            close = PAIRS.get(c, c)
            if text.find(close, k + 1) > 0:
                open_ = k
    return out


def paragraphs(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    for m in PARAGRAPH.finditer(text):
        yield at, m.start()
        at = m.end()
    yield at, len(text)


@lru_cache(maxsize=1 << 17)
def contexts(kind: str, before2: str, before1: str, word: str, bare: str, emoticon: bool) -> tuple[int, int, int, int]:
    """The keys of the contexts before an event, the shortest first."""
    trailed = "^" if emoticon or bare != word else ""
    return key(kind, "e", bare[-2:] + trailed), key(kind, "1", bare + trailed), key(kind, "2", before1, bare), key(kind, "3", before2, before1, bare)


@lru_cache(maxsize=1 << 17)
def settled(word: str, after: str, broken: bool) -> bool | None:
    """Whether the mark at the end of a word certainly ends a sentence; None where the model decides."""
    tail = word.rstrip("ㅋㅎㅠㅜ^~♥")
    closed = tail[-1:] in CLOSERS
    stop = tail.rstrip(CLOSERS)
    if closed and (GOES_ON.match(after) or after[:1].islower() or after[:1] in ",;:、，"):
        return False
    if (closed and stop[-1:] in STOPS) or stop[-1:] in "!?。！？｡":
        # a mark that is no full stop ends a sentence unless the text goes on in lower case
        return not (after[:1].islower() and not broken)
    return None


@lru_cache(maxsize=1 << 17)
def beginning(shape_: str) -> int:
    return key("b", shape_)


def units(text: str, start: int, end: int) -> tuple[list[tuple[int, int]], list[Gap], list[tuple[str, str, bool, bool]]]:
    """The tokens of a paragraph, the gaps after each but the last, and what is known of the words. A gap's kind: mark, line or
    space; fixed is True or False where the event is certain."""
    part = text[start:end]
    tokens = [m.span() for m in TOKEN.finditer(part)]
    if not tokens:
        return [], [], []
    breaks = [m.span() for m in LINE.finditer(part)]
    edges = [0, *[b for _, b in breaks], len(part)]
    alone = []
    for k in range(len(edges) - 1):
        line = part[edges[k] : edges[k + 1]]
        stripped = line.strip()
        alone.append(bool(stripped) and bool(BULLET.match(line) or BRACKETED.match(line) or (len(stripped) > 4 and stripped.startswith("==") and stripped.endswith("==")) or (stripped[-1] in ":：" and len(stripped) <= 40)))
    if breaks:
        row, k = [], 0
        for a, _ in tokens:
            while k + 1 < len(edges) - 1 and edges[k + 1] <= a:
                k += 1
            row.append(k)
    else:
        row = [0] * len(tokens)
    inside = quoted(part)
    words = [part[a:b] for a, b in tokens]
    known = [looked_up(w) for w in words]
    emotes = any(x[3] for x in known)
    gaps: list[Gap] = []
    q = 0
    before2 = before1 = "<s>"
    for i in range(len(tokens) - 1):
        g = Gap()
        word, after = words[i], words[i + 1]
        form, bare, ends, emote = known[i]
        broken = row[i] != row[i + 1]
        in_quote = False
        if inside:
            a, b = tokens[i][1], tokens[i + 1][0]
            while q < len(inside) and inside[q][1] < a:
                q += 1
            in_quote = q < len(inside) and inside[q][0] < a and b < inside[q][1]
        first = i == 0 or row[i - 1] != row[i]
        marked_before = False
        if emotes and emote:
            # an emoticon shares the context of the word before it
            j = i
            while j and known[j][3]:
                j -= 1
            marked_before = known[j][2]
            kind = "mark"
            g.contexts = contexts("m", known[j - 2][0] if j > 1 else "<s>", known[j - 1][0] if j else "<s>", known[j][0], known[j][1], True)
        else:
            kind = "mark" if ends else "line" if broken else "space"
            g.contexts = contexts("m" if ends else "w", before2, before1, form, bare, False)
        before2, before1 = before1, form
        fixed = None
        if broken and (alone[row[i]] or alone[row[i + 1]]):
            fixed = True
        elif in_quote or (emotes and known[i + 1][3] and not broken):
            fixed = False
        elif first and not broken and NUMBER_LEAD.match(word):
            fixed = False
        elif broken and NUMBER_LEAD.match(after):
            fixed = True
        elif emote and (marked_before or (word[-1:] in "!?.…" and len(word) > 1)):
            fixed = True
        elif ends and not emote:
            fixed = settled(word, after, broken)
        g.kind, g.fixed, g.word, g.after, g.following = kind, fixed, word, after, beginning(known[i + 1][0])
        gaps.append(g)
    return tokens, gaps, known


BASE = key("base")


def observe(text: str, counts: dict[int, list[int]]) -> None:
    """Adds to counts, key -> [seen, certain ends or beginnings], every context of a document."""

    def add(k: int, ended: int) -> None:
        c = counts.get(k)
        if c is None:
            counts[k] = [1, ended]
        else:
            c[0] += 1
            c[1] += ended

    for start, end in paragraphs(text):
        tokens, gaps, known = units(text, start, end)
        if not tokens:
            continue
        for g in gaps:
            fixed, kind = g.fixed, g.kind
            if fixed is not None and kind != "mark":
                continue
            ends = 1 if kind == "line" else 0
            for c in g.contexts:
                add(c, ends)
            add(g.following, 1 if ends or (kind == "mark" and fixed) else 0)
            # what ends with a mark that is never part of a word tells how often ends are followed by a paragraph's end
            if fixed and kind == "mark":
                add(BASE, 0)
        j = len(known) - 1
        emoticon = known[j][3]
        while j and known[j][3]:
            j -= 1
        kind = "m" if emoticon or known[j][2] else "w"
        for c in contexts(kind, known[j - 2][0] if j > 1 else "<s>", known[j - 1][0] if j else "<s>", known[j][0], known[j][1], emoticon):
            add(c, 1)
        add(beginning(known[0][0]), 1)
        if kind == "m" and text[start + tokens[-1][1] - 1] in "!?。！？":
            add(BASE, 1)


def counted(documents: DataFrame, text: str = "text") -> DataFrame:
    """(chunk, key, seen, ended): the counts by key of every chunk (column chunk); each chunk has at least the key of the base."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[int, dict[int, list[int]]] = {}

        def table() -> pd.DataFrame:
            return pd.DataFrame([(chunk, k, n, e) for chunk, own in counts.items() for k, (n, e) in own.items()], columns=["chunk", "key", "seen", "ended"])

        for pdf in batches:
            for chunk, t in zip(pdf["chunk"].tolist(), pdf[text]):
                own = counts.get(chunk)
                if own is None:
                    own = counts[chunk] = {BASE: [0, 0]}
                if t:
                    observe(t, own)
            if sum(map(len, counts.values())) > HELD:
                yield table()
                counts.clear()
        yield table()

    rows = documents.select("chunk", text).mapInPandas(run, "chunk int, key bigint, seen bigint, ended bigint")
    return rows.groupBy("chunk", "key").agg(F.sum("seen").alias("seen"), F.sum("ended").alias("ended"))


def fit(documents: DataFrame, text: str = "text") -> dict[int, tuple[int, int]]:
    """key -> (seen, ended) over all documents, on the driver: for corpora of a bounded size. ``found`` has no need of it."""
    rows = counted(spread(documents.select(text)).withColumn("chunk", F.lit(0)), text).toPandas()
    return dict(zip(rows.key.tolist(), zip(rows.seen.tolist(), rows.ended.tolist())))


class Model:
    def __init__(self, counts: Mapping[int, tuple[int, int]]):
        self.counts = counts
        self.kept: dict[tuple, float] = {}
        seen, ended = self.of(BASE)
        # the share of certain sentence ends that end a paragraph
        self.base = min(1.0, max(0.05, (ended + 1) / (seen + 3)))

    def of(self, k: int) -> tuple[int, int]:
        """(seen, ended) of a key."""
        return self.counts.get(k, (0, 0))

    def probability(self, g: Gap) -> float:
        """The posterior of the event at one gap from its own context, before the neighbours are heard; kept for gaps that recur."""
        key = (g.kind, g.contexts, g.following, g.word, g.after)
        p = self.kept.get(key)
        if p is None:
            if len(self.kept) > 1 << 17:
                self.kept.clear()
            p = self.kept[key] = self._probability(g)
        return p

    def _probability(self, g: Gap) -> float:
        bare = looked_up(g.word)[1]
        spaced = SPACED.search(bare) is not None
        base = self.base if g.kind == "mark" or spaced else 1.0
        p = 0.5 if g.kind == "mark" else 0.02
        k = BACK_OFF / max(0.1, base)
        for c in g.contexts:
            n, ended = self.of(c)
            if n:
                p = (min(1.0, ended / (n * base)) * n + p * k) / (n + k)
        polite = g.kind == "space" and POLITE.search(bare) is not None
        if polite and (g.after[:1].isalpha() or g.after[:1] in "$0123456789"):
            p = max(p, 0.95)
        p = min(0.995, max(0.002, p))
        n, begun = self.of(g.following)
        start = (begun + 0.3) / (n + 2.0) / max(self.base, 0.2)
        lean = min(0.95, max(0.03, start))
        factor = min(BOUND, max(1 / BOUND, lean / (1 - lean) * (2.0 if g.kind == "mark" or spaced else 1.0)))
        if g.kind == "mark" and g.after[:1].islower():
            factor /= 20
        odds = p / (1 - p) * factor
        if g.kind == "line":
            odds *= 3.0 if not g.after[:1].islower() else 0.3
        if g.kind == "space" and not polite and not spaced:
            odds *= AT_SPACE
        return odds / (1 + odds)


def posteriors(gaps: list[Gap], model: Model) -> list[float]:
    """Forward-backward over the events of a paragraph; two ends next to each other are unlikely."""
    n = len(gaps)
    own = []
    for g in gaps:
        p = model.probability(g) if g.fixed is None else 1.0 if g.fixed else 0.0
        own.append((1.0 - p, p))
    # the factor of an end right after an end; scripts that only have spaces between sentences are left alone
    free = [g.fixed is None and g.kind != "line" and (g.word.isascii() or SPACED.search(g.word) is None) for g in gaps]
    short = [SHORT if a and b else 1.0 for a, b in zip([False, *free], free)]
    ahead = [(1.0, 1.0)] * n
    for i in range(n - 2, -1, -1):
        a, b = own[i + 1][0] * ahead[i + 1][0], own[i + 1][1] * ahead[i + 1][1]
        x, y = a + b, a + b * short[i + 1]
        ahead[i] = (x / (x + y), y / (x + y)) if x + y else (0.5, 0.5)
    out, f = [], (1.0, 0.0)
    for i in range(n):
        a, b = (f[0] + f[1]) * own[i][0], (f[0] + f[1] * short[i]) * own[i][1]
        f = (a / (a + b), b / (a + b)) if a + b else (0.5, 0.5)
        x, y = f[0] * ahead[i][0], f[1] * ahead[i][1]
        out.append(y / (x + y) if x + y else 0.0)
    return out


def sentences(text: str | None, model: Model) -> list[tuple[int, int]]:
    """(start, end) of the sentences of a text, white space around them left out."""
    out: list[tuple[int, int]] = []
    if not text:
        return out
    for start, end in paragraphs(text):
        tokens, gaps, _ = units(text, start, end)
        if not tokens:
            continue
        begin = tokens[0][0]
        for (_, b), (a, _), p in zip(tokens, tokens[1:], posteriors(gaps, model)):
            if p > 0.5:
                out.append((start + begin, start + b))
                begin = a
        out.append((start + begin, start + tokens[-1][1]))
    return out


def split(documents: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, start_at, end_at), one row per sentence. NULL, empty and blank texts give no row; texts are read whole."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            rows = [(i, a, b) for i, t in zip(pdf[id_column].tolist(), pdf[text]) for a, b in sentences(t, m)]
            yield pd.DataFrame(rows, columns=[id_column, "start_at", "end_at"])

    return spread(documents.select(id_column, text)).mapInPandas(run, f"{id_column} {dict(documents.dtypes)[id_column]}, start_at int, end_at int")


def found(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The sentences of all documents, by a model of all documents; see ``split``."""
    docs = documents.select(id_column, text).where(F.length(text) > 0)
    size = docs.agg(F.sum(F.length(text))).first()[0] or 0
    chunks = max(4 * documents.sparkSession.sparkContext.defaultParallelism, -(-size // CHUNK))
    docs = docs.withColumn("chunk", F.pmod(F.xxhash64(id_column, text), F.lit(chunks)).cast("int")).repartition(chunks, "chunk")
    counts = materialize(counted(docs, text), "contexts")
    whole = counts.groupBy("key").agg(F.sum("seen").alias("seen"), F.sum("ended").alias("ended"))
    known = counts.select("chunk", "key").join(whole, "key").repartition(chunks, "chunk")

    def run(pdf: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        m = Model(dict(zip(own["key"].tolist(), zip(own["seen"].tolist(), own["ended"].tolist()))))
        rows = [(i, a, b) for i, t in zip(pdf[id_column].tolist(), pdf[text]) for a, b in sentences(t, m)]
        return pd.DataFrame(rows, columns=[id_column, "start_at", "end_at"])

    return docs.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInPandas(run, f"{id_column} {dict(documents.dtypes)[id_column]}, start_at int, end_at int")
