"""Personal information in free text: found, typed and replaced, by information-theoretic sanitisation.

One Python pass cuts the texts into segments (lines and Korean sentences), reads every distinct one and puts out candidates: values by their form (e-mail addresses, phone numbers, identity
numbers, street addresses) and name-shaped terms (Hangul words without their particles, runs of capitalised words), each with
the word before it and what follows it. Everything after that is joins and aggregates over distinct candidates:

* Terms next to a protected value or to a form of address (``MARKERS``) are the first evidence. The pointwise mutual
  information of the parts of terms (syllables by place, first and last words) with that evidence, counted over distinct terms,
  tells how strongly a part points to a person.
* Contexts (the word before, what follows) get their mutual information with terms that disclose a person. No context is given
  beforehand but the markers.
* A term in its context is a name if the bits of its parts and of its context together exceed ``THRESHOLD``. Forms that other
  numbers share (bare runs of digits, spelt-out signs, Korean roads) count by how often they stand in the contexts in which
  unmistakable values of their kind stand.

Counts are tables by key: nothing is collected, and no part, term or context is cut off.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, spread

#: Bits from which a term discloses a person, bits from which a term counts as evidence for its contexts, the most that contexts
#: give and take, the most that a form gives, and the share of disclosing terms that the bits are taken against.
THRESHOLD, EVIDENCE, GAIN, LOSS, FORM_BITS, BASE = 1.0, 1.0, 0.45, 0.5, 2.0, 0.25
#: Distinct terms that a part or a context is taken to have been seen with before any count.
PRIOR = 2.0
#: Bits of values whose form nothing else has.
SURE_BITS = 64.0
#: Lines and segments that a worker remembers to have read, keys that it remembers to have described, words that it remembers,
#: and the characters of the longest of these.
LINES, KEYS, WORDS, KEPT_WORD = 1 << 17, 1 << 20, 1 << 17, 64
KINDS = ("EMAIL", "PHONE", "ID_NUMBER", "ADDRESS", "NAME")
NAME = KINDS.index("NAME")

WIDE = {0xFF01 + i: 0x21 + i for i in range(94)} | {0x3000: 0x20, 0xA0: 0x20}

WIDE_FORM = re.compile("[" + "".join(map(chr, WIDE)) + "]")

AT = r"\s?(?:@|골뱅이|\(\s?at\s?\)|\[\s?at\s?\]|\(골뱅이\)|\[골뱅이\])\s?"
DOT = r"(?:\.|\s?\(dot\)\s?|\s?\[dot\]\s?|점(?=[a-z]))"
EMAIL = re.compile(rf"(?<![A-Za-z0-9_%+-])(?<![A-Za-z0-9_%+-]\.)[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*{AT}[A-Za-z0-9-]+(?:{DOT}[A-Za-z0-9-]+)*{DOT}[A-Za-z]{{2,}}", re.I)
EMAIL_HINT = re.compile(r"@|골뱅이|[(\[]\s?at\s?[)\]]", re.I)
SEP = r"[-. ]"
PHONE = re.compile(
    rf"(?<![\w.-])(?:"
    rf"\+\d{{1,2}}{SEP}?\(?\d{{2,3}}\)?{SEP}?\d{{3,4}}{SEP}?\d{{4}}"
    rf"|(?:1{SEP})?\(\d{{2,3}}\){SEP}?\d{{3,4}}{SEP}\d{{4}}"
    rf"|(?:1{SEP})?\d{{3}}{SEP}\d{{3,4}}{SEP}\d{{4}}"
    rf"|0\d{{1,2}}{SEP}\d{{3,4}}{SEP}\d{{4}}"
    rf"|공[일이삼사오육칠팔구공]{{1,2}}{SEP}?(?:\d{{3,4}}|[일이삼사오육칠팔구공영]{{3,4}}){SEP}?(?:\d{{4}}|[일이삼사오육칠팔구공영]{{4}})"
    rf"|01\d{{8,9}}|[2-9]\d{{9}}"
    rf")(?!\d|-\d)"
)
ID_NUMBER = re.compile(r"(?<![\w-])(?:\d{6}\s?-\s?[0-9]\d{6}|\d{3}[- ]\d{2}[- ]\d{4}|[A-Z]\d{8}|\d{12}(?=\D|$)(?<=\d{12}))(?![\w-]*\d)")
TYPES = r"(?:Street|Str|St|Avenue|Ave|Av|Boulevard|Blvd|Bl|Drive|Drv|Dr|Road|Rd|Lane|Ln|Court|Ct|Place|Pl|Way|Terrace|Ter|Parkway|Pkwy|Highway|Hwy|Circle|Cir)"
ADDRESS = re.compile(
    rf"(?<![\w#$.-])\d{{1,6}}(?:-\d+)?\s+(?:(?:North|South|East|West|No|So|N|S|E|W|NE|NW|SE|SW)\b\.?\s+)?(?:[A-Z][A-Za-z'-]+\s+){{1,3}}{TYPES}(?![A-Za-z])\.?", re.I
)
KO_ADDRESS = re.compile(r"(?<![가-힣\w])[가-힣]+[로길]\s?(?:\d+(?:번)?길\s?)?\d+(?:-\d+)?(?!\d|[층호분개월부년명%]|\s?(?:층|분|개월|달러))")
#: In every number of a person or a telephone, but those that begin with a spelt-out zero; the second for digits put as 0.
LONG, NEAR = re.compile(r"\d{3}[-. ]?\d{4}|\d{2}[- ]\d{4}|\d{6}"), re.compile(r"00(?:0?[-. ]?0000|0000)")
HOUSE, ON_ROAD = re.compile(r"\d\s+[A-Za-z]"), re.compile(r"[로길]\s?\d")
#: The letters are those that [A-Z] matches whatever the case.
DIGITS = re.compile(r"\d{3}|공[일이삼사오육칠팔구공]|[로길] ?\d|\d [A-Za-zİıſ\u212a]")
#: Forms that nothing else has; the others are decided by the contexts in which they stand.
SURE = re.compile(r"\S*@\S*|\+.*|.*\(\d.*|(?:1[-. ])?\d{2,3}[-. ]\d{3,4}[-. ]\d{4}|\d{6}\s?-\s?\d{7}|\d.*[A-Za-z]\.?")

#: Forms of address and of signing around a person's name, and particles and copulas after a Korean noun.
MARKERS = ("님", "씨", "드림", "올림", "배상")
ENDINGS = ("가", "는", "은", "이", "을", "를", "의", "와", "과", "도", "만", "께", "께서", "에게", "에게서", "한테", "이랑", "랑", "하고", "로", "으로", "이라고", "라고", "입니다", "이고", "이며", "이에요", "예요", "이라는", "이네", "네")
PARTICLES = {f"{a}{b}{c}" for a in ("", "님", "씨") for b in ("", *ENDINGS) for c in ("", "는", "도", "만")}
LONGEST = 4 + max(map(len, PARTICLES))
RUN = re.compile(r"(?<![가-힣\w])[가-힣]{2,}(?![A-Za-z0-9])")
WORD = re.compile(r"\S+")
UPPER = re.compile(r"[A-Z]")
NUMERAL = re.compile(r"[\d공]")
CAPITALISED = re.compile(r"(?<![A-Za-z0-9#'-])[A-Z][a-z]+(?:-[A-Z][a-z]+)*(?![A-Za-z0-9'-])")
INITIAL = re.compile(r" (?:[A-Z]\. )?$")
DIRECTIONS = {"North", "South", "East", "West"}
NUMBER = re.compile(r"\d+")
DIGIT = re.compile(r"\d")
CUT = re.compile(r"[\n\r]+|(?<=[가-힣][.!?…])[!?.…]*[ \t]+")

#: In every text that is cut.
CUTS = re.compile(r"[\n\r]|[.!?…][ \t]")


def plain(text: str) -> str:
    """Full-width forms as plain ones, one character each, so that offsets stay."""
    return text.translate(WIDE) if not text.isascii() and WIDE_FORM.search(text) else text


def possible(masked: str) -> bool:
    """Whether a text may hold a value with a form of its own, by the text with its digits as 0."""
    if "@" in masked or "골뱅이" in masked or "공" in masked or ("(" in masked or "[" in masked) and EMAIL_HINT.search(masked):
        return True
    return "0" in masked and (NEAR.search(masked) is not None or HOUSE.search(masked) is not None or ON_ROAD.search(masked) is not None)


def structured(t: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the values with a form of their own, without overlaps, in order."""
    out: list[tuple[int, int, str]] = []
    if ("@" in t or "골뱅이" in t or "(" in t or "[" in t) and EMAIL_HINT.search(t):
        out += [(m.start(), m.end(), "EMAIL") for m in EMAIL.finditer(t)]
    if NUMERAL.search(t) and DIGITS.search(t):
        long = "공" in t or LONG.search(t)
        for kind, pattern, possible in (("ID_NUMBER", ID_NUMBER, long), ("PHONE", PHONE, long), ("ADDRESS", ADDRESS, HOUSE.search(t)), ("ADDRESS", KO_ADDRESS, ON_ROAD.search(t))):
            for m in pattern.finditer(t) if possible else ():
                start, end = m.span()
                if all(end <= x or start >= y for x, y, _ in out):
                    out.append((start, end, kind))
    out.sort()
    return out


#: What a word holds: itself with numbers as 0, the same after a blank, its runs (start, end, end of the run, term, what stands
#: before and after in the word; None at its edges), the spans of its capitalised parts, the places of the runs.
Word = tuple[str, str, tuple[tuple[int, int, int, str, str | None, str | None], ...], tuple[tuple[int, int], ...], list[int]]


def word(w: str) -> Word:
    """What a word holds, wherever it stands."""
    runs = []
    for m in RUN.finditer(w):
        a, b = m.span()
        run, size = m[0], b - a
        if size > LONGEST:
            continue
        for n in (4, 3, 2):
            if n == size or n < size and run[n:] in PARTICLES:
                runs.append((a, a + n, b, run[:n], NUMBER.sub("0", w[:a]) if a else None, NUMBER.sub("0", w[a + n :]) if a + n < len(w) else None))
    masked = NUMBER.sub("0", w)
    caps = tuple(m.span() for m in CAPITALISED.finditer(w)) if UPPER.search(w) else ()
    return masked, " " + masked, tuple(runs), caps, [placed(a, e, a) for a, e, *_ in runs]


def placed(start: int, end: int, group: int) -> int:
    """A place: start, length and the distance to the start of the candidate's group."""
    return start << 40 | (end - start) << 20 | min(start - group, 0xFFFFF)


def kept(w: str, known: dict[str, Word]) -> Word:
    x = word(w)
    if len(w) <= KEPT_WORD:
        known[w] = x
    return x


def candidates(t: str, taken: list[tuple[int, int, str]] | None = None, known: dict[str, Word] | None = None) -> list[tuple[int, int, int, int, str, str, str, bool]]:
    """(start, end, group, kind, term, left, right, sure) of a segment; candidates that overlap are in one group. left is the word
    before (or what stands before in the same word), right the rest of the word or the next one after a blank; protected values
    stand there by their kind, digits as 0, '^' and '$' at the edges. known keeps what words hold."""
    taken = structured(t) if taken is None else taken
    known = {} if known is None else known
    read = [known.get(w) or kept(w, known) for w in t.split()]
    lefts, rights = ["^", *[x[0] for x in read]], [*[x[1] for x in read], "$"]
    spans = [m.span() for m in WORD.finditer(t)]
    starts, ends = {a: f"<{k}>" for a, _, k in taken}, {b: f"<{k}>" for _, b, k in taken}
    for k, (a, b) in enumerate(spans):
        lefts[k + 1] = ends.get(b) or lefts[k + 1]
        rights[k] = starts.get(a) or rights[k]
    out = []
    k = 0
    for a, b, kind in taken:
        value = t[a:b]
        while spans[k][1] <= a:
            k += 1
        first, last = spans[k][0], k
        while spans[last][1] < b:
            last += 1
        left = (ends.get(a) or NUMBER.sub("0", t[first:a])) if a > first else lefts[k]
        right = (starts.get(b) or NUMBER.sub("0", t[b : spans[last][1]])) if b < spans[last][1] else rights[last + 1]
        sure = SURE.fullmatch(value) is not None
        out.append((a, b, a, KINDS.index(kind), "" if sure else f"{shape(value)}\x02{value}", left, right, sure))
    v = 0
    for k, (first, end) in enumerate(spans):
        if not read[k][2]:
            continue
        while v < len(taken) and taken[v][1] <= first:
            v += 1
        touched = v < len(taken) and taken[v][0] < end
        for a, e, b, term, left, right in read[k][2]:
            a, e, b = first + a, first + e, first + b
            if touched:
                if not _free(taken, a, b, v):
                    continue
                left = left and (ends.get(a) or left)
                right = right and (starts.get(e) or right)
            out.append((a, e, a, NAME, term, left or lefts[k], right or rights[k + 1], False))
    if any(x[3] for x in read):
        out += _capitalised(t, taken, spans, read, lefts, rights)
    return out


def _free(taken: list[tuple[int, int, str]], a: int, b: int, v: int) -> bool:
    """Whether a span meets no value, of those from place v on."""
    while v < len(taken) and taken[v][0] < b:
        if taken[v][1] > a:
            return False
        v += 1
    return True


def _capitalised(t: str, taken: list[tuple[int, int, str]], spans: list[tuple[int, int]], read: list[Word], lefts: list[str], rights: list[str]) -> list[tuple[int, int, int, int, str, str, str, bool]]:
    """Runs of capitalised words."""
    starts, ends = {a: f"<{k}>" for a, _, k in taken}, {b: f"<{k}>" for _, b, k in taken}
    caps = [(spans[k][0] + a, spans[k][0] + b, k) for k, x in enumerate(read) for a, b in x[3]]
    out = []
    v = group = last = 0
    for i, (a, b, k) in enumerate(caps):
        while v < len(taken) and taken[v][1] <= a:
            v += 1
        if not _free(taken, a, b, v) or t[a:b] in DIRECTIONS:
            continue
        if a >= last:
            group = a
        if i + 1 < len(caps) and INITIAL.fullmatch(t, b, caps[i + 1][0]) and _free(taken, a, caps[i + 1][1], v):
            last, of, till = caps[i + 1][1], group, caps[i + 1][2]
            e = last
        elif a >= last:
            e, of, till = b, a, k
        else:
            continue
        left = (ends.get(a) or NUMBER.sub("0", t[spans[k][0] : a])) if a > spans[k][0] else lefts[k]
        right = (starts.get(e) or NUMBER.sub("0", t[e : spans[till][1]])) if e < spans[till][1] else rights[till + 1]
        out.append((a, e, of, NAME, t[a:e], left, right, False))
    return out


def shape(value: str) -> str:
    """The form of a value: digits, letters and syllables by their kind, in runs."""
    return re.sub(r"[A-Za-z]+", "a", re.sub(r"[가-힣]+(?=[로길])|[공일이삼사오육칠팔구영]{3,}", "가", re.sub(r"\d", "0", value)))


def key(kind: int, term: str, left: str, right: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}\x01{term}\x01{left}\x01{right}".encode("utf-8", "replace")) - (1 << 63)


def segments(text: str) -> Iterator[tuple[int, str]]:
    """(offset, segment): the lines of a text, cut also after the ends of Korean sentences; no value and no context crosses one."""
    if not CUTS.search(text):
        if text:
            yield 0, text
        return
    at = 0
    for m in CUT.finditer(text):
        if m.start() > at:
            yield at, text[at : m.start()]
        at = m.end()
    if at < len(text):
        yield at, text[at:]


class Reader:
    """Reads texts, what recurs once: lines, segments (digits aside, where no value has a form of its own), words and words between
    two others."""

    def __init__(self) -> None:
        self.lines: dict[str, tuple[tuple[int, bytes], ...]] = {}
        self.segments: dict[str, bytes] = {}
        self.words: dict[str, Word] = {}
        self.between: dict[tuple[str, str, str], list[int]] = {}
        self.described: set[int] = set()
        #: What was read since it was last taken: (segment, keys, places) and (key, kind, sure, term, left, right).
        self.read: list[tuple[bytes, list[int], list[int]]] = []
        self.told: list[tuple[int, int, bool, str, str, str]] = []

    def taken(self) -> tuple[list, list]:
        out = self.read, self.told
        self.read, self.told = [], []
        for known, most in ((self.lines, LINES), (self.segments, LINES), (self.words, WORDS), (self.between, WORDS), (self.described, KEYS)):
            if len(known) > most:
                known.clear()
        return out

    def text(self, text: str) -> Iterator[tuple[int, bytes]]:
        """(offset, segment) of the segments that hold candidates; no segment crosses the end of a line."""
        at = 0
        for line in text.split("\n"):
            if line:
                hits = self.lines.get(line)
                if hits is None:
                    hits = self.lines[line] = tuple((a, k) for a, s in segments(plain(line)) if (k := self.segment(s)))
                for a, k in hits:
                    yield at + a, k
            at += len(line) + 1

    def segment(self, segment: str) -> bytes:
        """The hash of a segment if it holds candidates."""
        # without values of a form of their own only the places of digits count
        masked = DIGIT.sub("0", segment)
        values = structured(segment) if possible(masked) else []
        if values:
            # no masked segment begins with the end of a line
            masked = "\n" + segment
        k = self.segments.get(masked)
        if k is None:
            keys, places = self.values(segment, values) if values else self.names(masked)
            k = self.segments[masked] = xxhash.xxh3_128_digest(masked.encode("utf-8", "replace")) if keys else b""
            if keys:
                self.read.append((k, keys, places))
        return k

    def key(self, kind: int, term: str, left: str, right: str, sure: bool) -> int:
        x = key(kind, term, left, right)
        if x not in self.described:
            self.described.add(x)
            self.told.append((x, kind, sure, term, left, right))
        return x

    def values(self, t: str, values: list[tuple[int, int, str]]) -> tuple[list[int], list[int]]:
        hits = candidates(t, values, self.words)
        return [self.key(kind, term, left, right, sure) for _, _, _, kind, term, left, right, sure in hits], [placed(a, b, g) for a, b, g, *_ in hits]

    def names(self, t: str) -> tuple[list[int], list[int]]:
        """Keys and places of the candidates of a segment without values; they are those of ``candidates``."""
        words = t.split()
        known = self.words
        read = [known.get(w) or kept(w, known) for w in words]
        if " ".join(words) != t or any([x[3] for x in read]):
            return self.values(t, [])
        keys: list[int] = []
        places: list[int] = []
        at, before, last = 0, "^", len(words) - 1
        for k, w in enumerate(words):
            x = read[k]
            if x[2]:
                after = read[k + 1][1] if k < last else "$"
                own = self.between.get((before, w, after))
                if own is None:
                    own = [self.key(NAME, term, left or before, right or after, False) for _, _, _, term, left, right in x[2]]
                    if len(w) <= KEPT_WORD:
                        self.between[before, w, after] = own
                keys += own
                start = at << 40
                for p in x[4]:
                    places.append(start + p)
            at += len(w) + 1
            before = x[0]
        return keys, places


def found(rows: DataFrame, id_column: str, columns: list[str]) -> DataFrame:
    """Three kinds of rows: the segments of all texts that hold candidates (id, field, at, segment: a hash of 128 bits); the
    candidates of each segment (segment, keys, places), at least once; the descriptions of keys (key, kind, sure, term, left,
    right), at least once. Texts are read whole; a segment that recurs is read once by a worker, digits aside."""
    parts = [("segment", pa.binary()), ("field", pa.int32()), ("at", pa.int32()), ("keys", pa.list_(pa.int64())), ("places", pa.list_(pa.int64())), ("key", pa.int64()), ("kind", pa.int32()), ("sure", pa.bool_()), *[(n, pa.string()) for n in ("term", "left", "right")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            index: list[int] = []
            fields: list[int] = []
            ats: list[int] = []
            where: list[bytes] = []
            for f in range(len(columns)):
                for i, text in enumerate(batch.column(1 + f).to_pylist()):
                    if not text:
                        continue
                    for at, k in reader.text(text):
                        index.append(i)
                        fields.append(f)
                        ats.append(at)
                        where.append(k)
            lines, told = reader.taken()
            a, b, c = len(index), len(lines), len(told)
            segment, keys, places = zip(*lines) if lines else ((), (), ())
            described = zip(*told) if told else [()] * 6
            ids = batch.column(0).take(pa.array(index, pa.int64()))
            blocks = [(ids, b + c), (where + list(segment), c), (fields, b + c), (ats, b + c), (keys, c), (places, c), *[(x, 0) for x in described]]
            arrays = []
            for (block, after), of in zip(blocks, (ids.type, *[t for _, t in parts])):
                block = block if isinstance(block, pa.Array) else pa.array(block, of)
                arrays.append(pa.concat_arrays([pa.nulls(a + b + c - after - len(block), of), block, pa.nulls(after, of)]))
            yield pa.RecordBatch.from_arrays(arrays, names=["id", *[n for n, _ in parts]])

    kind = dict(rows.dtypes)[id_column]
    out = f"id {kind}, segment binary, field int, at int, keys array<bigint>, places array<bigint>, key bigint, kind int, sure boolean, term string, `left` string, `right` string"
    return spread(rows.select(F.col(f"`{id_column}`").alias("id"), *[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(columns)])).mapInArrow(run, out)


def _bits(inside: Column, seen: Column) -> Column:
    """The bits by which the share of distinct terms that are inside exceeds ``BASE``."""
    return F.log2((inside + PRIOR * BASE) / (seen + PRIOR) / BASE)


def disclosed(described: DataFrame) -> DataFrame:
    """(key, kind, bits) of the candidates that disclose a person or another protected entity, from the descriptions of all keys."""
    marked = F.regexp_replace("right", r"^ |[^가-힣]+$", "").rlike(f"^(?:{'|'.join(MARKERS)})")
    names = described.where((F.col("kind") == NAME) & ~F.col("term").isin(*MARKERS)).select("key", "term", "left", "right", (F.col("right").isin("<PHONE>", "<EMAIL>") | marked).alias("seed"))
    hangul = F.col("term").rlike("^[가-힣]")
    words = F.split("term", " ")
    # names of two, three and four syllables are told apart: ordinary words of one length would blur the parts of the others
    syllables = F.transform(F.split("term", ""), lambda x, k: F.concat(k.cast("string"), x))
    latin = F.array_compact(F.array(F.concat(F.lit("f"), F.get(words, F.lit(0))), F.when(F.size(words) > 1, F.concat(F.lit("l"), F.element_at(words, -1)))))
    names = names.withColumns({"parts": F.when(hangul, syllables).otherwise(latin), "shape": F.when(hangul, F.concat(F.lit("k"), F.length("term").cast("string"))).otherwise("w")})

    # the bits of the parts of a term, by the other terms that have them
    each = names.groupBy("term", "parts", "shape").agg(F.max(F.col("seed").cast("double")).alias("inside"))
    parts = each.select("shape", "inside", F.explode("parts").alias("part")).groupBy("shape", "part").agg(F.sum("inside").alias("i"), F.count(F.lit(1)).alias("n"))
    scored = each.select("term", "shape", "inside", F.explode("parts").alias("part")).join(parts, ["shape", "part"])
    scored = scored.groupBy("term").agg(F.avg(_bits(F.col("i") - F.col("inside"), F.col("n") - 1)).alias("own"))
    # a term that no context could carry over the threshold matters only to the counts of contexts
    known = materialize(scored.where(F.col("own") > THRESHOLD - GAIN), "terms")
    told = names.select("key", "term", "left", "right").join(known, "term", "left").withColumn("told", (F.coalesce("own", F.lit(0.0)) > EVIDENCE).cast("double"))
    told = told.select("key", "own", "told", F.explode(F.array(F.concat(F.lit("l"), F.col("left")), F.concat(F.lit("r"), F.col("right")))).alias("context"))
    seen = told.groupBy("context").agg(F.sum("told").alias("i"), F.count(F.lit(1)).alias("n"))
    met = told.where("own is not null").join(seen, "context").groupBy("key", "own").agg(F.avg(_bits(F.col("i") - F.col("told"), F.col("n") - 1)).alias("around"))
    last = met.select("key", F.lit(NAME).alias("kind"), (F.col("own") + F.greatest(F.lit(-LOSS), F.least(F.lit(GAIN), F.col("around")))).alias("bits")).where(F.col("bits") > THRESHOLD)
    return last.unionByName(values(described.where(F.col("kind") != NAME), known.where(F.col("own") > EVIDENCE)))


def values(described: DataFrame, persons: DataFrame) -> DataFrame:
    """(key, kind, bits) of the values: those of a sure form, and those whose form others share by the contexts in which sure
    values of their kind stand or that are a person's name: the log odds of the form over all contexts that recur, and those of
    the occurrence's own contexts. A context without sure values speaks against its values the more the oftener it occurs."""
    each = F.explode(F.array(F.concat(F.lit("l"), F.col("left")), F.concat(F.lit("r"), F.col("right")))).alias("context")
    counted = described.select("kind", "key", "sure", F.substring_index("term", "\x02", 1).alias("term"), each)
    seen = counted.where("context not in ('l^', 'r$')").groupBy("kind", "context").agg(F.count_if("sure").alias("hits"), F.count(F.lit(1)).alias("n"))
    person = persons.select(F.concat(F.lit("l"), F.col("term")).alias("context"), F.lit(True).alias("person"))
    met = counted.where("not sure").join(seen, ["kind", "context"], "left").join(person, "context", "left")
    hit = F.coalesce(F.col("hits") > 0, F.lit(False)) | F.coalesce("person", F.lit(False))
    met = met.select("key", "kind", "term", hit.cast("int").alias("hit"), F.when(~hit, F.log2(F.col("n").cast("double"))).alias("miss"))
    forms = met.groupBy("kind", "term").agg(F.greatest(F.lit(-FORM_BITS), F.least(F.lit(FORM_BITS), F.log2((F.sum("hit") + 4.0) / (F.count_if(F.col("miss") > 0) + 1.0)))).alias("form_bits"))
    own = met.groupBy("key", "kind", "term").agg((3.0 * F.sum("hit") - F.coalesce(F.sum("miss"), F.lit(0.0)) / 2).alias("own"))
    shared = own.join(forms, ["kind", "term"]).select("key", "kind", (F.col("form_bits") + F.col("own")).alias("bits")).where("bits > 0")
    return shared.unionByName(described.where("sure").select("key", "kind", F.lit(SURE_BITS).alias("bits")))


def spans(rows: DataFrame, id_column: str, columns: list[str]) -> DataFrame:
    """(id, field, kind, start_at, end_at), one row per occurrence, decided by the disclosure over all rows.

    NULL and empty texts have none; texts are read whole; a NULL id is an id like others; rows that repeat an id give what one
    of them gives if they repeat its text. Empty tables give no rows."""
    all_ = materialize(found(rows, id_column, columns), "candidates")
    texts = all_.where("field is not null").select("id", "field", "at", "segment")
    described = materialize(all_.where("key is not null").select("key", "kind", "sure", "term", "left", "right").distinct(), "described")
    place = F.arrays_zip(F.col("keys").alias("key"), F.col("places").alias("place"))
    read = all_.where("keys is not null").select("segment", F.explode(place).alias("c")).select("segment", "c.key", "c.place")
    hits = read.join(disclosed(described), "key")
    start = F.shiftright("place", 40).cast("int")
    hits = hits.select("segment", (start - F.col("place").bitwiseAND(0xFFFFF).cast("int")).alias("group"), "bits", start.alias("start_at"), (start + F.shiftright("place", 20).bitwiseAND(0xFFFFF).cast("int")).alias("end_at"), "kind")
    # of overlapping candidates the most disclosing ones stay
    groups = hits.groupBy("segment", "group").agg(F.array_sort(F.collect_set(F.struct((-F.col("bits")).alias("b"), "start_at", "end_at", "kind"))).alias("all"))
    keep = lambda kept, x: F.when(F.exists(kept, lambda y: (y["start_at"] < x["end_at"]) & (y["end_at"] > x["start_at"])), kept).otherwise(F.concat(kept, F.array(x)))
    chosen = groups.select("segment", F.explode(F.aggregate("all", F.slice("all", 1, 0), keep)).alias("x")).select("segment", "x.kind", "x.start_at", "x.end_at")
    name = lambda values, c: F.element_at(F.array(*[F.lit(v) for v in values]), F.col(c) + 1)
    placed_ = texts.join(chosen, "segment").select("id", name(columns, "field").alias("field"), name(KINDS, "kind").alias("kind"), (F.col("at") + F.col("start_at")).alias("start_at"), (F.col("at") + F.col("end_at")).alias("end_at"))
    return placed_.distinct()


def sanitised(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The rows with the given text columns replaced: each value becomes [KIND], everything else stays as it was. Other columns,
    repeated rows and NULLs are kept."""
    keyed = rows.withColumn("_k", F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])), 256))
    found_ = materialize(spans(keyed.select("_k", *[F.col(f"`{c}`") for c in columns]).distinct(), "_k", columns), "spans")
    for c in columns:
        of = found_.where(F.col("field") == c).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("start_at", "end_at", "kind"))).alias("_s"))
        keyed = keyed.join(of.withColumnRenamed("id", "_k"), "_k", "left")
        text = F.col(f"`{c}`")
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
        step = lambda z, x: F.struct(x["end_at"].alias("at"), F.concat(z["out"], F.substring(text, z["at"] + 1, x["start_at"] - z["at"]), F.lit("["), x["kind"], F.lit("]")).alias("out"))
        done = F.aggregate("_s", start, step, lambda z: F.concat(z["out"], F.substring(text, z["at"] + 1, F.length(text))))
        keyed = keyed.withColumn(c, F.when(F.col("_s").isNull(), text).otherwise(done)).drop("_s")
    return keyed.select(*[F.col(f"`{c}`") for c in rows.columns])


def find(rows: DataFrame, id_column: str = "id", columns: tuple[str, ...] = ("title_ko", "body_ko")) -> DataFrame:
    """Every occurrence in all rows, see ``spans``."""
    return spans(rows, id_column, list(columns))
