"""Text fields of listings as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATORS = (":", "：")
LINE_BREAKS = r"\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"


def lines(text: Column) -> Column:
    """The lines of a text, trimmed; NULL stays NULL."""
    return F.transform(F.split(text, LINE_BREAKS), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))


def first_line(text: Column) -> Column:
    """The first line that isn't blank, '' if there is none."""
    return F.coalesce(F.get(F.filter(lines(text), lambda x: x != ""), F.lit(0)), F.lit(""))


def title_bracket(title: Column) -> Column:
    """The content of a leading [bracket], trimmed, '' without one."""
    return F.coalesce(F.regexp_extract(title, r"^\s*\[\s*([^\]]+?)\s*\]", 1), F.lit(""))


def labelled_field(text: Column, labels: list[str]) -> Column:
    """What stands after the first 'label:' that begins a line, lines first, then labels in their order; '' if there is none."""
    starts = [f"{label}{sep}" for label in labels for sep in SEPARATORS]

    def rest(line: Column) -> Column:
        out = F.lit(None).cast("string")
        for s in reversed(starts):
            out = F.when(F.startswith(line, F.lit(s)), F.regexp_replace(F.substring(line, F.lit(len(s) + 1), F.length(line)), r"^\s+|\s+$", "")).otherwise(out)
        return out

    hits = F.filter(F.transform(lines(text), rest), lambda x: x.isNotNull())
    return F.coalesce(F.get(hits, F.lit(0)), F.lit(""))


def infer_location(title: Column, body: Column, labelled: Column) -> Column:
    """The labelled place; else the title's bracket with the first body line, unless the line holds it; else either."""
    bracket, head = title_bracket(title), first_line(body)
    both = F.when((bracket != "") & (head != ""), F.when(F.contains(head, bracket), head).otherwise(F.concat_ws(" ", bracket, head)))
    return F.when(F.coalesce(labelled, F.lit("")) != "", labelled).otherwise(F.coalesce(both, F.nullif(head, F.lit("")), bracket))


def searchable(*columns: str) -> Column:
    """The concatenation that text search runs on; NULL parts count as empty."""
    return F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])


def content_hash(html: Column) -> Column:
    return F.sha2(html, 256)
