"""URLs: building, canonical forms, parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_url(base: Column, path: Column) -> Column:
    """Base and path joined by exactly one slash."""
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), F.regexp_replace(path, "^/+", ""))


def _query(url: Column) -> Column:
    return F.regexp_extract(url, r"\?([^#]*)", 1)


def _with_query(url: Column, query: Column) -> Column:
    head, fragment = F.regexp_extract(url, r"^([^?#]*)", 1), F.regexp_extract(url, r"(#.*)$", 1)
    return F.concat(head, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")), fragment)


def without_parameter(url: Column, name: str) -> Column:
    """The URL without a parameter; the order, blank values and the fragment stay."""
    kept = F.filter(F.split(_query(url), "&"), lambda x: (x != "") & (F.split_part(x, F.lit("="), F.lit(1)) != name))
    return _with_query(url, F.array_join(kept, "&"))


def page_url(url: Column, page: Column, name: str = "page") -> Column:
    """The URL of a list page: the parameter is set or replaced; of repeated parameters the last counts, blank ones are dropped."""
    pairs = F.filter(F.split(_query(url), "&"), lambda x: F.contains(x, F.lit("=")) & (F.length(F.split_part(x, F.lit("="), F.lit(2))) > 0))
    keys = F.array_distinct(F.transform(pairs, lambda x: F.split_part(x, F.lit("="), F.lit(1))))
    last = F.transform(keys, lambda k: F.get(F.reverse(F.filter(pairs, lambda x: F.split_part(x, F.lit("="), F.lit(1)) == k)), F.lit(0)))
    set_ = F.concat(F.lit(f"{name}="), page.cast("string"))
    replaced = F.transform(last, lambda x: F.when(F.split_part(x, F.lit("="), F.lit(1)) == name, set_).otherwise(x))
    query = F.array_join(F.when(F.array_contains(keys, name), replaced).otherwise(F.concat(last, F.array(set_))), "&")
    return _with_query(url, query)


def parameter(url: Column, name: str) -> Column:
    """A parameter's value, '' if it is missing."""
    return F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)


def path_tail(url: Column) -> Column:
    """The last part of the path, without query and fragment."""
    return F.regexp_extract(url, r"([^/?#]*)(?:[?#].*)?$", 1)


def absolute(url: Column, base: Column) -> Column:
    return F.when(url.rlike(r"^https?://"), url).otherwise(full_url(base, url))
