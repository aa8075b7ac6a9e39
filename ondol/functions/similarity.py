"""Similarity of short texts: the token-set ratio on normalised Indel similarity, as a vectorised function."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs(a: str, b: str) -> int:
    """The length of the longest common subsequence, by bit vectors."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for k, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & masks.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def indel(a: str, b: str) -> float:
    """1 - (insertions + deletions) / (both lengths); 1 for two empty texts."""
    total = len(a) + len(b)
    return 1.0 if not total else 2.0 * lcs(a, b) / total


def token_set(a: str, b: str) -> float:
    """0..1; 1 if the tokens of one are among those of the other. A text without tokens is similar to nothing."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 1.0
    da, db = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    one, two = (f"{both} {da}".strip(), f"{both} {db}".strip())
    return max(indel(one, two), indel(both, one) if both else 0.0, indel(both, two) if both else 0.0)


def token_set_ratio(a: Column | str, b: Column | str) -> Column:
    """NULL counts as an empty text."""

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([token_set(p or "", q or "") for p, q in zip(x, y)], dtype="float64")

    return ratio(a, b)
