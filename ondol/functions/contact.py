"""Contact details in a text: the first telephone number, messenger id and e-mail address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns in the order in which they are tried.
PHONES = [r"\d{3}-\d{3}-\d{4}", r"\(\d{3}\)\s*\d{3}-\d{4}", r"\d{3}\.\d{3}\.\d{4}", r"\d{10,11}"]
MESSENGERS = [r"(?i)(?:카카오|kakao)[:\s]*([A-Za-z0-9_-]+)", r"(?i)(?:카톡|katok)[:\s]*([A-Za-z0-9_-]+)"]
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def _first(text: Column, patterns: list[str], group: int) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, group), F.lit("")) for p in patterns])


def phone(text: Column) -> Column:
    return _first(text, PHONES, 0)


def messenger(text: Column) -> Column:
    return _first(text, MESSENGERS, 1)


def email(text: Column) -> Column:
    return _first(text, [EMAIL], 0)
