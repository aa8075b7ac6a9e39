"""Places by literal substrings: the longest literal first, then in alphabetical order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Literals and their states in the order in which they are tried.
STATES = {
    "ca": "CA", "california": "CA", "캘리포니아": "CA", "ga": "GA", "georgia": "GA", "조지아": "GA", "ny": "NY", "new york": "NY",
    "nj": "NJ", "new jersey": "NJ", "tx": "TX", "texas": "TX", "wa": "WA", "washington": "WA", "il": "IL", "illinois": "IL",
}
#: Cities in the United States and in Korea.
US_CITIES = (
    "la", "los angeles", "애틀랜타", "atlanta", "oc", "orange county", "sf", "san francisco", "샌프란시스코", "sd", "san diego", "샌디에고", "ny", "new york", "뉴욕", "nj", "new jersey", "뉴저지", "queens", "퀸즈",
    "flushing", "플러싱", "irvine", "어바인", "duluth", "둘루스", "sunny", "sunnyvale", "새너니", "fullerton", "풀러턴", "hollywood", "할리우드", "burbank", "버뱅크", "koreatown", "코리아타운", "ktown",
)
KR_CITIES = ("서울", "부산", "인천", "대구", "대전", "광주", "울산", "세종", "경기", "강원", "충북", "충남", "전북", "전남", "경북", "경남", "제주")


def ordered(words: list[str]) -> list[str]:
    return sorted(words, key=lambda w: (-len(w), w))


def normalized(text: Column) -> dict[str, Column]:
    """city, state and country; the text itself, cut to 50 characters, where no literal is in it. Empty texts give NULLs."""
    low = F.lower(text)
    state, city = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, code in reversed(STATES.items()):
        state = F.when(low.contains(word), code).otherwise(state)
    for word in reversed(ordered(US_CITIES)):
        city = F.when(low.contains(word), F.initcap(F.lit(word))).otherwise(city)
    korean = F.lit(None).cast("string")
    for word in reversed(ordered(KR_CITIES)):
        korean = F.when(text.contains(word), word).otherwise(korean)
    in_korea = city.isNull() & korean.isNotNull()
    raw = F.when(F.length(text) > 50, F.concat(F.substring(text, 1, 50), F.lit("..."))).otherwise(text)
    full = F.coalesce(F.trim(text), F.lit("")) != ""
    return {"city": F.when(full, F.coalesce(city, korean, raw)), "state_or_province": F.when(full & ~in_korea, state), "country": F.when(full, F.when(in_korea, "KR").otherwise("US"))}
