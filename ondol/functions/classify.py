"""Categories of listings by keywords in order of priority."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Category and its keywords, the first category with a hit counts.
KEYWORDS = {
    "apartment": ["아파트", "아파", "apartment", "apt"],
    "condo": ["콘도", "콘도미니엄", "condo", "condominium"],
    "house": ["주택", "집", "단독주택", "house", "home", "single family"],
    "commercial_space": ["상가", "사무실", "점포", "commercial", "office", "storefront"],
    "parking": ["주차", "주차장", "parking", "garage"],
    "sublet": ["전대", "재임차", "서브렛", "sublet", "sublease"],
    "room_share": ["룸셰어", "방 나눔", "셰어하우스", "room share", "shared room"],
    "roommate_wanted": ["룸메이트", "방 구함", "함께 살", "roommate wanted", "looking for roommate"],
}
OTHER = "other"


def category(*texts: Column) -> Column:
    text = F.lower(F.concat_ws(" ", *[F.coalesce(t, F.lit("")) for t in texts]))
    out = F.lit(OTHER)
    for name, words in reversed(KEYWORDS.items()):
        out = F.when(text.rlike("|".join(words)), name).otherwise(out)
    return out
