"""Catalogue of the engine's relational queries, each with its SQL where SQL can express it.

``NOW`` and ``TODAY`` are bound once; nothing reads the clock. Times come out as epoch seconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify, contact, dates, legacy, location, price, text, urls
from ..operators import audit, boards, fuzzy, load, pipeline, relational, tables, validate
from ..session import materialize, scratch, spread, table
from ..sources import cache, history, pages as page_source
from ..streaming import seen

NOW, TODAY = "2026-06-01 00:00:00", "2026-06-01"
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def now():
    return F.lit(NOW).cast("timestamp")


def today():
    return F.lit(TODAY).cast("date")


def flagship(spark, sf_dir) -> DataFrame:
    """Unparsed pages' listings, newest first: classified, with contact fields and the first line of the text."""
    rows = table(spark, sf_dir, "listings").select("id", "source_id", "title_ko", "body_ko", "first_seen_at")
    newest = relational.top_per_key(rows, ["source_id"], 100, F.desc("first_seen_at"), F.col("id"))
    return newest.select("id", "source_id", classify.category(F.col("title_ko"), F.col("body_ko")).alias("category"), contact.phone(F.col("body_ko")).alias("phone"), contact.email(F.col("body_ko")).alias("email"), text.first_line(F.col("body_ko")).alias("first_line"))


# ---------------------------------------------------------------- scans, inserts, joins


@query("SELECT doc_id, sha256(text) AS hash FROM documents")
def content_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", text.content_hash(F.col("text")).alias("hash"))


@query("""
SELECT min(id) AS id, source_id, url, content_hash FROM scraped_pages n
WHERE fetched_at >= TIMESTAMPTZ '2025-06-01 00:00:00+00' AND NOT EXISTS (
  SELECT 1 FROM scraped_pages o WHERE o.fetched_at < TIMESTAMPTZ '2025-06-01 00:00:00+00'
  AND o.source_id IS NOT DISTINCT FROM n.source_id AND o.url IS NOT DISTINCT FROM n.url AND o.content_hash IS NOT DISTINCT FROM n.content_hash)
GROUP BY source_id, url, content_hash""")
def raw_insert_ignore(spark, d):
    p = table(spark, d, "scraped_pages").select("id", "source_id", "url", "content_hash", "fetched_at")
    cut = F.lit("2025-06-01 00:00:00").cast("timestamp")
    return tables.insert_ignore(p.where(F.col("fetched_at") < cut), p.where(F.col("fetched_at") >= cut).drop("fetched_at"), ["source_id", "url", "content_hash"], "id").select("id", "source_id", "url", "content_hash")


UNPARSED = "SELECT p.id, p.source_id, p.url, epoch(p.fetched_at)::BIGINT AS fetched FROM scraped_pages p WHERE NOT EXISTS (SELECT 1 FROM listings_staging s WHERE s.source_id = p.source_id AND s.content_hash = p.content_hash)"


def _unparsed(spark, d):
    p = table(spark, d, "scraped_pages").select("id", "source_id", "url", "content_hash", "fetched_at")
    return relational.unmatched(p, table(spark, d, "listings_staging"), ["source_id", "content_hash"]).select("id", "source_id", "url", F.unix_seconds("fetched_at").alias("fetched"))


@query(f"SELECT * FROM ({UNPARSED}) ORDER BY fetched DESC, id LIMIT 500")
def unparsed_pages_topk(spark, d):
    return _unparsed(spark, d).orderBy(F.desc("fetched"), "id").limit(500)


@query(f"SELECT id, source_id, url, fetched FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY fetched DESC, id) AS k FROM ({UNPARSED})) WHERE k <= 5")
def unparsed_topk_per_source(spark, d):
    return relational.top_per_key(_unparsed(spark, d), ["source_id"], 5, F.desc("fetched"), F.col("id"))


@query("SELECT id, url, source_id, content_hash FROM (SELECT *, row_number() OVER (PARTITION BY source_id, url ORDER BY fetched_at DESC, id DESC) AS k FROM scraped_pages) WHERE k = 1")
def newest_page(spark, d):
    p = table(spark, d, "scraped_pages").select("id", "source_id", "url", "content_hash", "fetched_at")
    return relational.latest_per_key(p, ["source_id", "url"], "fetched_at", "id").drop("fetched_at")


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def latest_per_key(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return relational.latest_per_key(e, ["user_id"], "ts", "event_id").drop("ts")


@query("SELECT s.id, EXISTS (SELECT 1 FROM scraped_pages p WHERE p.source_id = s.source_id AND p.content_hash = s.content_hash) AS known FROM listings_staging s")
def existing_hash_flag(spark, d):
    known = table(spark, d, "scraped_pages").select("source_id", "content_hash").distinct().withColumn("k", F.lit(True))
    return table(spark, d, "listings_staging").select("id", "source_id", "content_hash").join(known, ["source_id", "content_hash"], "left").select("id", F.coalesce("k", F.lit(False)).alias("known"))


@query("SELECT s.name, count(l.id)::BIGINT AS listings FROM sources s LEFT JOIN listings l ON l.source_id = s.id WHERE s.is_active GROUP BY s.name")
def active_source_scan(spark, d):
    s = table(spark, d, "sources").where("is_active").select(F.col("id").alias("source_id"), "name")
    counts = table(spark, d, "listings").groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))
    return s.join(counts, "source_id", "left").select("name", F.coalesce("n", F.lit(0)).cast("long").alias("listings"))


@query(f"SELECT id, source_id, title_ko, rent_monthly_usd::DOUBLE AS rent, city, epoch(parsed_at)::BIGINT AS parsed FROM listings_staging WHERE loaded_at IS NULL AND parsed_at >= TIMESTAMPTZ '{NOW}+00' - INTERVAL 7 DAY")
def recent_unloaded(spark, d):
    s = table(spark, d, "listings_staging").where(F.col("loaded_at").isNull() & (F.col("parsed_at") >= now() - F.expr("INTERVAL 7 DAYS")))
    return s.select("id", "source_id", "title_ko", F.col("rent_monthly_usd").cast("double").alias("rent"), "city", F.unix_seconds("parsed_at").alias("parsed"))


@query("""
SELECT 'registered without runs' AS label, name FROM (SELECT name FROM sources EXCEPT SELECT source_name FROM etl_runs) UNION ALL
SELECT 'runs without registration', name FROM (SELECT source_name AS name FROM etl_runs EXCEPT SELECT name FROM sources) UNION ALL
SELECT 'registered without target', name FROM (SELECT name FROM sources EXCEPT SELECT source FROM mix_targets) UNION ALL
SELECT 'target without registration', name FROM (SELECT source AS name FROM mix_targets EXCEPT SELECT name FROM sources)""")
def registry_diff(spark, d):
    s, r, m = table(spark, d, "sources").select("name"), table(spark, d, "etl_runs").select("source_name").distinct(), table(spark, d, "mix_targets").select("source")
    return relational.differences({"registered without runs": (s, r), "runs without registration": (r, s), "registered without target": (s, m), "target without registration": (m, s)})


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F')")
def fk_split_rejected(spark, d):
    done = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return relational.split_by_reference(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), done, ["l_orderkey"])[1]


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F')")
def fk_split_accepted(spark, d):
    done = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return relational.split_by_reference(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), done, ["l_orderkey"])[0]


@query("""
SELECT a.o_orderkey AS a_key, b.o_orderkey AS b_key, abs(date_diff('day', a.o_orderdate, b.o_orderdate))::INTEGER AS days FROM orders a JOIN orders b
ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND abs(date_diff('day', a.o_orderdate, b.o_orderdate)) <= 7""")
def time_window_pairs(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))
    pairs = relational.window_pairs(o, ["o_custkey"], "day", "o_orderkey", 7, [])
    return pairs.select(F.col("a_o_orderkey").alias("a_key"), F.col("b_o_orderkey").alias("b_key"), F.abs(F.datediff("a_day", "b_day")).alias("days"))


@query("""
SELECT source_id, url, min(page) AS page FROM (
  SELECT *, (row_number() OVER (PARTITION BY source_id ORDER BY fetched_at DESC, id) - 1) // 20 AS page FROM scraped_pages) p
WHERE page <= coalesce((SELECT min(page) FROM (SELECT source_id, fetched_at, (row_number() OVER (PARTITION BY source_id ORDER BY fetched_at DESC, id) - 1) // 20 AS page FROM scraped_pages) q
  WHERE q.source_id = p.source_id AND q.fetched_at < TIMESTAMPTZ '2025-06-01 00:00:00+00'), 1000000000) GROUP BY source_id, url""")
def early_stop_pages(spark, d):
    p = table(spark, d, "scraped_pages").select("id", "source_id", "url", "fetched_at")
    p = relational.numbered(p, ["source_id"], F.to_date("fetched_at"), F.desc_nulls_last("fetched_at"), F.col("id")).withColumn("page", F.floor((F.col("number") - 1) / 20))
    kept = relational.until_first_stale(p, ["source_id"], "page", F.col("fetched_at") < F.lit("2025-06-01 00:00:00").cast("timestamp"))
    return kept.groupBy("source_id", "url").agg(F.min("page").alias("page"))


@query(f"SELECT id, first_seen_at::DATE::VARCHAR AS day FROM listings WHERE first_seen_at IS NULL OR first_seen_at::DATE >= DATE '{TODAY}' - 30")
def cutoff_filter(spark, d):
    day = F.to_date("first_seen_at")
    return table(spark, d, "listings").where(dates.within_cutoff(day, today(), 30)).select("id", day.cast("string").alias("day"))


@query("SELECT id, (coalesce(trim(title_ko), '') = '' AND coalesce(trim(body_ko), '') = '' AND coalesce(trim(price_raw_ko), '') = '') AS rejected FROM listings")
def required_fields(spark, d):
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    return table(spark, d, "listings").select("id", (blank("title_ko") & blank("body_ko") & blank("price_raw_ko")).alias("rejected"))


# ---------------------------------------------------------------- urls and texts


@query("SELECT id, regexp_extract(url, '^([^?#]*)', 1) || CASE WHEN q = '' THEN '' ELSE '?' || q END || regexp_extract(url, '(#.*)$', 1) AS canonical FROM (SELECT id, url, array_to_string(list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda x: x <> '' AND split_part(x, '=', 1) <> 'page'), '&') AS q FROM scraped_pages)")
def url_canonicalize(spark, d):
    return table(spark, d, "scraped_pages").select("id", urls.without_parameter(F.col("url"), "page").alias("canonical"))


@query("SELECT id, regexp_extract(url, '[?&]page=([^&#]*)', 1) AS page, regexp_extract(url, '([^/?#]*)([?#].*)?$', 1) AS tail FROM scraped_pages")
def url_params(spark, d):
    return table(spark, d, "scraped_pages").select("id", urls.parameter(F.col("url"), "page").alias("page"), urls.path_tail(F.col("url")).alias("tail"))


@query("SELECT s.id, p.page, s.base_url || '?page=' || p.page AS url FROM sources s, range(1, 21) p(page) WHERE s.is_active")
def url_build_page(spark, d):
    s = table(spark, d, "sources").where("is_active").select("id", "base_url", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(20).cast("long"))).alias("page"))
    return s.select("id", "page", urls.page_url(F.col("base_url"), F.col("page")).alias("url"))


@query("SELECT id, rtrim(base_url, '/') || '/' || name AS url FROM sources")
def full_url(spark, d):
    return table(spark, d, "sources").select("id", urls.full_url(F.col("base_url"), F.concat(F.lit("/"), F.col("name"))).alias("url"))


@query("SELECT id, coalesce(regexp_extract(title_ko, '^\\s*\\[\\s*([^\\]]+?)\\s*\\]', 1), '') AS bracket FROM listings")
def title_bracket(spark, d):
    return table(spark, d, "listings").select("id", text.title_bracket(F.col("title_ko")).alias("bracket"))


LINES = "list_transform(regexp_split_to_array({0}, '\\r\\n|[\\n\\r\\x0B\\f\\x1C\\x1D\\x1E\\x{{85}}\\x{{2028}}\\x{{2029}}]'), lambda x: regexp_replace(x, '^[\\s\\x0B]+|[\\s\\x0B]+$', '', 'g'))"


@query(f"SELECT doc_id, coalesce(list_filter({LINES.format('text')}, lambda x: x <> '')[1], '') AS line FROM documents")
def first_line(spark, d):
    return table(spark, d, "documents").select("doc_id", text.first_line(F.col("text")).alias("line"))


@query(f"SELECT doc_id, coalesce(list_transform(list_filter({LINES.format('text')}, lambda x: starts_with(x, 'Utilities:') OR starts_with(x, '* 학군:')), lambda x: trim(split_part(x, ':', 2)))[1], '') AS value FROM documents")
def labelled_field(spark, d):
    return table(spark, d, "documents").select("doc_id", text.labelled_field(F.col("text"), ["Utilities", "* 학군"]).alias("value"))


@query("""
SELECT id, CASE WHEN coalesce(city, '') <> '' THEN city WHEN b <> '' AND h <> '' THEN CASE WHEN contains(h, b) THEN h ELSE b || ' ' || h END WHEN h <> '' THEN h ELSE b END AS place FROM (
  SELECT id, city, coalesce(regexp_extract(title_ko, '^\\s*\\[\\s*([^\\]]+?)\\s*\\]', 1), '') AS b, coalesce(list_filter(%s, lambda x: x <> '')[1], '') AS h FROM listings)""" % LINES.format("body_ko"))
def infer_location(spark, d):
    return table(spark, d, "listings").select("id", text.infer_location(F.col("title_ko"), F.col("body_ko"), F.col("city")).alias("place"))


@query("SELECT id, nullif(regexp_extract(b, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', 0), '') AS email, coalesce(nullif(regexp_extract(b, '\\d{3}-\\d{3}-\\d{4}', 0), ''), nullif(regexp_extract(b, '\\(\\d{3}\\)\\s*\\d{3}-\\d{4}', 0), ''), nullif(regexp_extract(b, '\\d{3}\\.\\d{3}\\.\\d{4}', 0), ''), nullif(regexp_extract(b, '\\d{10,11}', 0), '')) AS phone, coalesce(nullif(regexp_extract(b, '(카카오|kakao)[:\\s]*([A-Za-z0-9_-]+)', 2, 'i'), ''), nullif(regexp_extract(b, '(카톡|katok)[:\\s]*([A-Za-z0-9_-]+)', 2, 'i'), '')) AS messenger FROM (SELECT id, contact_block AS b FROM listings_staging)")
def normalize_contact(spark, d):
    b = F.col("contact_block")
    return table(spark, d, "listings_staging").select("id", contact.email(b).alias("email"), contact.phone(b).alias("phone"), contact.messenger(b).alias("messenger"))


def _category_sql(expr: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({expr}, '{'|'.join(w)}') THEN '{c}'" for c, w in classify.KEYWORDS.items()) + f" ELSE '{classify.OTHER}' END"


BOTH = "lower(coalesce(title_ko, '') || ' ' || coalesce(body_ko, ''))"


@query(f"SELECT id, {_category_sql(BOTH)} AS category FROM listings")
def classify_listings(spark, d):
    return table(spark, d, "listings").select("id", classify.category(F.col("title_ko"), F.col("body_ko")).alias("category"))


@query(f"SELECT source_id, {_category_sql(BOTH)} AS category, count(*)::BIGINT AS n FROM listings GROUP BY ALL")
def classify_counts(spark, d):
    return table(spark, d, "listings").select("source_id", classify.category(F.col("title_ko"), F.col("body_ko")).alias("category")).groupBy("source_id", "category").agg(F.count(F.lit(1)).alias("n"))


AMOUNT = "list_filter(list_transform(regexp_extract_all({0}, '{1}', 1), lambda x: try_cast(replace(x, ',', '') AS DECIMAL(18,2))), lambda x: x IS NOT NULL)"


@query("""
SELECT id, CASE WHEN len(v) > 1 THEN list_min(v) WHEN len(v) = 1 AND lease <> 'jeonse' THEN v[1] END::DOUBLE AS rent_usd, CASE WHEN len(v) > 1 THEN list_max(v) WHEN len(v) = 1 AND lease = 'jeonse' THEN v[1] END::DOUBLE AS deposit_usd,
  CASE WHEN ok THEN lease END AS lease_type, CASE WHEN ok THEN CASE WHEN won THEN 'KRW' ELSE 'USD' END END AS currency_raw FROM (
  SELECT id, ok, lease, won, CASE WHEN ok THEN CASE WHEN won THEN list_transform(krw, lambda x: round(x * 0.00075::DECIMAL(8,5), 2)::DECIMAL(18,2)) ELSE usd END ELSE [] END AS v FROM (
    SELECT *, len(usd) = 0 AND len(krw) > 0 AS won FROM (
      SELECT id, coalesce(trim(p), '') <> '' AS ok, %s AS usd, list_concat(%s, %s) AS krw,
        CASE WHEN contains(p, '전세') THEN 'jeonse' WHEN regexp_matches(lower(p), '단기|서브렛|sublet') THEN 'short_term' WHEN regexp_matches(lower(p), '리스|lease') THEN 'lease' ELSE 'monthly' END AS lease
      FROM (SELECT id, price_raw_ko AS p FROM listings))))""" % (AMOUNT.format("p", "\\$\\s*([\\d,]+)"), AMOUNT.format("p", "₩\\s*([\\d,]+)"), AMOUNT.format("p", "([\\d,]+)\\s*원")))
def normalize_price(spark, d):
    p = price.normalized(F.col("price_raw_ko"))
    return table(spark, d, "listings").select("id", p["rent_usd"].cast("double").alias("rent_usd"), p["deposit_usd"].cast("double").alias("deposit_usd"), p["lease_type"].alias("lease_type"), p["currency_raw"].alias("currency_raw"))


def _ymd(y: str, m: str, dd: str) -> str:
    return f"try_strptime({y} || '-' || {m} || '-' || {dd}, '%Y-%m-%d')::DATE"


def _rx(p: str, g: int) -> str:
    return f"regexp_extract(t, '{p}', {g})"


K, I, S, U = r"^(\d{4})년\s*(\d{1,2})월\s*(\d{1,2})일", r"^(\d{4})-(\d{2})-(\d{2})", r"^(\d{2})-(\d{2})", r"^(\d{1,2})/(\d{1,2})/(\d{4})"


POSTED = f"""CASE WHEN lower(t) IN ('오늘', 'today') THEN TIMESTAMP '{NOW}' WHEN lower(t) IN ('어제', 'yesterday') THEN TIMESTAMP '{NOW}' - INTERVAL 1 DAY WHEN regexp_matches(lower(t), '방금|just now') THEN TIMESTAMP '{NOW}'
  WHEN regexp_matches(t, '{K}') THEN {_ymd(_rx(K, 1), _rx(K, 2), _rx(K, 3))} WHEN regexp_matches(t, '{I}') THEN {_ymd(_rx(I, 1), _rx(I, 2), _rx(I, 3))}
  WHEN regexp_matches(t, '{S}') THEN {_ymd("'2026'", _rx(S, 1), _rx(S, 2))} WHEN regexp_matches(t, '{U}') THEN {_ymd(_rx(U, 3), _rx(U, 1), _rx(U, 2))} END"""


@query(f"SELECT id, epoch({POSTED}::TIMESTAMP)::BIGINT AS posted FROM (SELECT id, trim(posted_at_utc) AS t FROM listings)")
def normalize_date(spark, d):
    return table(spark, d, "listings").select("id", F.unix_seconds(dates.posted_at(F.col("posted_at_utc"), now())).alias("posted"))


def _dated(kind: str, sep: str) -> str:
    """The patterns of list dates with one separator."""
    q = r"\s*" + sep + r"\s*"
    return {"full": rf"^(\d{{4}}){q}(\d{{1,2}}){q}(\d{{1,2}})", "short_year": rf"^(\d{{1,2}}){q}(\d{{1,2}}){q}(\d{{2}})(\s|$)", "short": rf"^(\d{{1,2}}){q}(\d{{1,2}})(\s|$)"}[kind]


LK = r"^(\d{1,2})\s*월\s*(\d{1,2})\s*일"
SEPS = ["-", r"\.", "/"]


def _past(p: str) -> str:
    this, last = _ymd("'2026'", _rx(p, 1), _rx(p, 2)), _ymd("'2025'", _rx(p, 1), _rx(p, 2))
    return f"CASE WHEN regexp_matches(t, '{p}') THEN CASE WHEN {this} > DATE '{TODAY}' THEN {last} ELSE {this} END END"


@query(f"""
SELECT id, coalesce({", ".join(f"CASE WHEN regexp_matches(t, '{p}') THEN {_ymd(_rx(p, 1), _rx(p, 2), _rx(p, 3))} END" for p in (_dated("full", x) for x in SEPS))},
  {", ".join("CASE WHEN regexp_matches(t, '" + p + "') THEN " + _ymd("'20' || " + _rx(p, 3), _rx(p, 1), _rx(p, 2)) + " END" for p in (_dated("short_year", x) for x in SEPS))},
  {", ".join(_past(_dated("short", x)) for x in SEPS)}, {_past(LK)}, CASE WHEN regexp_matches(t, '^\\d{{1,2}}:\\d{{2}}(:\\d{{2}})?$') OR regexp_matches(t, '방금|오늘') THEN DATE '{TODAY}' END, CASE WHEN contains(t, '어제') THEN DATE '{TODAY}' - 1 END,
  CASE WHEN regexp_matches(t, '\\d+\\s*(분|시간)\\s*전') THEN DATE '{TODAY}' END, CASE WHEN regexp_matches(t, '\\d+\\s*일\\s*전') THEN DATE '{TODAY}' - regexp_extract(t, '(\\d+)\\s*일\\s*전', 1)::INTEGER END)::VARCHAR AS day
FROM (SELECT id, trim(raw_posted_at) AS t FROM listings_staging)""")
def list_date(spark, d):
    return table(spark, d, "listings_staging").select("id", dates.list_date(F.col("raw_posted_at"), today()).cast("string").alias("day"))


def _contains_chain(expr: str, pairs: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN contains({expr}, '{a}') THEN '{b}'" for a, b in pairs) + " END"


US = _contains_chain("lower(t)", [(w, w.title()) for w in location.ordered(location.US_CITIES)])
KR = _contains_chain("t", [(w, w) for w in location.ordered(location.KR_CITIES)])
ST = _contains_chain("lower(t)", list(location.STATES.items()))


@query(f"""
SELECT id, CASE WHEN ok THEN coalesce(us, kr, CASE WHEN length(t) > 50 THEN substr(t, 1, 50) || '...' ELSE t END) END AS city, CASE WHEN ok AND NOT (us IS NULL AND kr IS NOT NULL) THEN st END AS state_or_province,
  CASE WHEN ok THEN CASE WHEN us IS NULL AND kr IS NOT NULL THEN 'KR' ELSE 'US' END END AS country
FROM (SELECT id, t, coalesce(trim(t), '') <> '' AS ok, {US} AS us, {KR} AS kr, {ST} AS st FROM (SELECT id, address_raw AS t FROM listings))""")
def normalize_location(spark, d):
    n = location.normalized(F.col("address_raw"))
    return table(spark, d, "listings").select("id", *[v.alias(k) for k, v in n.items()])


@query("SELECT id FROM listings WHERE contains(coalesce(title_ko, '') || ' ' || coalesce(body_ko, '') || ' ' || coalesce(address_raw, ''), '테라스')")
def text_search(spark, d):
    return table(spark, d, "listings").where(text.searchable("title_ko", "body_ko", "address_raw").contains("테라스")).select("id")


MARKS = " OR ".join(f"contains(lower(coalesce(html_content, '')), '{m}')" for m in page_source.CHALLENGES)


@query(f"SELECT id, (http_status IN (403, 429) OR {MARKS}) AS banned FROM scraped_pages")
def ban_predicate(spark, d):
    return table(spark, d, "scraped_pages").select("id", page_source.banned(F.col("http_status"), F.col("html_content")).alias("banned"))


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def history_json(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


# ---------------------------------------------------------------- merges


MERGE_KEEP = ["id", "url", "currency_raw", "first_seen_at"]
NEW = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id, source_listing_id ORDER BY batch_no DESC, id DESC) AS k FROM listings_staging) WHERE k = 1"
OLD = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id, source_listing_id ORDER BY id) AS k FROM listings) WHERE k = 1"


@query(f"""
SELECT coalesce(o.source_id, n.source_id) AS source_id, coalesce(o.source_listing_id, n.source_listing_id) AS source_listing_id, coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NULL THEN n.url ELSE o.url END AS url,
  CASE WHEN o.id IS NULL THEN n.currency_raw ELSE o.currency_raw END AS currency_raw, CASE WHEN n.id IS NULL THEN o.title_ko ELSE n.title_ko END AS title_ko, CASE WHEN n.id IS NULL THEN o.rent_monthly_usd ELSE n.rent_monthly_usd END::DOUBLE AS rent,
  CASE WHEN n.id IS NULL THEN o.is_active ELSE true END AS is_active, CASE WHEN n.id IS NULL THEN epoch(o.last_seen_at) ELSE epoch(TIMESTAMPTZ '{NOW}+00') END::BIGINT AS last_seen, CASE WHEN o.id IS NULL THEN epoch(TIMESTAMPTZ '{NOW}+00') ELSE epoch(o.first_seen_at) END::BIGINT AS first_seen
FROM ({OLD}) o FULL JOIN ({NEW}) n ON o.source_id IS NOT DISTINCT FROM n.source_id AND o.source_listing_id IS NOT DISTINCT FROM n.source_listing_id""")
def listings_upsert(spark, d):
    columns = ["id", "source_id", "source_listing_id", "url", "currency_raw", "title_ko", "rent_monthly_usd", "is_active", "last_seen_at", "first_seen_at"]
    keys = ["source_id", "source_listing_id"]
    listed = table(spark, d, "listings").select(*columns).withColumn("_o", -F.col("id"))
    old = tables.last_writer(listed, keys, "_o").drop("_o")
    staged = table(spark, d, "listings_staging").select(*columns[:7], F.struct("batch_no", "id").alias("_o"))
    new = tables.last_writer(staged, keys, "_o").drop("_o")
    merged = tables.upsert(old, new, keys, MERGE_KEEP, {"is_active": F.lit(True), "last_seen_at": now(), "first_seen_at": now()})
    return merged.select("source_id", "source_listing_id", "id", "url", "currency_raw", "title_ko", F.col("rent_monthly_usd").cast("double").alias("rent"), "is_active", F.unix_seconds("last_seen_at").alias("last_seen"), F.unix_seconds("first_seen_at").alias("first_seen"))


@query("""
WITH u AS (SELECT *, row_number() OVER (PARTITION BY source_id, source_listing_id ORDER BY batch_no DESC, id DESC) AS k FROM listings_staging WHERE batch_no > 6), b AS (SELECT *, row_number() OVER (PARTITION BY source_id, source_listing_id ORDER BY batch_no DESC, id DESC) AS k FROM listings_staging WHERE batch_no <= 6)
SELECT coalesce(b.id, u.id) AS id, coalesce(b.source_id, u.source_id) AS source_id, coalesce(b.source_listing_id, u.source_listing_id) AS source_listing_id, CASE WHEN u.id IS NULL THEN b.content_hash ELSE u.content_hash END AS content_hash, CASE WHEN b.id IS NULL THEN u.url ELSE b.url END AS url
FROM (SELECT * FROM b WHERE k = 1) b FULL JOIN (SELECT * FROM u WHERE k = 1) u ON b.source_id IS NOT DISTINCT FROM u.source_id AND b.source_listing_id IS NOT DISTINCT FROM u.source_listing_id""")
def staging_upsert(spark, d):
    keys = ["source_id", "source_listing_id"]
    s = table(spark, d, "listings_staging").select("id", *keys, "content_hash", "url", "batch_no", F.struct("batch_no", "id").alias("_o"))
    old, new = (tables.last_writer(x, keys, "_o").drop("_o", "batch_no") for x in (s.where("batch_no <= 6"), s.where("batch_no > 6")))
    return tables.upsert(old, new, keys, ["id", "url"])


@query("SELECT s.id, c.canonical AS canonical_id FROM listings_staging s JOIN (SELECT source_id, source_listing_id, min(id) AS canonical FROM listings GROUP BY ALL) c ON s.source_id = c.source_id AND s.source_listing_id = c.source_listing_id")
def canonical_resolution(spark, d):
    keys = ["source_id", "source_listing_id"]
    c = table(spark, d, "listings").groupBy(*keys).agg(F.min("id").alias("canonical_id"))
    return table(spark, d, "listings_staging").select("id", *keys).join(c, keys).select("id", "canonical_id")


@query(f"SELECT s.id, CASE WHEN EXISTS (SELECT 1 FROM listings l WHERE l.source_id = s.source_id AND l.source_listing_id = s.source_listing_id) THEN epoch(TIMESTAMPTZ '{NOW}+00') ELSE epoch(s.loaded_at) END::BIGINT AS loaded FROM listings_staging s")
def mark_loaded(spark, d):
    keys = ["source_id", "source_listing_id"]
    done = table(spark, d, "listings").select(*keys).distinct().withColumn("_hit", F.lit(True))
    marked = tables.update_where(table(spark, d, "listings_staging").select("id", *keys, "loaded_at").join(done, keys, "left"), F.col("_hit"), {"loaded_at": now()})
    return marked.select("id", F.unix_seconds("loaded_at").alias("loaded"))


@query(f"SELECT id, CASE WHEN is_active AND last_seen_at < TIMESTAMPTZ '{NOW}+00' - INTERVAL 14 DAY THEN false ELSE is_active END AS is_active FROM listings")
def mark_stale(spark, d):
    rows = table(spark, d, "listings").select("id", "is_active", "last_seen_at")
    return tables.update_where(rows, F.col("is_active") & (F.col("last_seen_at") < now() - F.expr("INTERVAL 14 DAYS")), {"is_active": F.lit(False)}).select("id", "is_active")


@query(f"SELECT id, url FROM scraped_pages WHERE NOT coalesce(fetched_at < TIMESTAMPTZ '{NOW}+00' - INTERVAL 90 DAY, false)")
def purge_old(spark, d):
    return tables.delete_where(table(spark, d, "scraped_pages").select("id", "url", "fetched_at"), F.col("fetched_at") < now() - F.expr("INTERVAL 90 DAYS")).select("id", "url")


# ---------------------------------------------------------------- duplicates


@query("SELECT sha256(text) AS hash, min(doc_id) AS canonical, count(*)::BIGINT AS n FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def exact_dup_groups(spark, d):
    h = table(spark, d, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("hash"))
    return h.groupBy("hash").agg(F.min("doc_id").alias("canonical"), F.count(F.lit(1)).alias("n")).where("n > 1")


@query()
def token_set_dedup(spark, d):
    s = table(spark, d, "listings_staging").select("id", "title_ko", "rent_monthly_usd", "city", "posted_at_utc")
    words = F.concat_ws(" ", F.coalesce("title_ko", F.lit("")), F.coalesce(F.col("rent_monthly_usd").cast("string"), F.lit("")))
    return fuzzy.find_duplicates(s, F.col("id"), F.col("posted_at_utc"), F.col("city"), words)


# ---------------------------------------------------------------- audit and validation


@query("SELECT count(*)::BIGINT AS n FROM listings_staging s WHERE NOT EXISTS (SELECT 1 FROM sources x WHERE x.id = s.source_id)")
def fk_integrity(spark, d):
    s = table(spark, d, "sources").select(F.col("id").alias("source_id"))
    return relational.unmatched(table(spark, d, "listings_staging"), s, ["source_id"]).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT source_id, count(*)::BIGINT AS n, count_if(title_ko IS NULL)::BIGINT AS title_nulls, count_if(city IS NULL)::BIGINT AS city_nulls, count_if(rent_monthly_usd IS NULL)::BIGINT AS rent_nulls FROM listings GROUP BY source_id")
def null_counts(spark, d):
    c = lambda x: F.count_if(F.col(x).isNull())
    return table(spark, d, "listings").groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), c("title_ko").alias("title_nulls"), c("city").alias("city_nulls"), c("rent_monthly_usd").alias("rent_nulls"))


@query("SELECT id, source_name, round(avg(rows_transformed) OVER (PARTITION BY source_name ORDER BY id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS average FROM etl_runs")
def rolling_avg5(spark, d):
    r = table(spark, d, "etl_runs").select("id", "source_name", "rows_transformed")
    return relational.rolling_average(r, ["source_name"], "id", "rows_transformed").select("id", "source_name", F.round("average", 6).alias("average"))


@query("SELECT source_name, round(sum(rows_transformed) / nullif(sum(rows_transformed) + sum(rows_failed), 0), 6) AS rate FROM etl_runs GROUP BY source_name")
def success_rate(spark, d):
    g = table(spark, d, "etl_runs").groupBy("source_name").agg(F.sum("rows_transformed").alias("g"), F.sum("rows_failed").alias("b"))
    return g.select("source_name", F.round(F.try_divide(F.col("g"), F.col("g") + F.col("b")), 6).alias("rate"))


@query("""
SELECT 'null_rate' AS "check", coalesce(v <= 0.2, true) AS passed, true AS hard, round(v, 6) AS value FROM (SELECT greatest(count_if(city IS NULL), count_if(title_ko IS NULL)) / nullif(count(*), 0) AS v FROM listings_staging) UNION ALL
SELECT 'fk_integrity', n = 0, true, n::DOUBLE FROM (SELECT count(*) AS n FROM listings_staging s WHERE NOT EXISTS (SELECT 1 FROM sources x WHERE x.id = s.source_id)) UNION ALL
SELECT 'success_rate', coalesce(v >= 0.1, true), true, round(v, 6) FROM (SELECT sum(rows_transformed) / nullif(sum(rows_transformed) + sum(rows_failed), 0) AS v FROM etl_runs) UNION ALL
SELECT 'parsed_rows', coalesce(v >= 0.5, true), false, round(v, 6) FROM (SELECT max_by(rows_transformed, id) / nullif(max_by(average, id), 0) AS v FROM (SELECT id, rows_transformed, avg(rows_transformed) OVER (PARTITION BY source_name ORDER BY id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS average FROM etl_runs))""")
def validation_report(spark, d):
    s, runs = table(spark, d, "listings_staging"), table(spark, d, "etl_runs")
    known = table(spark, d, "sources").select(F.col("id").alias("source_id"))
    rolled = relational.rolling_average(runs.select("id", "source_name", "rows_transformed"), ["source_name"], "id", "rows_transformed")
    last = rolled.agg(F.max_by("rows_transformed", "id").alias("r"), F.max_by("average", "id").alias("a"))
    return validate.report(validate.null_rate(s, ["city", "title_ko"]), validate.orphans(s, known, ["source_id"]), validate.success_rate(runs, "rows_transformed", "rows_failed"), validate.row_count(last, F.col("r"), F.col("a")))


@query("SELECT id, run_id, status FROM (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY started_at DESC, id DESC) AS k FROM etl_runs) WHERE k <= 10")
def last_n_runs(spark, d):
    r = table(spark, d, "etl_runs").select("id", "run_id", "status", "source_name", "started_at")
    return relational.top_per_key(r, ["source_name"], 10, F.desc("started_at"), F.desc("id")).select("id", "run_id", "status")


@query("SELECT run_id, task_id, max(id) AS id FROM etl_runs GROUP BY run_id, task_id")
def run_resolution(spark, d):
    return table(spark, d, "etl_runs").groupBy("run_id", "task_id").agg(F.max("id").alias("id"))


@query(f"SELECT id, (epoch(coalesce(finished_at, TIMESTAMPTZ '{NOW}+00')) - epoch(started_at))::BIGINT AS seconds FROM etl_runs")
def audit_duration(spark, d):
    return table(spark, d, "etl_runs").select("id", (F.unix_seconds(F.coalesce("finished_at", now())) - F.unix_seconds("started_at")).alias("seconds"))


# a run answers for what is fetched in the twelve hours after its start, or until it ends
@query("SELECT p.id, r.id AS run FROM scraped_pages p JOIN sources x ON x.id = p.source_id JOIN etl_runs r ON r.source_name = x.name AND p.fetched_at BETWEEN r.started_at AND greatest(coalesce(r.finished_at, r.started_at), r.started_at + INTERVAL 12 HOUR)")
def rows_of_run(spark, d):
    names = table(spark, d, "sources").select(F.col("id").alias("source_id"), F.col("name").alias("source_name"))
    p = table(spark, d, "scraped_pages").select("id", "source_id", "fetched_at").join(names, "source_id")
    runs = table(spark, d, "etl_runs").select(F.col("id").alias("run"), "source_name", "started_at", F.greatest(F.coalesce("finished_at", "started_at"), F.col("started_at") + F.expr("INTERVAL 12 HOURS")).alias("ended"))
    return audit.in_interval(p, "fetched_at", runs, "started_at", "ended", ["source_name"]).select("id", "run")


@query("""
SELECT l.id, CASE WHEN c.lat IS NOT NULL THEN c.lat END AS lat, c.lon FROM (SELECT id, 'geocode:' || substr(sha256(trim(coalesce(address_raw, '') || ', ' || coalesce(city, ''), ', ')), 1, 16) AS key FROM listings) l
LEFT JOIN (SELECT key, max_by(lat, id) AS lat, max_by(lon, id) AS lon FROM (SELECT id, lat, lon, 'geocode:' || substr(sha256(trim(coalesce(address_raw, '') || ', ' || coalesce(city, ''), ', ')), 1, 16) AS key FROM listings_staging WHERE lat IS NOT NULL AND lon IS NOT NULL) GROUP BY key) c ON l.key = c.key""")
def geocode_cache_join(spark, d):
    key = cache.cache_key(cache.query_text(F.col("address_raw"), F.col("city")))
    known = table(spark, d, "listings_staging").where("lat is not null and lon is not null").select(key.alias("key"), "id", "lat", "lon").groupBy("key").agg(F.max_by("lat", "id").alias("lat"), F.max_by("lon", "id").alias("lon"))
    return table(spark, d, "listings").select("id", key.alias("key")).join(known, "key", "left").select("id", "lat", "lon")


# ---------------------------------------------------------------- pages and streams


@query("SELECT id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_extract(html_content, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&nbsp;', ' '), '&amp;', '&'), '\\s+', ' ', 'g')) AS title FROM scraped_pages WHERE http_status = 200 AND html_content IS NOT NULL")
def page_title(spark, d):
    p = table(spark, d, "scraped_pages").where("http_status = 200 and html_content is not null").select("id", "url", "html_content")
    layout = boards.Layout(title=("title",), body=("body",))
    boards.REGISTRY.setdefault("title", layout)
    return boards.parse_details(spread(p), "title").select("id", F.col("title_ko").alias("title"))


@query()
def page_parse(spark, d):
    p = table(spark, d, "scraped_pages").where("http_status = 200").select("id", "url", "html_content")
    return boards.parse_details(spread(p), "default").select("id", "title_ko", "body_ko", "raw_price", "raw_location", "raw_posted_at", "source_listing_id", "error")


@query("SELECT DISTINCT source_id, url FROM scraped_pages")
def seen_url_stream(spark, d):
    return seen.run(seen.first_sightings(seen.read_table(spark, d, "scraped_pages"), ["source_id", "url"]), "seen")


@query("SELECT event_type AS source, user_id::VARCHAR AS url FROM events GROUP BY ALL")
def new_url_state_stream(spark, d):
    return seen.mark_after_sink(seen.read_table(spark, d, "events"), "event_type", "user_id", "ts", seen.SeenSet(spark))


@query(f"SELECT id, url FROM scraped_pages WHERE fetched_at IS NULL OR fetched_at::DATE >= DATE '{TODAY}' - 90")
def late_gate_stream(spark, d):
    s = seen.read_table(spark, d, "scraped_pages")
    return seen.run(seen.admitted(s, F.to_date("fetched_at"), today(), 90).select("id", "url"), "gate")


# ---------------------------------------------------------------- the transform, load and audit path


FIRST = lambda text_, patterns: "coalesce(" + ", ".join(f"nullif(regexp_extract({text_}, '{p}', {g}{', ' + chr(39) + 'i' + chr(39) if i else ''}), '')" for p, g, i in patterns) + ")"
PHONE_SQL = [("\\d{3}-\\d{3}-\\d{4}", 0, 0), ("\\(\\d{3}\\)\\s*\\d{3}-\\d{4}", 0, 0), ("\\d{3}\\.\\d{3}\\.\\d{4}", 0, 0), ("\\d{10,11}", 0, 0)]
KAKAO_SQL = [("(카카오|kakao)[:\\s]*([A-Za-z0-9_-]+)", 2, 1), ("(카톡|katok)[:\\s]*([A-Za-z0-9_-]+)", 2, 1)]
AMOUNTS_OF = lambda p: AMOUNT.format("raw_price", p)


@query(f"""
SELECT id, source_id, source_listing_id, CASE WHEN len(v) > 1 THEN list_min(v) WHEN len(v) = 1 AND lease <> 'jeonse' THEN v[1] END::DOUBLE AS rent, CASE WHEN len(v) > 1 THEN list_max(v) WHEN len(v) = 1 AND lease = 'jeonse' THEN v[1] END::DOUBLE AS deposit,
  CASE WHEN ok THEN lease END AS lease_type, CASE WHEN ok THEN CASE WHEN won THEN 'KRW' ELSE 'USD' END END AS currency_raw, epoch(({POSTED})::TIMESTAMP)::BIGINT AS posted, CASE WHEN lok THEN CASE WHEN us IS NULL AND kr IS NOT NULL THEN 'KR' ELSE 'US' END END AS country,
  CASE WHEN lok THEN coalesce(us, kr, CASE WHEN length(loc) > 50 THEN substr(loc, 1, 50) || '...' ELSE loc END) END AS city, phone, kakao_id, email, category, lon, lat, errors FROM (
  SELECT *, CASE WHEN ok THEN CASE WHEN won THEN list_transform(krw, lambda x: round(x * 0.00075::DECIMAL(8,5), 2)::DECIMAL(18,2)) ELSE usd END ELSE [] END AS v FROM (
    SELECT *, len(usd) = 0 AND len(krw) > 0 AS won FROM (
      SELECT id, source_id, source_listing_id, trim(raw_posted_at) AS t, raw_location AS loc, coalesce(trim(raw_location), '') <> '' AS lok, coalesce(trim(raw_price), '') <> '' AS ok, {AMOUNTS_OF("\\$\\s*([\\d,]+)")} AS usd,
        list_concat({AMOUNTS_OF("₩\\s*([\\d,]+)")}, {AMOUNTS_OF("([\\d,]+)\\s*원")}) AS krw, {US.replace("(t)", "(raw_location)")} AS us, {KR.replace("(t,", "(raw_location,")} AS kr,
        CASE WHEN contains(raw_price, '전세') THEN 'jeonse' WHEN regexp_matches(lower(raw_price), '단기|서브렛|sublet') THEN 'short_term' WHEN regexp_matches(lower(raw_price), '리스|lease') THEN 'lease' ELSE 'monthly' END AS lease,
        {FIRST("contact_block", PHONE_SQL)} AS phone, {FIRST("contact_block", KAKAO_SQL)} AS kakao_id, nullif(regexp_extract(contact_block, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}', 0), '') AS email,
        {_category_sql(BOTH)} AS category, CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lon END AS lon, CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lat END AS lat, '{{}}' AS errors
      FROM listings_staging)))""")
def staging_projection(spark, d):
    s = table(spark, d, "listings_staging").select("id", "source_id", "source_listing_id", "url", "content_hash", *pipeline.PARSED, "lat", "lon")
    # the projection keeps its own columns only: the id travels in the content hash
    rows = pipeline.project(s.withColumn("content_hash", F.col("id").cast("string")), now(), F.col("lat"), F.col("lon"))
    return rows.select(F.col("content_hash").cast("long").alias("id"), "source_id", "source_listing_id", F.col("rent_monthly_usd").cast("double").alias("rent"), F.col("deposit_usd").cast("double").alias("deposit"), "lease_type", "currency_raw", F.unix_seconds("posted_at_utc").alias("posted"), "country", "city", "phone", "kakao_id", "email", "category", F.col("geo_point.lon").alias("lon"), F.col("geo_point.lat").alias("lat"), "errors")


@query("SELECT id, source_id FROM listings_staging WHERE loaded_at IS NULL ORDER BY id LIMIT 500")
def unloaded_batch(spark, d):
    return load.unloaded(table(spark, d, "listings_staging").select("id", "source_id", "loaded_at")).select("id", "source_id")


@query("SELECT id FROM listings_staging WHERE loaded_at IS NULL AND source_id = 2")
def optional_filter(spark, d):
    return load.unloaded(table(spark, d, "listings_staging").select("id", "source_id", "loaded_at"), source_id=2, limit=None).select("id")


# every amount times 30000, so that some can't be held; every city doubled ten times, so that some are too long
REFUSED = "CASE WHEN source_listing_id IS NULL THEN 'null:source_listing_id' WHEN length(repeat(city, 10)) > 100 THEN 'length:city' WHEN rent_monthly_usd * 30000 >= 100000000 THEN 'overflow:rent_monthly_usd' WHEN NOT EXISTS (SELECT 1 FROM sources x WHERE x.id = s.source_id) THEN 'source' END"


def _judged(spark, d):
    s = table(spark, d, "listings_staging").select("id", "source_id", "source_listing_id", F.repeat("city", 10).alias("city"), (F.col("rent_monthly_usd").cast("decimal(12,2)") * 30000).alias("rent_monthly_usd"))
    return load.split(s, table(spark, d, "sources"))


@query(f"SELECT id, reason FROM (SELECT id, {REFUSED} AS reason FROM listings_staging s) WHERE reason IS NOT NULL")
def load_rejects(spark, d):
    return _judged(spark, d)[1].select("id", "reason")


@query(f"SELECT id FROM (SELECT id, {REFUSED} AS reason FROM listings_staging s) WHERE reason IS NULL")
def load_accepted(spark, d):
    return _judged(spark, d)[0].select("id")


GOOD = f"SELECT * FROM listings_staging s WHERE EXISTS (SELECT 1 FROM sources x WHERE x.id = s.source_id) AND source_listing_id IS NOT NULL AND length(coalesce(city, '')) <= 100 AND length(coalesce(phone, '')) <= 30 AND length(coalesce(email, '')) <= 100 AND length(coalesce(kakao_id, '')) <= 50"


@query(f"""
SELECT coalesce(o.source_id, n.source_id) AS source_id, coalesce(o.source_listing_id, n.source_listing_id) AS source_listing_id, coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NULL THEN o.title_ko ELSE n.title_ko END AS title_ko, CASE WHEN n.id IS NULL THEN o.city ELSE n.city END AS city,
  CASE WHEN n.id IS NULL THEN o.is_active ELSE true END AS is_active, epoch(CASE WHEN n.id IS NULL THEN o.updated_at ELSE TIMESTAMPTZ '{NOW}+00' END)::BIGINT AS updated, epoch(CASE WHEN o.id IS NULL THEN TIMESTAMPTZ '{NOW}+00' ELSE o.first_seen_at END)::BIGINT AS first_seen
FROM ({OLD}) o FULL JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id, source_listing_id ORDER BY id DESC) AS k FROM ({GOOD})) WHERE k = 1) n ON o.source_id IS NOT DISTINCT FROM n.source_id AND o.source_listing_id IS NOT DISTINCT FROM n.source_listing_id""")
def load_snapshot(spark, d):
    serving = table(spark, d, "listings").withColumn("posted_at_utc", F.lit(None).cast("timestamp")).withColumn("_o", -F.col("id"))
    old = tables.last_writer(serving, load.KEYS, "_o").drop("_o")
    merged = load.load(old, table(spark, d, "listings_staging").drop("duplicate_of"), table(spark, d, "sources"), now())[0]
    return merged.select("source_id", "source_listing_id", "id", "title_ko", "city", "is_active", F.unix_seconds("updated_at").alias("updated"), F.unix_seconds("first_seen_at").alias("first_seen"))


@query("SELECT s.id FROM listings_staging s WHERE EXISTS (SELECT 1 FROM listings l WHERE l.source_id = s.source_id AND l.source_listing_id = s.source_listing_id)")
def semi_join_keys(spark, d):
    keys = ["source_id", "source_listing_id"]
    return table(spark, d, "listings_staging").select("id", *keys).join(table(spark, d, "listings").select(*keys).distinct(), keys, "left_semi").select("id")


@query("""
WITH batch AS (SELECT -id AS id, source_id, source_listing_id, city FROM listings_staging), first AS (SELECT city, max(id) AS canonical FROM batch GROUP BY city)
SELECT b.id, (SELECT min(s.id) FROM listings_staging s JOIN batch c ON c.source_id = s.source_id AND c.source_listing_id = s.source_listing_id WHERE c.id = f.canonical) AS canonical_id FROM batch b JOIN first f USING (city) WHERE b.id <> f.canonical""")
def synthetic_canonical(spark, d):
    s = table(spark, d, "listings_staging").select("id", "source_id", "source_listing_id", "city")
    batch = s.withColumn("id", -F.col("id"))
    first = batch.where("city is not null").groupBy("city").agg(F.max("id").alias("canonical_id"))
    return pipeline.canonical_ids(batch, batch.join(first, "city").where("id <> canonical_id"), s)


@query("SELECT s.id, coalesce(c.canonical, s.canonical_id) AS canonical_id FROM listings_staging s LEFT JOIN (SELECT source_id, source_listing_id, min(id) AS canonical FROM listings GROUP BY ALL) c ON s.source_id = c.source_id AND s.source_listing_id = c.source_listing_id")
def set_canonical(spark, d):
    keys = ["source_id", "source_listing_id"]
    ids = table(spark, d, "listings").groupBy(*keys).agg(F.min("id").alias("canonical_id"))
    return pipeline.set_canonical(table(spark, d, "listings_staging").select("id", *keys, "canonical_id"), ids).select("id", "canonical_id")


@query("SELECT count_if(is_duplicate)::BIGINT AS duplicates, count_if(coalesce(canonical_id < 0, false))::BIGINT AS in_batch FROM listings_staging")
def duplicate_counters(spark, d):
    return pipeline.duplicate_counts(table(spark, d, "listings_staging"))


CUT = "2025-06-01 00:00:00"


@query(f"""
SELECT count(*)::BIGINT AS extracted, count_if(fetched_at < TIMESTAMPTZ '{CUT}+00')::BIGINT AS stale, count_if(EXISTS (SELECT 1 FROM listings_staging s WHERE s.source_id = p.source_id AND s.url = p.url))::BIGINT AS seen, count_if(http_status IS DISTINCT FROM 200)::BIGINT AS failed FROM scraped_pages p""")
def run_counters(spark, d):
    p = table(spark, d, "scraped_pages").select("source_id", "url", "http_status", "fetched_at")
    return pipeline.counters(p, F.lit(CUT).cast("timestamp"), table(spark, d, "listings_staging").select("source_id", "url"))


@query("""
WITH b AS (SELECT id, source_id, source_listing_id FROM listings_staging WHERE batch_no = 12)
SELECT id, true AS in_batch FROM b UNION ALL SELECT s.id, false FROM listings_staging s WHERE batch_no BETWEEN 8 AND 11 AND loaded_at IS NULL AND NOT EXISTS (SELECT 1 FROM b WHERE b.source_id = s.source_id AND b.source_listing_id = s.source_listing_id)""")
def batch_union_recent(spark, d):
    s = table(spark, d, "listings_staging").select("id", "source_id", "source_listing_id", "title_ko", "body_ko", "batch_no", "loaded_at")
    recent = s.where("batch_no between 8 and 11 and loaded_at is null").select("id", "source_id", "source_listing_id", "title_ko")
    return pipeline.with_recent(s.where("batch_no = 12").drop("batch_no", "loaded_at"), recent).select("id", "in_batch")


def _events(spark, d) -> DataFrame:
    """The audit events that the runs of etl_runs would have left: a start, two increments, a finish where one is recorded."""
    r = table(spark, d, "etl_runs")
    c = list(audit.COUNTERS)
    none = lambda t: F.lit(None).cast(t)
    names = ["dag_id", "task_id", "run_id", "source_name"]
    long = lambda x: F.coalesce(x, F.lit(0)).cast("long").alias(x)
    start = r.select("id", F.lit("start").alias("event"), *names, F.lit("running").alias("status"), F.col("started_at").alias("at"), *[none("long").alias(x) for x in c], none("string").alias("error_message"))
    add = r.select("id", F.lit("add").alias("event"), *[none("string").alias(x) for x in names], none("string").alias("status"), F.col("started_at").alias("at"), *[long(x) for x in c], none("string").alias("error_message"))
    end = r.where("finished_at is not null").select("id", F.lit("finish").alias("event"), *[none("string").alias(x) for x in names], "status", F.col("finished_at").alias("at"), *[long(x) for x in c], "error_message")
    return start.unionByName(add).unionByName(add).unionByName(end)


@query("""
SELECT id, source_name, CASE WHEN finished_at IS NULL THEN 'running' ELSE status END AS status, (coalesce(rows_loaded, 0) * CASE WHEN finished_at IS NULL THEN 2 ELSE 1 END)::BIGINT AS rows_loaded, CASE WHEN finished_at IS NOT NULL THEN error_message END AS error_message, (epoch(finished_at)::BIGINT - epoch(started_at)::BIGINT) AS seconds FROM etl_runs""")
def audit_runs(spark, d):
    return audit.runs(_events(spark, d)).select("id", "source_name", "status", "rows_loaded", "error_message", F.col("duration_sec").alias("seconds"))


@query("SELECT id, 'scheduled__' || strftime(started_at AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S') || '+00:00' AS scheduled, 'cli_' || strftime(started_at AT TIME ZONE 'UTC', '%Y%m%d_%H%M%S') AS cli FROM etl_runs")
def run_ids(spark, d):
    return table(spark, d, "etl_runs").select("id", audit.run_id(F.col("started_at")).alias("scheduled"), audit.run_id(F.col("started_at"), "cli").alias("cli"))


@query("SELECT id FROM etl_runs WHERE id = 7 UNION ALL SELECT max(id) FROM etl_runs WHERE run_id = 'run_0_0000001' AND starts_with(task_id, 'load')")
def run_by_name(spark, d):
    r = table(spark, d, "etl_runs").select("id", "run_id", "task_id")
    return audit.resolve(r, "7").unionByName(audit.resolve(r, "run_0_0000001", "load"))


@query(f"""
SELECT 'stale' AS what, count_if(is_active AND last_seen_at < TIMESTAMPTZ '{NOW}+00' - INTERVAL 14 DAY)::BIGINT AS n FROM listings UNION ALL
SELECT 'purged', count_if(fetched_at < TIMESTAMPTZ '{NOW}+00' - INTERVAL 90 DAY)::BIGINT FROM scraped_pages""")
def cleanup_counts(spark, d):
    stale = load.counts(table(spark, d, "listings"), F.col("is_active") & (F.col("last_seen_at") < now() - F.expr("INTERVAL 14 DAYS")))
    purged = load.counts(table(spark, d, "scraped_pages"), F.col("fetched_at") < now() - F.expr("INTERVAL 90 DAYS"))
    return stale.select(F.lit("stale").alias("what"), "n").unionByName(purged.select(F.lit("purged").alias("what"), "n"))


@query(f"SELECT id, CASE WHEN is_active AND last_seen_at < TIMESTAMPTZ '{NOW}+00' - INTERVAL 14 DAY THEN epoch(TIMESTAMPTZ '{NOW}+00') ELSE epoch(updated_at) END::BIGINT AS updated FROM listings")
def mark_stale_updated(spark, d):
    rows = table(spark, d, "listings").select("id", "is_active", "last_seen_at", "updated_at")
    stale = F.col("is_active") & (F.col("last_seen_at") < now() - F.expr("INTERVAL 14 DAYS"))
    return tables.update_where(rows, stale, {"is_active": F.lit(False), "updated_at": now()}).select("id", F.unix_seconds("updated_at").alias("updated"))


@query("""
SELECT name, CASE name WHEN 'null_rate' THEN printf('%.2f%% of the values of the worst column are missing', v * 100) WHEN 'success_rate' THEN printf('%.1f%% of the rows were transformed', v * 100) ELSE printf('%.0f rows of unknown sources', v) END AS message FROM (
  SELECT 'null_rate' AS name, round(greatest(count_if(city IS NULL), count_if(title_ko IS NULL)) / nullif(count(*), 0), 6) AS v FROM listings_staging UNION ALL
  SELECT 'success_rate', round(sum(rows_transformed) / nullif(sum(rows_transformed) + sum(rows_failed), 0), 6) FROM etl_runs UNION ALL
  SELECT 'fk_integrity', count(*)::DOUBLE FROM listings_staging s WHERE NOT EXISTS (SELECT 1 FROM sources x WHERE x.id = s.source_id))""")
def validation_messages(spark, d):
    s, runs = table(spark, d, "listings_staging"), table(spark, d, "etl_runs")
    known = table(spark, d, "sources").select(F.col("id").alias("source_id"))
    checks = validate.report(validate.null_rate(s, ["city", "title_ko"]), validate.success_rate(runs, "rows_transformed", "rows_failed"), validate.orphans(s, known, ["source_id"]))
    return validate.with_messages(checks).select(F.col("check").alias("name"), "message")


@query("SELECT count_if(is_active)::BIGINT AS passed, count(*)::BIGINT AS total FROM sources")
def verification_summary(spark, d):
    return validate.summary(table(spark, d, "sources").select(F.col("is_active").alias("passed")))


@query("""
SELECT label, string_agg(name, ', ' ORDER BY name) AS names FROM (SELECT 'registered without runs' AS label, name FROM (SELECT name FROM sources EXCEPT SELECT source_name FROM etl_runs) UNION ALL
SELECT 'target without registration', name FROM (SELECT source AS name FROM mix_targets EXCEPT SELECT name FROM sources)) GROUP BY label""")
def registry_messages(spark, d):
    s, r, m = table(spark, d, "sources").select("name"), table(spark, d, "etl_runs").select("source_name").distinct(), table(spark, d, "mix_targets").select("source")
    found = relational.differences({"registered without runs": (s, r), "target without registration": (m, s)})
    return found.groupBy("label").agg(F.array_join(F.array_sort(F.collect_set("name")), ", ").alias("names"))


@query("SELECT source_id::VARCHAR AS source, count(DISTINCT url)::BIGINT AS n FROM scraped_pages WHERE url IS NOT NULL GROUP BY source_id")
def seen_set_count(spark, d):
    p = table(spark, d, "scraped_pages").select(F.col("source_id").alias("source"), "url")
    kept = seen.SeenSet(spark)
    kept.mark(p, 0)
    return kept.count(0)


# three runs: the second comes after the sets have died, the third while they live
RUNS = [("2025-01-01", "2024-12-01"), ("2025-06-05", "2025-05-01"), ("2025-06-15", "2025-05-20")]


@query("""
WITH r1 AS (SELECT DISTINCT source_id, url FROM scraped_pages WHERE fetched_at >= '2024-12-01 00:00:00+00' AND fetched_at < '2025-01-01 00:00:00+00'), r2 AS (SELECT DISTINCT source_id, url FROM scraped_pages WHERE fetched_at >= '2025-05-01 00:00:00+00' AND fetched_at < '2025-06-05 00:00:00+00'),
r3 AS (SELECT DISTINCT source_id, url FROM scraped_pages WHERE fetched_at >= '2025-05-20 00:00:00+00' AND fetched_at < '2025-06-15 00:00:00+00')
SELECT 0 AS run, source_id::VARCHAR AS source, url FROM r1 UNION ALL SELECT 1, source_id::VARCHAR, url FROM r2 UNION ALL SELECT 2, source_id::VARCHAR, url FROM (SELECT * FROM r3 EXCEPT SELECT * FROM r2)""")
def seen_set_expiry(spark, d):
    p = table(spark, d, "scraped_pages").select(F.col("source_id").alias("source"), "url", "fetched_at")
    kept, out = seen.SeenSet(spark, ttl=14 * 86400), None
    for k, (end, begin) in enumerate(RUNS):
        at = lambda x: F.lit(f"{x} 00:00:00").cast("timestamp")
        stamp = spark.range(1).select(F.unix_seconds(at(end))).first()[0]
        new = kept.mark(p.where((F.col("fetched_at") >= at(begin)) & (F.col("fetched_at") < at(end))), stamp).withColumn("run", F.lit(k))
        out = new if out is None else out.unionByName(new)
    return out


@query("SELECT id, coalesce(try_strptime(regexp_extract(posted_at_utc, '^(\\d{4}-\\d{2}-\\d{2})', 1), '%Y-%m-%d')::DATE, first_seen_at::DATE)::VARCHAR AS day FROM listings")
def resolved_date(spark, d):
    detail = F.try_to_timestamp(F.regexp_extract("posted_at_utc", r"^(\d{4}-\d{2}-\d{2})", 1), F.lit("yyyy-MM-dd")).cast("date")
    return table(spark, d, "listings").select("id", dates.resolved_date(detail, F.to_date("first_seen_at")).cast("string").alias("day"))


@query(f"""
SELECT id, CASE WHEN contains(p, '오늘') OR contains(lower(p), 'today') THEN '{TODAY}' WHEN contains(p, '어제') OR contains(lower(p), 'yesterday') THEN (DATE '{TODAY}' - 1)::DATE::VARCHAR WHEN contains(p, '방금') OR contains(lower(p), 'just now') THEN '{TODAY}T00:00:00+00:00'
  ELSE strftime(try_strptime(regexp_extract(p, '(\\d{{4}})년\\s*(\\d{{1,2}})월\\s*(\\d{{1,2}})일', 1) || '-' || regexp_extract(p, '(\\d{{4}})년\\s*(\\d{{1,2}})월\\s*(\\d{{1,2}})일', 2) || '-' || regexp_extract(p, '(\\d{{4}})년\\s*(\\d{{1,2}})월\\s*(\\d{{1,2}})일', 3), '%Y-%m-%d'), '%Y-%m-%dT%H:%M:%S+00:00') END AS day
FROM (SELECT id, posted_at_utc AS p FROM listings)""")
def legacy_date(spark, d):
    return table(spark, d, "listings").select("id", legacy.legacy_date(F.col("posted_at_utc"), now()).alias("day"))


@query("""
SELECT id, CASE WHEN p <> '' THEN CASE WHEN usd THEN n WHEN n > 10000 THEN n // 1200 ELSE n END END::BIGINT AS rent, CASE WHEN p <> '' THEN CASE WHEN contains(p, '월세') THEN 'monthly_rent' WHEN contains(p, '보증금') THEN 'deposit' WHEN contains(p, '전세') THEN 'jeonse'
  WHEN regexp_matches(lower(p), '단기|short') THEN 'short_term' WHEN regexp_matches(lower(p), '리스|lease') THEN 'lease' END END AS lease_type, CASE WHEN p <> '' AND n IS NOT NULL THEN CASE WHEN usd THEN 'USD' ELSE 'KRW' END END AS currency
FROM (SELECT id, price_raw_ko AS p, contains(price_raw_ko, '$') OR contains(lower(price_raw_ko), 'usd') AS usd, try_cast(replace(regexp_extract(price_raw_ko, '[0-9,]*[0-9][0-9,]*', 0), ',', '') AS BIGINT) AS n FROM listings)""")
def legacy_price(spark, d):
    p = legacy.legacy_price(F.col("price_raw_ko"))
    return table(spark, d, "listings").select("id", p["rent"].alias("rent"), p["lease_type"].alias("lease_type"), p["currency_raw"].alias("currency"))


@query("SELECT id, regexp_extract(url, '/rent/(\\w+)', 1) AS listing, CASE WHEN regexp_matches(url, '^https?://') THEN url ELSE 'https://x.example/' || ltrim(url, '/') END AS absolute FROM scraped_pages")
def url_ids(spark, d):
    return table(spark, d, "scraped_pages").select("id", F.regexp_extract("url", r"/rent/(\w+)", 1).alias("listing"), urls.absolute(F.col("url"), F.lit("https://x.example")).alias("absolute"))


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, (props IS NOT NULL) AS round_trip FROM events")
def json_round_trip(spark, d):
    read = F.from_json("props", "map<string,string>")
    again = F.from_json(F.to_json(read), "map<string,string>")
    return table(spark, d, "events").select("event_id", F.try_element_at(again, F.lit("k")).try_cast("bigint").alias("k"), (F.map_entries(again) == F.map_entries(read)).alias("round_trip"))


@query("SELECT id, CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lat END AS lat, CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lon END AS lon FROM listings_staging")
def cached_point(spark, d):
    p = cache.point(F.concat(F.col("lat").cast("string"), F.lit(","), F.col("lon").cast("string")))
    return table(spark, d, "listings_staging").select("id", p.alias("p")).select("id", F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon"))


@query("SELECT dag_id, run_id, status, epoch(started_at)::BIGINT AS started FROM etl_runs WHERE dag_id IS NOT NULL ORDER BY started_at DESC NULLS LAST, run_id, dag_id, status LIMIT 20")
def run_history(spark, d):
    path = scratch(spark, "runs")
    r = table(spark, d, "etl_runs").where("dag_id is not null")
    none = lambda t: F.lit(None).cast(t)
    history.append(r.select("dag_id", "run_id", "status", "started_at", "finished_at", none("string").alias("log_path"), none("array<struct<name:string,attempt:int,exit_code:int>>").alias("tasks")), path)
    return history.read(spark, path).orderBy(F.desc_nulls_last("started_at"), "run_id", "dag_id", "status").limit(20).select("dag_id", "run_id", "status", F.unix_seconds("started_at").alias("started"))


@query("""
SELECT a.id AS a, b.id AS b FROM listings_staging a JOIN listings_staging b ON lower(coalesce(a.city, '')) = lower(coalesce(b.city, '')) AND a.id < b.id AND abs(date_diff('day', a.posted_at_utc, b.posted_at_utc)) <= 7
WHERE trim(coalesce(a.title_ko, '')) <> '' AND list_sort(list_distinct(string_split(a.title_ko || ' ' || coalesce(a.rent_monthly_usd::VARCHAR, ''), ' '))) = list_sort(list_distinct(string_split(b.title_ko || ' ' || coalesce(b.rent_monthly_usd::VARCHAR, ''), ' ')))""")
def token_set_equal(spark, d):
    """The pairs of the fuzzy pass at threshold 1 whose token sets are equal: the part of the pass that SQL can state."""
    s = table(spark, d, "listings_staging").select("id", "title_ko", "rent_monthly_usd", F.lower(F.coalesce("city", F.lit(""))).alias("block"), F.to_date("posted_at_utc").alias("day")).where("day is not null and trim(coalesce(title_ko, '')) <> ''")
    words = F.concat_ws(" ", F.coalesce("title_ko", F.lit("")), F.coalesce(F.col("rent_monthly_usd").cast("string"), F.lit("")))
    keyed = s.withColumn("tokens", F.array_join(F.array_sort(F.array_distinct(F.filter(F.split(words, r"(?U)\s+"), lambda x: x != ""))), " "))
    return relational.window_pairs(keyed, ["block", "tokens"], "day", "id", 7, []).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))
