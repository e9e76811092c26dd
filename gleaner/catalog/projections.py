"""Row shaping over every customer, article and store row."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.catalog.base import art, entries, pick, query, s_squeeze, s_strip, sql_pick, sql_text, store, table
from gleaner.catalog.windows_and_sorts import POOL, POOL_ORDER, WITH_CANDIDATES, held_candidates
from gleaner.functions import text as T
from gleaner.operators import digest, selection, shaping

COUNTS = ["7", "", " 0 ", "-3", "abc", "40"]
ZONE_NAMES = ["Asia/Tokyo", "", " Europe/Paris ", "Mars/Base", "UTC"]
MODE_NAMES = [" Calendar_Day ", "", "ROLLING_24H"]


@query(
    "normalize_site_config",
    f"""WITH v AS (SELECT c_custkey AS id, c_name, c_mktsegment AS seg, {sql_pick('c_custkey', COUNTS)} AS n, {sql_pick('c_custkey', ZONE_NAMES)} AS tz, {sql_pick('c_custkey', MODE_NAMES)} AS m FROM customer),
    i AS (SELECT *, CASE WHEN regexp_matches(trim(n), '^[+-]?[0-9]+$') THEN CAST(trim(n) AS INTEGER) END AS k FROM v)
    SELECT c_name AS site_name, coalesce(k, 9999) AS display_order, greatest(1, coalesce(k, 20)) AS max_items_per_site, greatest(1, coalesce(k, 50)) AS max_items_total,
      24 AS lookback_hours, greatest(1, coalesce(k, 1)) AS max_pages, CASE WHEN trim(m) = '' THEN 'rolling_24h' ELSE lower(trim(m)) END AS target_date_mode, 'datetime' AS date_granularity,
      'direct' AS fetch_mode, 'require_date' AS date_fallback_mode, CASE WHEN trim(tz) IN ('Europe/Paris', 'UTC') THEN trim(tz) ELSE 'Asia/Tokyo' END AS date_timezone,
      'https://example.com/' || lower(seg) AS urls, '^/a' || seg AS article_url_pattern, id % 5 <> 0 AS enabled FROM i""",
)
def normalize_site_config(spark, sf_dir):
    k = F.col("c_custkey")
    n = pick(k, COUNTS)
    raw = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("  "), F.col("c_name"), F.lit("\n")).alias("site_name"),
        n.alias("display_order"),
        n.alias("max_items_per_site"),
        n.alias("max_items_total"),
        n.alias("max_pages"),
        pick(k, MODE_NAMES).alias("target_date_mode"),
        pick(k, ZONE_NAMES).alias("date_timezone"),
        F.concat(F.lit("see https://EXAMPLE.com/"), F.lower("c_mktsegment"), F.lit("/ ")).alias("list_page_urls"),
        F.concat(F.lit(" ^/a\n"), F.col("c_mktsegment")).alias("article_url_pattern"),
        F.when(k % 5 == 0, F.lit("false")).alias("enabled"),
    )
    out = shaping.normalize_site_config(raw)
    return out.select(
        "site_name", "display_order", "max_items_per_site", "max_items_total", "lookback_hours", "max_pages",
        "target_date_mode", "date_granularity", "fetch_mode", "date_fallback_mode", "date_timezone",
        F.array_join("list_page_urls", " ").alias("urls"), "article_url_pattern", "enabled",
    )


SOURCES = ["URL ", "bad", "rss", "Meta", None]
GRANS = ["date", "DateTime", "week", None]
LOOKBACKS = ["48", "0", "-1", "x", None]
NAMES = ["日刊鉄鋼新聞", "日刊産業新聞", "other"]


def _opt_pick(n, values):
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (n % len(values)).cast("int") + 1)


def _opt_sql(n, values):
    return "list_extract([" + ", ".join("NULL" if v is None else sql_text(v) for v in values) + f"], CAST({n} % {len(values)} AS INTEGER) + 1)"


@query(
    "normalize_date_rule",
    f"""WITH v AS (SELECT c_custkey AS id, {sql_pick('c_custkey', NAMES)} AS medium, {_opt_sql('c_custkey', SOURCES)} AS s, {_opt_sql('c_custkey', GRANS)} AS g,
      {_opt_sql('(c_custkey // 3)', LOOKBACKS)} AS l, CASE WHEN c_custkey % 2 = 0 THEN 'sometimes' END AS mode FROM customer),
    p AS (SELECT *, lower(trim(coalesce(s, CASE medium WHEN '日刊鉄鋼新聞' THEN 'article_html' WHEN '日刊産業新聞' THEN 'url' ELSE 'rss' END))) AS s2,
      lower(trim(coalesce(g, CASE medium WHEN '日刊産業新聞' THEN 'date' ELSE 'datetime' END))) AS g2,
      coalesce(mode, CASE medium WHEN '日刊産業新聞' THEN 'calendar_day' ELSE 'rolling_24h' END) AS m2 FROM v),
    q AS (SELECT *, CASE WHEN s2 IN ('rss', 'article_html', 'meta', 'json_ld', 'url') THEN s2 ELSE 'rss' END AS date_source_type,
      CASE WHEN g2 IN ('date', 'datetime') THEN g2 ELSE 'datetime' END AS date_granularity FROM p)
    SELECT id, medium, date_source_type, date_granularity, CASE WHEN m2 IN ('calendar_day', 'rolling_24h') THEN m2 WHEN date_granularity = 'date' THEN 'calendar_day' ELSE 'rolling_24h' END AS target_date_mode,
      CASE WHEN try_cast(l AS INTEGER) > 0 THEN try_cast(l AS INTEGER) ELSE 24 END AS lookback_hours, 'Asia/Tokyo' AS date_timezone,
      CASE medium WHEN '日刊鉄鋼新聞' THEN 'time.article-header__published' ELSE '' END AS date_css_selector FROM q""",
)
def normalize_date_rule(spark, sf_dir):
    k = F.col("c_custkey")
    raw = table(spark, sf_dir, "customer").select(
        k.alias("id"),
        pick(k, NAMES).alias("medium"),
        _opt_pick(k, SOURCES).alias("date_source_type"),
        _opt_pick(k, GRANS).alias("date_granularity"),
        _opt_pick(F.floor(k / 3), LOOKBACKS).alias("lookback_hours"),
        F.when(k % 2 == 0, F.lit("sometimes")).alias("target_date_mode"),
    )
    return shaping.normalize_date_rule(raw).select(
        "id", "medium", "date_source_type", "date_granularity", "target_date_mode", "lookback_hours", "date_timezone", "date_css_selector"
    )


@query(
    "build_media_row",
    f"""WITH v AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE ' ' || c_name END AS name, c_custkey % 4 <> 1 AS enabled,
      c_custkey % 3 <> 2 AS has_feed, {sql_pick('c_custkey', COUNTS)} AS n FROM customer),
    i AS (SELECT *, CASE WHEN regexp_matches(trim(n), '^[+-]?[0-9]+$') THEN CAST(trim(n) AS INTEGER) END AS k FROM v)
    SELECT trim(name) AS media_name, 'id' || id AS alert_ids, 'https://feeds.example.com/' || id AS feeds, coalesce(k, 999) AS display_order, coalesce(k, 20) AS max_items, 50 AS max_items_total
    FROM i WHERE trim(name) <> '' AND enabled AND has_feed""",
)
def build_media_row(spark, sf_dir):
    k = F.col("c_custkey")
    feed = F.concat(F.lit("https://feeds.example.com/"), k.cast("string"))
    raw = table(spark, sf_dir, "customer").select(
        F.when(k % 7 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" "), "c_name")).alias("media_name"),
        (k % 4 != 1).alias("enabled"),
        F.array(F.concat(F.lit(" id"), k.cast("string")), F.lit(" ")).alias("alert_ids"),
        F.when(k % 3 != 2, F.concat(feed, F.lit("\nnot a url\n"), feed)).otherwise(F.lit("nothing")).alias("alert_feeds"),
        pick(k, COUNTS).alias("display_order"),
        pick(k, COUNTS).alias("max_items"),
        F.lit(None).cast("string").alias("max_items_total"),
    )
    return shaping.build_media_rows(raw).select(
        "media_name", F.array_join("alert_ids", ",").alias("alert_ids"), F.array_join("alert_feeds", " ").alias("feeds"),
        "display_order", "max_items", "max_items_total",
    )


@query(
    "alias_coalesce",
    f"""WITH {{art}} SELECT article_id, coalesce(nullif({s_strip("CASE WHEN ord % 3 = 0 THEN ' ' ELSE title END")}, ''), nullif({s_strip('medium')}, ''), '') AS title,
      coalesce(CASE WHEN ord % 4 <> 0 THEN nullif({s_strip('title')}, '') END, 'Untitled Article - ' || regexp_extract(url, 'ng=(.*)', 1)) AS shown,
      CASE WHEN ord % 2 = 0 THEN coalesce(nullif({s_strip('body')}, ''), '') ELSE {s_strip('title')} END AS summary FROM art""",
)
def alias_coalesce(spark, sf_dir):
    o = F.col("ord")
    return art(spark, sf_dir).select(
        "article_id",
        T.first_present(F.when(o % 3 == 0, F.lit(" ")).otherwise(F.col("title")), "medium").alias("title"),
        shaping.ensure_title(F.when(o % 4 != 0, F.col("title")), F.lit(" "), url="url").alias("shown"),
        F.when(o % 2 == 0, T.first_present(F.lit(""), "body")).otherwise(T.first_present("title")).alias("summary"),
    )


@query(
    "typed_property_write",
    """WITH {art} SELECT article_id, left(body, 1900) AS body, left(title || body, 100) AS pick_one, CAST(ord AS DOUBLE) AS ord_number, NULL::DOUBLE AS bad_number,
      ord % 2 = 0 AS flag, CASE ord % 3 WHEN 0 THEN strftime(published, '%Y-%m-%d') WHEN 1 THEN strftime(published, '%Y-%m-%d') ELSE 'soon' END AS day,
      array_to_string([left(title || body, 100), medium], '|') AS tags, left(array_to_string([title || body, medium], '、'), 2000) AS tag_text FROM art""",
)
def typed_property_write(spark, sf_dir):
    o = F.col("ord")
    both = F.concat("title", "body")
    tags = F.array(both, F.lit(" "), F.col("medium"))
    raw = art(spark, sf_dir).select(
        "article_id", "body", both.alias("pick_one"), o.alias("ord_number"), F.col("medium").alias("bad_number"),
        (o % 2 == 0).alias("flag"),
        F.when(o % 3 == 0, F.date_format("published", "yyyyMMdd")).when(o % 3 == 1, F.date_format("published", "yyyy-MM-dd'T'HH:mm")).otherwise(F.lit("soon")).alias("day"),
        tags.alias("tags"), tags.alias("tag_text"), F.col("lang").alias("people"),
    )
    out, skipped = shaping.write_typed(
        raw,
        {"body": "rich_text", "pick_one": "select", "ord_number": "number", "bad_number": "number", "flag": "checkbox",
         "day": "date", "tags": "multi_select", "tag_text": "rich_text", "people": "people"},
    )
    assert skipped == ["people"]
    return out.withColumn("tags", F.array_join("tags", "|"))


@query(
    "split_scored_outputs",
    "WITH {art} SELECT article_id, title AS summary, medium AS reason_to_read, body AS business_implications, true AS processed, 'm1' AS model FROM art",
)
def split_scored_outputs(spark, sf_dir):
    rows = art(spark, sf_dir).select(
        "article_id", F.col("title").alias("summary"), F.col("medium").alias("reason_to_read"), F.col("body").alias("business_implications")
    )
    return shaping.enrichment_payload(rows, "m1")


@query(
    "ref_ids",
    f"""{WITH_CANDIDATES}, {POOL}, sel AS (SELECT * FROM pool ORDER BY {POOL_ORDER} LIMIT 5)
    SELECT 'A' || row_number() OVER (ORDER BY {POOL_ORDER}) AS ref_id, article_id, left(coalesce(nullif({s_strip('body')}, ''), {s_strip('sel.title')}), 1800) AS excerpt FROM sel JOIN (SELECT article_id, body FROM art) USING (article_id)""",
)
def ref_ids(spark, sf_dir):
    chosen = selection.select_from_pool(held_candidates(spark, sf_dir), include_ties=False)
    texts = art(spark, sf_dir).select("article_id", "body")
    rows = digest.report_input(chosen.join(texts, "article_id"), selection.pool_order(), ["body", "title"])
    return rows.select("ref_id", "article_id", F.col("text_excerpt").alias("excerpt"))


@query(
    "fallback_sections",
    f"""WITH {{art}}, v AS (SELECT article_id, CASE WHEN ord % 2 = 0 THEN nullif({s_strip('title')}, '') END AS s, nullif({s_strip('left(body, 500)')}, '') AS e,
      CASE WHEN ord % 3 = 0 THEN medium END AS r, CASE WHEN ord % 4 = 1 THEN lang END AS a FROM art)
    SELECT article_id, coalesce(s, e, '{K.SECTION_DEFAULT_FACT}') AS what_happened, coalesce(s, left(e, 160), '{K.SECTION_DEFAULT_SUMMARY}') AS one_line_summary,
      coalesce(r, '{K.SECTION_DEFAULT_WHY}') AS why_it_matters, coalesce(a, '{K.SECTION_DEFAULT_ACTION}') AS business_action_hint,
      array_to_string(list_filter([a, r], lambda x: x IS NOT NULL), '|') AS watch_points,
      coalesce(s, e, '{K.SECTION_DEFAULT_FACT}') || ' ' || coalesce(r, a, '{K.SECTION_DEFAULT_IMPLICATION}') || chr(10) || chr(10) || coalesce(a, r, '{K.SECTION_DEFAULT_OUTLOOK}') AS summary_and_implications FROM v""",
)
def fallback_sections(spark, sf_dir):
    o = F.col("ord")
    rows = art(spark, sf_dir).select(
        "article_id",
        F.when(o % 2 == 0, F.col("title")).otherwise(F.lit(" ")).alias("summary"),
        F.left("body", F.lit(500)).alias("text_excerpt"),
        F.when(o % 3 == 0, F.col("medium")).alias("reason_to_read"),
        F.when(o % 4 == 1, F.col("lang")).otherwise(F.lit("")).alias("business_implications"),
    )
    out = digest.fallback_sections(rows)
    return out.select(
        "article_id", "what_happened", "one_line_summary", "why_it_matters", "business_action_hint",
        F.array_join("watch_points", "|").alias("watch_points"), "summary_and_implications",
    )


@query(
    "report_date",
    """WITH {store}, d AS (SELECT ord, CASE WHEN ord % 3 = 0 THEN '' ELSE issue_date END AS issue_date, edition FROM store)
    SELECT CASE WHEN length(x) = 8 THEN left(x, 4) || '-' || substring(x, 5, 2) || '-' || substring(x, 7, 2) ELSE x END AS report_date FROM (
      SELECT coalesce((SELECT arg_min(issue_date, ord) FROM d WHERE issue_date <> '' AND edition = 'evening'), (SELECT arg_min(issue_date, ord) FROM d WHERE issue_date <> ''), 'auto') AS x)""",
)
def report_date(spark, sf_dir):
    rows = store(spark, sf_dir).withColumn("issue_date", F.when(F.col("ord") % 3 == 0, F.lit("")).otherwise(F.col("issue_date")))
    return digest.report_date(rows.where("edition = 'evening'"), rows, "issue_date", ["ord"], F.lit("auto"))


_HEAD = "CASE " + " ".join(
    f"WHEN contains(c, {sql_text(s)}) AND length({s_strip(f'split_part(c, {sql_text(s)}, 1)')}) BETWEEN 4 AND 24 THEN {s_strip(f'split_part(c, {sql_text(s)}, 1)')}"
    for s in K.HEADLINE_SEPARATORS
) + " ELSE left(c, 22) || CASE WHEN length(c) > 22 THEN '...' ELSE '' END END"


@query(
    "headline_from_text",
    f"""WITH {{art}}, v AS (SELECT article_id, {s_strip(s_squeeze('body'))} AS c FROM art)
    SELECT article_id, CASE WHEN c = '' THEN '変化' || article_id ELSE {_HEAD} END AS headline FROM v""",
)
def headline_from_text(spark, sf_dir):
    return art(spark, sf_dir).select("article_id", digest.headline("body", F.col("article_id")).alias("headline"))


@query(
    "union_feeds",
    "WITH {entries} SELECT site AS medium, feed, ord FROM entries WHERE feed IN ('click', 'view') UNION ALL SELECT site, feed, ord FROM entries WHERE feed NOT IN ('click', 'view')",
)
def union_feeds(spark, sf_dir):
    e = entries(spark, sf_dir).select(F.col("site").alias("medium"), "feed", "ord")
    near = F.col("feed").isin("click", "view")
    return e.where(near).unionByName(e.where(~near))


@query(
    "merge_kv",
    """
    SELECT c_custkey, c_mktsegment AS a, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'left' END AS b, CASE WHEN c_custkey % 2 = 0 THEN 'new' END AS z FROM customer""",
)
def merge_kv(spark, sf_dir):
    left = F.create_map(F.lit("a"), F.col("c_mktsegment"), F.lit("b"), F.lit("left"))
    right = F.when(F.col("c_custkey") % 2 == 0, F.create_map(F.lit("b"), F.lit(""), F.lit("z"), F.lit("new"))).otherwise(
        F.create_map().cast("map<string,string>")
    )
    merged = F.map_zip_with(left, right, lambda k, l, r: F.coalesce(r, l))
    rows = table(spark, sf_dir, "customer").select("c_custkey", merged.alias("m"))
    return rows.select("c_custkey", *[F.try_element_at("m", F.lit(k)).alias(k) for k in ("a", "b", "z")])
