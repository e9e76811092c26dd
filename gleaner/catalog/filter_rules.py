"""Filters and decisions over every article, link, rule and run."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.catalog.base import art, links, pick, query, s_any, s_part, s_strip, sql_list, sql_pick, sql_text, table
from gleaner.catalog.url_functions import ISSUES, issue_links
from gleaner.functions import html as H
from gleaner.functions import jsons as J
from gleaner.functions import text as T
from gleaner.functions import urls as U
from gleaner.operators import filters

INCLUDES = ["", "(?i)the|le", "^[A-M鉄]", "[0-9]", ""]
EXCLUDES = ["", "速報|人事", "tion", ""]
MEDIUM_NO = "CAST(replace(medium, 'src', '') AS BIGINT)"


def media_config(spark, sf_dir):
    """One config row for each medium that occurs."""
    n = F.replace("medium", F.lit("src"), F.lit("")).cast("bigint")
    media = table(spark, sf_dir, "documents").select(F.col("source").alias("medium")).distinct()
    return media.select(
        "medium",
        pick(n, INCLUDES).alias("include_pattern"),
        pick(n, EXCLUDES).alias("exclude_pattern"),
        (n % 7 + 1).cast("int").alias("max_items"),
        ((n * 7) % 20).cast("int").alias("display_order"),
        ((n % 4 + 1) * 24).cast("int").alias("lookback_hours"),
        (n % 9 != 8).alias("enabled"),
        (n * 11 % 60 + 30).cast("int").alias("max_items_total"),
    )


CONFIG = f"""config AS (SELECT medium, {sql_pick(MEDIUM_NO, INCLUDES)} AS include_pattern, {sql_pick(MEDIUM_NO, EXCLUDES)} AS exclude_pattern,
    CAST({MEDIUM_NO} % 7 + 1 AS INTEGER) AS max_items, CAST({MEDIUM_NO} * 7 % 20 AS INTEGER) AS display_order,
    CAST(({MEDIUM_NO} % 4 + 1) * 24 AS INTEGER) AS lookback_hours, {MEDIUM_NO} % 9 <> 8 AS enabled,
    CAST({MEDIUM_NO} * 11 % 60 + 30 AS INTEGER) AS max_items_total FROM (SELECT DISTINCT source AS medium FROM documents))"""


@query(
    "title_include_exclude",
    f"""WITH {{art}}, {CONFIG} SELECT article_id, CASE WHEN include_pattern <> '' AND NOT regexp_matches(title, include_pattern)
      THEN 'include_pattern_not_matched' WHEN exclude_pattern <> '' AND regexp_matches(title, exclude_pattern) THEN 'exclude_pattern_matched'
      ELSE 'accepted' END AS reason FROM art JOIN config USING (medium)""",
)
def title_include_exclude(spark, sf_dir):
    rows = art(spark, sf_dir).join(media_config(spark, sf_dir), "medium")
    return rows.select(
        "article_id",
        filters.title_filter_reason(F.col("title"), F.col("include_pattern"), F.col("exclude_pattern")).alias("reason"),
    )


URL_PATTERNS = ["", "^/ [a-m]\n", "https?://www", "ing$", " ^/t "]


@query(
    "url_pattern_filter",
    f"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '{H.ANCHOR.replace("'", "''")}', 1)) AS head,
        generate_subscripts(regexp_extract_all(html, '{H.ANCHOR.replace("'", "''")}', 1), 1) - 1 AS pos FROM pages),
    r AS (SELECT page_id, CAST(pos AS INTEGER) AS pos, trim(regexp_extract(head, '{H.HREF.replace("'", "''")}', 1)) AS href, {s_part('url', 1)} || '://' || {s_part('url', 2)} AS root,
      regexp_replace({sql_pick('page_id', URL_PATTERNS)}, '\\s+', '', 'g') AS p FROM a)
    SELECT page_id, pos, root || href AS link FROM r WHERE p = '' OR regexp_matches(root || href, p) OR regexp_matches(href, p)""",
)
def url_pattern_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", "url", F.posexplode(H.anchors("html")).alias("pos", "a"))
    rows = rows.select(
        "page_id", "pos", U.url_join("url", "a.href").alias("link"), F.col("a.href").alias("href"),
        pick(F.col("page_id"), URL_PATTERNS).alias("pattern"),
    )
    return rows.where(filters.passes_url_pattern(F.col("link"), F.col("href"), F.col("pattern"))).select(
        "page_id", "pos", "link"
    )


@query(
    "noise_terms",
    f"""WITH {{art}} SELECT article_id, {s_any('title', K.NOISE_TERMS)} OR {s_any('body', K.NOISE_TERMS)} AS noise,
      medium <> 'src3' OR NOT ({s_any('title', K.NOISE_TERMS)} OR {s_any('body', K.NOISE_TERMS)}) AS kept FROM art""",
)
def noise_terms(spark, sf_dir):
    t, b = F.col("title"), F.col("body")
    return art(spark, sf_dir).select(
        "article_id",
        filters.is_noise(t, b).alias("noise"),
        filters.keep_after_noise(F.col("medium"), "src3", t, b).alias("kept"),
    )


PRE_PATTERN = "|".join(T.java_pattern(p) for p in K.PRE_TITLE_PATTERNS)
HR_PATTERN = "|".join(T.java_pattern(p) for p in K.HR_TITLE_PATTERNS)


@query(
    "pre_exclude",
    f"""WITH {{art}} SELECT article_id, CASE WHEN regexp_matches(title, 'ouen') THEN 'title_regex' WHEN regexp_matches(title, '{PRE_PATTERN}') THEN 'pre_title_regex'
      WHEN regexp_matches(title, '{HR_PATTERN}') THEN 'pre_hr_like_title' WHEN length(title) <= 6 THEN 'pre_short_title' ELSE '' END AS reason FROM art""",
)
def pre_exclude(spark, sf_dir):
    return art(spark, sf_dir).select(
        "article_id", filters.pre_exclude_reason(F.col("title"), title_regex="ouen").alias("reason")
    )


_TOPICS = ", ".join(f"CASE WHEN {s_any('f', terms)} THEN {sql_text(n)} END" for n, terms in K.EXCLUDE_TOPICS.items())


@query(
    "exclude_topics",
    f"""WITH {{art}}, v AS (SELECT article_id, title || chr(10) || body AS f FROM art),
    t AS (SELECT article_id, array_to_string(list_sort(list_filter([{_TOPICS}], lambda x: x IS NOT NULL)), '、') AS r FROM v)
    SELECT article_id, CASE WHEN r = '人事のみ' THEN '人事だけの記事' ELSE r END AS reason FROM t""",
)
def exclude_topics(spark, sf_dir):
    staged = art(spark, sf_dir).select("article_id", F.concat_ws("\n", "title", "body").alias("f"))
    return staged.select("article_id", filters.exclude_topics(F.col("f")).alias("reason"))


@query(
    "valid_http_url",
    f"""WITH {{links}}, v AS (SELECT ord, CASE ord % 5 WHEN 0 THEN link WHEN 1 THEN replace(link, 'http', 'ftp') WHEN 2 THEN '/path' WHEN 3 THEN 'https://'
      ELSE upper(link) END AS u FROM links)
    SELECT ord, lower({s_part('u', 1)}) IN ('http', 'https') AND {s_part('u', 2)} <> '' AS valid FROM v""",
)
def valid_http_url(spark, sf_dir):
    n = F.col("ord") % 5
    u = (
        F.when(n == 0, F.col("link"))
        .when(n == 1, F.replace("link", F.lit("http"), F.lit("ftp")))
        .when(n == 2, F.lit("/path"))
        .when(n == 3, F.lit("https://"))
        .otherwise(F.upper("link"))
    )
    return links(spark, sf_dir).select("ord", U.is_http_url(u).alias("valid"))


@query(
    "is_issue_article_url",
    f"""WITH {ISSUES} SELECT page_id, page_id % 4 = 0 AS is_article FROM issues""",
)
def is_issue_article_url(spark, sf_dir):
    return issue_links(spark, sf_dir).select(
        "page_id", U.is_issue_article("link", "example.com", "/paper/article/").alias("is_article")
    )


MEDIA = ["src1", "src2", "src5", "src7", "src11", "src13", "src17"]


@query(
    "needs_translation",
    f"""WITH {{art}} SELECT article_id, medium IN ({', '.join(sql_text(m) for m in MEDIA)})
      AND NOT regexp_matches(split_part(body, chr(10), 1), '[\\x{{3040}}-\\x{{30ff}}\\x{{4e00}}-\\x{{9fff}}]') AS translate FROM art""",
)
def needs_translation(spark, sf_dir):
    first_line = F.substring_index("body", "\n", 1)
    return art(spark, sf_dir).select(
        "article_id", filters.needs_translation(F.col("medium"), first_line, MEDIA).alias("translate")
    )


def enrichable(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("article_id"), (F.col("quality") == 1).alias("done"))
    score = F.when(F.col("ord") % 9 == 0, F.lit("n/a")).otherwise((F.col("ord") % 7).cast("string"))
    rows = art(spark, sf_dir).join(labels, "article_id", "left")
    return rows.withColumn("reason", filters.enrichment_skip_reason(F.col("done"), score, F.col("body")))


ENRICH = f"""enrich AS (SELECT article_id, CASE WHEN quality = 1 THEN 'already_processed'
    WHEN CASE WHEN ord % 9 = 0 THEN 0 ELSE ord % 7 END <= 3 THEN 'importance_score_lte_3'
    WHEN length({s_strip('body')}) < 120 THEN 'missing_or_short_text' END AS reason FROM art LEFT JOIN labels ON doc_id = article_id)"""


@query("enrichment_eligible", f"WITH {{art}}, {ENRICH} SELECT article_id, reason FROM enrich")
def enrichment_eligible(spark, sf_dir):
    return enrichable(spark, sf_dir).select("article_id", "reason")


@query(
    "enrichment_skips",
    f"""WITH {{art}}, {ENRICH} SELECT coalesce(reason, 'eligible') AS outcome, count(*) AS articles FROM enrich GROUP BY 1""",
)
def enrichment_skips(spark, sf_dir):
    return enrichable(spark, sf_dir).groupBy(F.coalesce("reason", F.lit("eligible")).alias("outcome")).agg(
        F.count("*").alias("articles")
    )


@query(
    "validate_enrichment",
    f"""WITH {{art}} SELECT article_id, ord % 5 <> 0 AND {s_strip('title')} <> '' AND length(title) >= 50 AND {s_strip("left(body, 60)")} <> ''
      AND length(left(body, 60)) >= 40 AND {s_strip('body')} <> '' AND length(body) >= 80 AS valid FROM art""",
)
def validate_enrichment(spark, sf_dir):
    doc = F.to_json(
        F.struct(
            F.col("title").alias("summary"),
            F.when(F.col("ord") % 5 != 0, F.left("body", F.lit(60))).alias("reason_to_read"),
            F.col("body").alias("business_implications"),
        )
    )
    staged = art(spark, sf_dir).select("article_id", doc.alias("doc"))
    minimums = {"summary": 50, "reason_to_read": 40, "business_implications": 80}
    return staged.select("article_id", J.long_enough(F.col("doc"), minimums).alias("valid"))


@query(
    "validate_report",
    """SELECT c_custkey, CASE WHEN c_custkey % 17 = 0 THEN 'report_is_not_object' ELSE array_to_string(list_filter([
      CASE WHEN c_custkey % 2 = 0 THEN 'missing_report_title' END,
      CASE WHEN c_custkey % 3 = 0 THEN 'missing_executive_summary' END,
      CASE WHEN false THEN 'missing_today_key_message' END,
      CASE WHEN c_custkey % 11 = 0 THEN 'missing_cross_article_implications' END,
      CASE WHEN c_custkey % 5 = 0 THEN 'missing_integrated_insights' END,
      CASE WHEN c_custkey % 7 = 0 THEN 'missing_watchlist' END,
      CASE WHEN c_custkey % 4 = 1 THEN 'priority_watch_items_not_list' END,
      CASE c_custkey % 6 WHEN 0 THEN 'missing_article_sections' WHEN 1 THEN 'article_sections_not_list'
        WHEN 2 THEN 'article_sections_count_1_expected_2' END], lambda x: x IS NOT NULL), ',') END AS errors FROM customer""",
)
def validate_report(spark, sf_dir):
    k = F.col("c_custkey")
    quoted = lambda s: F.lit(s)
    sections = pick(k, ["null", '"x"', '[{"ref_id":"A1"}]', "[{},{}]", "[{},{}]", "[{},{}]"])
    doc = F.concat(
        quoted('{"report_title":"'), F.when(k % 2 != 0, F.lit("t")).otherwise(F.lit("")),
        quoted('","executive_summary":'), F.when(k % 3 != 0, F.lit('"s"')).otherwise(F.lit("null")),
        quoted(',"today_key_message":"'), F.col("c_mktsegment"), quoted('"'),
        F.when(k % 11 != 0, F.lit(',"cross_article_implications":"c"')).otherwise(F.lit("")),
        F.when(k % 5 != 0, F.lit(',"integrated_insights":[]')).otherwise(F.lit("")),
        F.when(k % 7 != 0, F.lit(',"watchlist":null')).otherwise(F.lit("")),
        F.when(k % 4 == 0, F.lit(',"priority_watch_items":[]')).when(k % 4 == 1, F.lit(',"priority_watch_items":"x"')).otherwise(F.lit("")),
        quoted(',"article_sections":'), sections, quoted("}"),
    )
    doc = F.when(k % 17 == 0, F.lit("[]")).otherwise(doc)
    return table(spark, sf_dir, "customer").select("c_custkey", doc.alias("doc")).select(
        "c_custkey", F.array_join(J.report_errors(F.col("doc"), F.lit(2)), ",").alias("errors")
    )


@query(
    "edition_check",
    """WITH v AS (SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS d, CASE o_orderkey % 3 WHEN 0 THEN 'morning' WHEN 1 THEN 'evening' ELSE '' END AS edition FROM orders),
    f AS (SELECT *, CASE o_orderkey % 5 WHEN 0 THEN d || 'M101' WHEN 1 THEN d || 'E202' WHEN 2 THEN '' WHEN 3 THEN d || 'E1' ELSE d || 'M9' END AS id,
      CASE o_orderkey % 5 WHEN 0 THEN 1 WHEN 2 THEN 0 WHEN 3 THEN 2 ELSE 1 END AS ids,
      CASE edition WHEN 'morning' THEN 'M' WHEN 'evening' THEN 'E' ELSE '' END AS marker FROM v)
    SELECT o_orderkey, id, CAST(ids AS INTEGER) AS ids, marker, CASE WHEN marker <> '' AND id <> '' AND marker <> substring(id, 9, 1) THEN 'edition_mismatch' ELSE 'ok' END AS result FROM f""",
)
def edition_check(spark, sf_dir):
    k, d = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyyMMdd")
    body = F.replace(
        pick(
            k,
            [
                "x editionID=@M101 y editionID=@M101",
                "editionID=@E202, editionID=19000101M1",
                "editionID=19000101E1",
                "a?editionID=@E1&b editionID=@M2 editionID=@E1",
                "EDITIONid=@M9",
            ],
        ),
        F.lit("@"),
        d,
    )
    staged = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        pick(k, ["morning", "evening", ""]).alias("edition"),
        filters.detected_editions(body, d).alias("found"),
    )
    first, marker, result = filters.edition_check(F.col("edition"), F.col("found"))
    return staged.select(
        "o_orderkey", first.alias("id"), F.size("found").alias("ids"), marker.alias("marker"), result.alias("result")
    )


# One run per user and day: counters derived from that day's events.
RUNS = """runs AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) FILTER (WHERE event_type <> 'view') AS targets,
    count(*) FILTER (WHERE event_type = 'purchase') AS succeeded, count(*) FILTER (WHERE event_type IN ('click', 'error', 'signup')) AS failed,
    count(*) FILTER (WHERE event_type = 'view') AS skips, user_id % 2 = 0 AS allow_empty,
    count(*) FILTER (WHERE event_type IN ('click', 'error', 'signup') AND (value >= 1 OR user_id % 3 > 0)) AS empties,
    count(*) FILTER (WHERE event_type = 'click') AS logins, count(*) FILTER (WHERE event_type = 'error') AS denied,
    count(*) FILTER (WHERE event_type = 'signup') AS paid FROM events GROUP BY 1, 2)"""


def runs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    failure = kind.isin("click", "error", "signup")
    return e.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.count_if(kind != "view").alias("targets"),
        F.count_if(kind == "purchase").alias("succeeded"),
        F.count_if(failure).alias("failed"),
        F.count_if(kind == "view").alias("skips"),
        F.count_if(failure & ((F.col("value") >= 1) | (F.col("user_id") % 3 > 0))).alias("empties"),
        F.count_if(kind == "click").alias("logins"),
        F.count_if(kind == "error").alias("denied"),
        F.count_if(kind == "signup").alias("paid"),
    )


@query(
    "run_outcome",
    f"""WITH {RUNS} SELECT user_id, day, CASE WHEN targets = 0 THEN 'skip_no_targets' WHEN succeeded > 0 OR skips > 0 OR allow_empty THEN 'continue' ELSE 'fail' END AS outcome FROM runs""",
)
def run_outcome(spark, sf_dir):
    return runs(spark, sf_dir).select(
        "user_id",
        "day",
        filters.run_outcome(F.col("targets"), F.col("succeeded"), F.col("skips"), F.col("user_id") % 2 == 0).alias("outcome"),
    )


@query(
    "systemic_failure",
    f"""WITH {RUNS} SELECT user_id, day, CASE WHEN targets > 0 AND succeeded = 0 AND empties = failed THEN
      CASE WHEN logins = failed AND failed > 0 THEN 'login_state_invalid' WHEN denied = failed AND failed > 0 THEN 'resource_block_side_effect'
        WHEN paid = failed AND failed > 0 THEN 'selector_mismatch' ELSE 'article_dom_changed' END END AS cause FROM runs""",
)
def systemic_failure(spark, sf_dir):
    c = [F.col(n) for n in ("targets", "succeeded", "failed", "empties", "logins", "denied", "paid")]
    return runs(spark, sf_dir).select("user_id", "day", filters.systemic_failure(*c).alias("cause"))


RULE_TYPES = ["country", " Sector ", "importance", "", "watch_theme"]


def raw_rules(spark, sf_dir):
    """Rules as saved: keywords are the benchmark passages cut at commas and ORs."""
    n = F.col("item_id")
    return table(spark, sf_dir, "benchmark").select(
        n.alias("rule_ord"),
        F.concat(F.lit("tag"), (n % 25).cast("string")).alias("tag_name"),
        pick(n, RULE_TYPES).alias("rule_type"),
        pick(n, ["true", "TRUE", "false", "true", "", "true", "true"]).alias("enabled"),
        (n % 9).cast("double").alias("weight"),
        (n % 6).cast("int").alias("priority"),
        F.col("text").alias("keywords"),
    )


RAW_RULES = f"""raw_rules AS (SELECT item_id AS rule_ord, 'tag' || (item_id % 25) AS tag_name, {sql_pick('item_id', RULE_TYPES)} AS rule_type,
    {sql_pick('item_id', ["true", "TRUE", "false", "true", "", "true", "true"])} AS enabled, CAST(item_id % 9 AS DOUBLE) AS weight,
    CAST(item_id % 6 AS INTEGER) AS priority, text AS keywords FROM benchmark),
    live_rules AS (SELECT *, lower(trim(rule_type)) AS kind FROM raw_rules WHERE lower(enabled) = 'true' AND lower(trim(rule_type)) IN ('', 'country', 'sector', 'importance'))"""


def live_rules(spark, sf_dir):
    wanted = ["country", "sector", "importance"]
    rules = raw_rules(spark, sf_dir).where(filters.rule_enabled(F.col("enabled"), F.col("rule_type"), wanted))
    return rules.withColumn("kind", F.lower(T.strip("rule_type")))


@query("rule_enabled", f"WITH {RAW_RULES} SELECT rule_ord, tag_name, kind, weight, priority FROM live_rules")
def rule_enabled(spark, sf_dir):
    return live_rules(spark, sf_dir).select("rule_ord", "tag_name", "kind", "weight", "priority")
