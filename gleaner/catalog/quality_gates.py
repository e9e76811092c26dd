"""Body metrics and gates over every article."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.catalog.base import art, query, s_any, s_count, s_lines, s_occurrences, s_strip, sql_list, sql_text
from gleaner.catalog.text_functions import s_norm, s_tokens
from gleaner.functions import text as T
from gleaner.operators import filters, quality

METRICS = f"""c AS (SELECT *, {s_strip("regexp_replace(regexp_replace(replace(body, chr(160), ' '), '\\r\\n?', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")} AS clean FROM art),
    l AS (SELECT *, {s_lines('clean')} AS ls FROM c),
    m AS (SELECT *, CAST(length(clean) AS INTEGER) AS text_length,
      CAST(len(list_filter(ls, lambda x: length(x) >= 20)) AS INTEGER) AS paragraph_count,
      {s_occurrences('clean', ['。'])} AS sentence_count,
      {s_occurrences('clean', K.BODY_NAV_TERMS)} AS nav_keyword_hits,
      CASE WHEN len(ls) = 0 THEN 0.0 ELSE len(list_filter(ls, lambda x: len(list_filter(ls, lambda y: y = x)) > 1)) / len(ls) END AS duplicate_line_ratio,
      CASE WHEN len(ls) = 0 THEN 0.0 ELSE round(CAST(len(list_filter(ls, lambda x: regexp_matches(x, 'https?://|www\\.|▶|＞|→'))) AS DOUBLE) / len(ls), 3) END AS link_text_ratio
      FROM l),
    g AS (SELECT *, NOT (text_length >= 120 AND sentence_count >= 3 AND paragraph_count >= 3 AND link_text_ratio <= 0.35)
      AND (nav_keyword_hits >= 3 OR sentence_count <= 1 OR link_text_ratio >= 0.55 OR duplicate_line_ratio >= 0.35
        OR (paragraph_count <= 2 AND text_length < 700)) AS nav FROM m)"""


@query(
    "body_metrics",
    f"""WITH {{art}}, {METRICS} SELECT article_id, text_length, paragraph_count, sentence_count, nav_keyword_hits,
      round(duplicate_line_ratio, 6) AS duplicate_line_ratio, CAST(link_text_ratio AS DOUBLE) AS link_text_ratio FROM m""",
)
def body_metrics(spark, sf_dir):
    m = quality.with_body_metrics(art(spark, sf_dir).select("article_id", "body"), "body").select("article_id", "metrics.*")
    return m.withColumn("duplicate_line_ratio", F.round("duplicate_line_ratio", 6))


@query("is_navigation_text", f"WITH {{art}}, {METRICS} SELECT article_id, nav FROM g")
def is_navigation_text(spark, sf_dir):
    m = quality.with_body_metrics(art(spark, sf_dir).select("article_id", "body"), "body")
    return m.select("article_id", quality.is_navigation_text(F.col("metrics")).alias("nav"))


@query(
    "is_navigation_body",
    f"""WITH {{art}}, b AS (SELECT article_id, {s_strip('body')} AS b FROM art)
    SELECT article_id, b <> '' AND ({s_occurrences('b', K.SCORING_NAV_TERMS)} >= 2 OR ({s_occurrences('b', ['。'])} <= 1 AND length(b) > 150)) AS nav FROM b""",
)
def is_navigation_body(spark, sf_dir):
    return art(spark, sf_dir).select("article_id", quality.is_navigation_body("body").alias("nav"))


@query(
    "is_nav_store",
    f"WITH {{art}} SELECT article_id, {s_occurrences('body', K.STORE_NAV_TERMS)} >= 3 AS nav FROM art",
)
def is_nav_store(spark, sf_dir):
    return art(spark, sf_dir).select("article_id", quality.is_navigation_for_store("body").alias("nav"))


@query(
    "is_index_title",
    "WITH {art} SELECT article_id, regexp_matches(title, '朝刊・夕刊(\\s*\\d+月\\d+日.*付)?') AS is_index FROM art",
)
def is_index_title(spark, sf_dir):
    return art(spark, sf_dir).select("article_id", quality.is_index_title("title").alias("is_index"))


NOISE_SQL = (
    f"({s_strip('body')} = '' OR (length(body) < 120 AND {s_count('body', K.PAGE_NOISE_MARKERS)} >= 2) "
    "OR regexp_matches(body, '(ログイン|会員登録)[^\\n]{0,120}(ログイン|会員登録)'))"
)


@query("looks_like_noise", f"WITH {{art}} SELECT article_id, {NOISE_SQL} AS noise FROM art".replace("{0,120}", "{0,120}"))
def looks_like_noise(spark, sf_dir):
    return art(spark, sf_dir).select("article_id", quality.looks_like_noise("body").alias("noise"))


def _hits(x: str, terms: list[str]) -> str:
    return f"array_to_string(list_filter({sql_list(terms)}, lambda m: contains({x}, m))[1:5], ',')"


@query(
    "detect_walls",
    f"""WITH {{art}} SELECT article_id, {_hits('body', K.LOGIN_MARKERS)} AS login, {_hits('body', K.PAID_MARKERS)} AS paid,
      {_hits('body', K.ACCESS_MARKERS)} AS access, {s_any('body', K.LOGIN_MARKERS)} AS login_wall FROM art""",
)
def detect_walls(spark, sf_dir):
    staged = art(spark, sf_dir).select("article_id", quality.wall_hits("body").alias("w"))
    return staged.select(
        "article_id",
        *[F.array_join(f"w.{k}", ",").alias(k) for k in ("login", "paid", "access")],
        (F.size("w.login") > 0).alias("login_wall"),
    )


# A captured page for each article: its own title with the site's name, an index title, half a title, another title.
def captured(spark, sf_dir):
    n = F.col("ord") % 4
    half = F.left("title", F.ceil(F.length("title") / 2).cast("int"))
    page_title = (
        F.when(n == 0, F.concat("title", F.lit(" - 日本経済新聞")))
        .when(n == 1, F.lit("朝刊・夕刊 3月12日付"))
        .when(n == 2, half)
        .otherwise(F.lit("Unrelated page"))
    )
    url = F.when(F.col("ord") % 3 == 0, F.lit("https://news.example.com/x")).otherwise(F.col("url"))
    source_title = F.when(F.col("ord") % 11 == 0, F.lit("")).otherwise(F.col("title"))
    return art(spark, sf_dir).select(
        "article_id", "ord", "body", "title", page_title.alias("page_title"), url.alias("url"), source_title.alias("source_title")
    )


CAPTURED = """caught AS (SELECT article_id, ord, body, title,
    CASE ord % 4 WHEN 0 THEN title || ' - 日本経済新聞' WHEN 1 THEN '朝刊・夕刊 3月12日付'
      WHEN 2 THEN left(title, CAST((length(title) + 1) // 2 AS INTEGER)) ELSE 'Unrelated page' END AS page_title,
    CASE WHEN ord % 3 = 0 THEN 'https://news.example.com/x' ELSE url END AS url,
    CASE WHEN ord % 11 = 0 THEN '' ELSE title END AS source_title FROM art)"""

MATCH = f"""n AS (SELECT *, {s_norm('source_title')} AS src, {s_norm('page_title')} AS pg FROM caught),
    k AS (SELECT *, {s_tokens('src')} AS tok FROM n),
    h AS (SELECT *, list_filter(tok, lambda t: contains(pg, t)) AS hit,
      src <> '' AND pg <> '' AND (contains(pg, src) OR contains(src, pg)) AS partial_match FROM k),
    tm AS (SELECT *, CASE WHEN len(tok) = 0 THEN 0.0 ELSE CAST(len(hit) AS DOUBLE) / len(tok) END AS share FROM h),
    tmm AS (SELECT *, partial_match OR len(hit) >= 2 OR share >= 0.4 AS matched FROM tm)"""


@query(
    "title_match",
    f"""WITH {{art}}, {CAPTURED}, {MATCH} SELECT article_id, matched, partial_match, CAST(len(tok) AS INTEGER) AS tokens,
      array_to_string(hit, ' ') AS matched_tokens, CAST(round(share, 3) AS DOUBLE) AS ratio FROM tmm""",
)
def title_match(spark, sf_dir):
    rows = quality.with_title_match(captured(spark, sf_dir), "source_title", "page_title")
    m = F.col("title_match")
    return rows.select(
        "article_id",
        m["matched"].alias("matched"),
        m["partial_match"].alias("partial_match"),
        m["source_token_count"].alias("tokens"),
        F.array_join(m["matched_tokens"], " ").alias("matched_tokens"),
        m["token_match_ratio"].alias("ratio"),
    )


def headline_sql(title: str, body: str) -> str:
    return f"""hn AS (SELECT *, {title} AS ht, {s_norm(title)} AS t, {s_norm(f'left({body}, 280)')} AS head, {s_norm(body)} AS whole FROM {{src}}),
    ht AS (SELECT *, {s_tokens('t')} AS ttok FROM hn),
    hl AS (SELECT *, ht <> '' AND {body} <> '' AND t <> '' AND head <> '' AND (contains(head, left(t, 20)) OR contains(t, left(head, 20))
        OR len(list_filter(ttok, lambda k: contains(head, k))) >= 2) AS aligned,
      ht <> '' AND {body} <> '' AND whole <> '' AND len(ttok) > 0 AND (len(list_filter(ttok, lambda k: contains(whole, k))) >= 2
        OR len(list_filter(ttok, lambda k: contains(whole, k))) / len(ttok) >= 0.4) AS in_text FROM ht)"""


@query(
    "headline_alignment",
    "WITH {art}, " + headline_sql("title", "body").replace("{src}", "art") + " SELECT article_id, aligned FROM hl",
)
def headline_alignment(spark, sf_dir):
    rows = quality.with_headline_checks(art(spark, sf_dir), "title", "body")
    return rows.select("article_id", F.col("headline_aligned").alias("aligned"))


@query(
    "title_overlap",
    "WITH {art}, " + headline_sql("title", "body").replace("{src}", "art") + " SELECT article_id, in_text FROM hl",
)
def title_overlap(spark, sf_dir):
    rows = quality.with_headline_checks(art(spark, sf_dir), "title", "body")
    return rows.select("article_id", F.col("title_overlaps").alias("in_text"))


VALIDATED = (
    CAPTURED
    + ", "
    + METRICS.replace("FROM art)", "FROM caught)")
    + ", "
    + MATCH.replace("FROM caught)", "FROM g)")
    + ", "
    + headline_sql("CASE WHEN source_title <> '' THEN source_title ELSE page_title END", "clean").replace("{src}", "tmm")
    + """, lk AS (SELECT *, text_length >= 120 AND sentence_count >= 2 AND paragraph_count >= 2 AND (matched OR aligned OR in_text) AS likely FROM hl),
    vb AS (SELECT *, CASE WHEN clean = '' THEN 'empty_text'
      WHEN contains(page_title, '朝刊・夕刊') AND NOT contains(url, '/paper/article/') AND NOT likely THEN 'paper_index_page_title'
      WHEN nav AND NOT likely THEN 'navigation_like_text' WHEN text_length < 120 THEN 'too_short'
      WHEN source_title <> '' AND page_title <> '' AND NOT matched AND sentence_count < 3 THEN 'title_mismatch_with_low_quality'
      ELSE '' END AS reason FROM lk)"""
)


def validated(spark, sf_dir):
    return quality.validate_body(captured(spark, sf_dir), "body", "source_title", "page_title", "url")


@query("validate_body", f"WITH {{art}}, {VALIDATED} SELECT article_id, reason FROM vb")
def validate_body(spark, sf_dir):
    return validated(spark, sf_dir).select("article_id", F.col("rejection_reason").alias("reason"))


HR_SQL = f"""CASE WHEN contains(body, '{K.HR_BODY_MARKER}') THEN 'hr_article_marker'
    WHEN regexp_matches(title, '{T.java_pattern(K.HR_TITLE_PATTERNS[0])}') AND {s_any('body', K.HR_BODY_WORDS)} AND length(body) < 600
      AND NOT {s_any('body', K.BUSINESS_WORDS)} THEN 'hr_short_executive_article' ELSE '' END"""


@query("exclude_by_body", f"WITH {{art}} SELECT article_id, {HR_SQL} AS reason FROM art")
def exclude_by_body(spark, sf_dir):
    return art(spark, sf_dir).select(
        "article_id", filters.exclude_by_body_reason(F.col("title"), F.col("body")).alias("reason")
    )


SELECTORS = ["article", '[class*="content"]', "main", ".cmn-section", "paragraph_fallback"]
WALLS = s_any("clean", K.LOGIN_MARKERS + K.PAID_MARKERS + K.ACCESS_MARKERS)
ACCEPTED = f"""x AS (SELECT *, {HR_SQL} AS ex, CASE WHEN ord % 5 = 1 THEN 'disallowed_selector' ELSE reason END AS why FROM vb),
    ab AS (SELECT *, CASE WHEN ex <> '' THEN 'excluded:' || ex WHEN why <> '' THEN 'failed:' || why
      WHEN text_length < 120 AND {NOISE_SQL.replace('body', 'clean')} THEN 'failed:noise_or_empty_body'
      WHEN text_length < 120 AND (text_length < 40 OR {WALLS}) THEN 'failed:too_short'
      WHEN text_length < 120 THEN 'success_short' ELSE 'success' END AS outcome FROM x)"""


def accepted(spark, sf_dir):
    from gleaner.catalog.base import pick

    v = validated(spark, sf_dir)
    excluded = filters.exclude_by_body_reason(F.col("title"), F.col("body"))
    outcome = quality.accept_body(
        F.col("clean_text"), F.lit(""), F.col("title"), pick(F.col("ord"), SELECTORS), F.col("rejection_reason"), excluded
    )
    return v.withColumn("outcome", outcome)


@query("accept_body", f"WITH {{art}}, {VALIDATED}, {ACCEPTED} SELECT article_id, outcome FROM ab")
def accept_body(spark, sf_dir):
    return accepted(spark, sf_dir).select("article_id", "outcome")


@query(
    "empty_body_reason",
    """WITH {art}, v AS (SELECT article_id, CASE WHEN ord % 3 = 0 THEN body ELSE ' ' END AS t, CASE WHEN ord % 4 = 0 THEN title ELSE body END AS page,
      ord % 13 = 0 AS login, ord % 11 <> 0 AS found, ord % 2 = 0 AS blocked FROM art),
    n AS (SELECT *, length("""
    + s_strip("t")
    + ") AS tn, length("
    + s_strip("page")
    + """) AS pn FROM v)
    SELECT article_id, CASE WHEN login THEN 'empty_body_login_like_text' WHEN NOT found THEN 'empty_body_dom_missing'
      WHEN pn > 400 AND tn = 0 THEN 'empty_body_page_text_present_but_selector_failed'
      WHEN blocked AND pn < 80 THEN 'empty_body_resource_block_suspected' WHEN tn = 0 THEN 'empty_body_dom_missing'
      ELSE 'empty_body_unknown' END AS reason FROM n""",
)
def empty_body_reason(spark, sf_dir):
    o = F.col("ord")
    return art(spark, sf_dir).select(
        "article_id",
        quality.empty_body_reason(
            F.when(o % 3 == 0, F.col("body")).otherwise(F.lit(" ")),
            F.when(o % 4 == 0, F.col("title")).otherwise(F.col("body")),
            o % 13 == 0,
            o % 11 != 0,
            o % 2 == 0,
        ).alias("reason"),
    )
