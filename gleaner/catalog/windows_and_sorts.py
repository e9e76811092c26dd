"""Dedupe, first-n, budgets, ties and orders over every article, link and event."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.catalog.base import (
    art, entries, links, query, s_any, s_normalize_url, s_strip, s_title_key, s_url_key, sql_text, store, table,
)
from gleaner.catalog.filter_rules import CONFIG, media_config
from gleaner.catalog.url_functions import ISSUES, issue_links
from gleaner.functions import text as T
from gleaner.functions import urls as U
from gleaner.operators import dedupe, filters, numbering, ranking, rules, selection

# ---- keyword scores (A8) ----


def s_bucket(text: str) -> str:
    parts = []
    for w in [w for b in K.IMPORTANCE_BUCKETS.values() for w in b]:
        if w.isascii() and w.isalpha():
            parts.append(f"CAST(regexp_matches({text}, '(?:^|[^\\p{{L}}\\p{{N}}_]){w}(?:$|[^\\p{{L}}\\p{{N}}_])') AS INTEGER)")
        else:
            parts.append(f"CAST(contains({text}, {sql_text(w)}) AS INTEGER)")
    return "least(3, " + " + ".join(parts) + ")"


SCORED = f"scored AS (SELECT *, {s_bucket('lower(title || body)')} AS score FROM art)"


def scored(spark, sf_dir):
    return rules.with_bucket_score(art(spark, sf_dir), F.concat("title", "body"))


@query("bucket_score", f"WITH {{art}}, {SCORED} SELECT article_id, score FROM scored")
def bucket_score(spark, sf_dir):
    return scored(spark, sf_dir).select("article_id", "score")


_TOPIC_SUM = " + ".join(f"CAST(contains(low, {sql_text(k.lower())}) AS INTEGER) * {w}" for k, w in K.TOPIC_WEIGHTS.items())
_TOPIC_LIST = ", ".join(f"CASE WHEN contains(low, {sql_text(k.lower())}) THEN {sql_text(k)} END" for k in K.TOPIC_WEIGHTS)
_COMPANY_LIST = ", ".join(f"CASE WHEN contains(t, {sql_text(c)}) THEN {sql_text(c)} END" for c in K.TOPIC_COMPANIES)
_NEGATIVE_SUM = " + ".join(f"CAST(contains(t, {sql_text(c)}) AS INTEGER)" for c in K.TOPIC_NEGATIVES)
TOPICS = f"""topic_text AS (SELECT *, title || '  ' || body AS t, lower(title || '  ' || body) AS low FROM art),
    topic_lists AS (SELECT *, list_filter([{_TOPIC_LIST}], lambda x: x IS NOT NULL) AS topics,
      list_filter([{_COMPANY_LIST}], lambda x: x IS NOT NULL) AS companies FROM topic_text),
    topic_scores AS (SELECT *, CAST(greatest(0, least(100, {_TOPIC_SUM} + len(companies) * 12 - ({_NEGATIVE_SUM}) * 25)) AS INTEGER) AS topic_score,
      CASE WHEN len(topics) + len(companies) = 0 THEN '{K.NO_TOPIC_REASON}' ELSE array_to_string(list_concat(
        list_transform(topics, lambda x: 'topic:' || x), list_transform(companies, lambda x: 'company:' || x)), '; ') END AS reason FROM topic_lists)"""


def topics(spark, sf_dir):
    return rules.with_topic_score(art(spark, sf_dir), F.col("title"), F.lit(""), F.col("body"))


@query("topic_score", f"WITH {{art}}, {TOPICS} SELECT article_id, topic_score, reason FROM topic_scores")
def topic_score(spark, sf_dir):
    return topics(spark, sf_dir).select(
        "article_id", F.col("topic.score").alias("topic_score"), F.col("topic.reason").alias("reason")
    )


@query(
    "rank_topics",
    f"WITH {{art}}, {TOPICS} SELECT article_id, topic_score, reason FROM topic_scores ORDER BY topic_score DESC, ord LIMIT 10",
)
def rank_topics(spark, sf_dir):
    rows = topics(spark, sf_dir).select("article_id", "ord", F.col("topic.score").alias("topic_score"), F.col("topic.reason").alias("reason"))
    return rows.orderBy(F.col("topic_score").desc(), "ord").limit(10).drop("ord")


# ---- N ----


@query(
    "first_n_per_feed",
    "WITH {entries} SELECT feed, ord FROM entries QUALIFY row_number() OVER (PARTITION BY feed ORDER BY ord) <= 15",
)
def first_n_per_feed(spark, sf_dir):
    return ranking.first_n(entries(spark, sf_dir), ["feed"], ["ord"], K.ENTRIES_PER_FEED).select("feed", "ord")


@query(
    "dedupe_url_title",
    f"""WITH {{links}} SELECT ord, link FROM links QUALIFY row_number() OVER (PARTITION BY site, {s_url_key('link')}, {s_title_key('title')} ORDER BY ord) = 1""",
)
def dedupe_url_title(spark, sf_dir):
    return dedupe.by_url_and_title(links(spark, sf_dir), "site", "title", "link", ["ord"]).select("ord", "link")


@query(
    "dedupe_title",
    f"""WITH {{art}}, k AS (SELECT *, {s_title_key('title')} AS k FROM art)
    SELECT article_id, title FROM k WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY medium, k ORDER BY ord) = 1""",
)
def dedupe_title(spark, sf_dir):
    return dedupe.by_title(art(spark, sf_dir), "medium", "title", ["ord"]).select("article_id", "title")


_UNTITLED = "CASE WHEN ord % 7 = 0 THEN '' ELSE title END"


@query(
    "dedupe_candidates",
    f"""WITH {{links}}, k AS (SELECT ord, link, site, {_UNTITLED} AS title, {s_normalize_url('link')} AS k FROM links),
    f AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY site, k ORDER BY ord) = 1)
    SELECT ord, link FROM f WHERE title <> ''""",
)
def dedupe_candidates(spark, sf_dir):
    rows = links(spark, sf_dir).withColumn("title", F.when(F.col("ord") % 7 == 0, F.lit("")).otherwise(F.col("title")))
    return dedupe.candidates(rows, ["site"], "link", "title", ["ord"]).select("ord", "link")


@query(
    "dedupe_accepted",
    f"""WITH {{links}}, k AS (SELECT ord, link, site, {s_normalize_url('link')} AS k FROM links WHERE page_id % 5 <> variant)
    SELECT ord, link FROM k QUALIFY row_number() OVER (PARTITION BY site, k ORDER BY ord) = 1""",
)
def dedupe_accepted(spark, sf_dir):
    ok = F.col("page_id") % 5 != F.col("variant")
    return dedupe.accepted(links(spark, sf_dir), "site", "link", ok, ["ord"]).select("ord", "link")


@query(
    "dedupe_issue_links",
    f"""WITH {ISSUES}, t AS (SELECT page_id, link, CASE WHEN page_id % 3 = 0 THEN '市況' ELSE 'Long enough ' || page_id END AS title,
      regexp_extract(link, '[?&]ng=([^&]+)', 1) AS ng FROM issues WHERE page_id % 4 = 0)
    SELECT page_id, CASE WHEN length(title) <= 6 THEN 'pre_short_title' ELSE '' END AS exclude_reason FROM t
    QUALIFY row_number() OVER (PARTITION BY ng ORDER BY page_id) = 1""",
)
def dedupe_issue_links(spark, sf_dir):
    title = F.when(F.col("page_id") % 3 == 0, F.lit("市況")).otherwise(F.concat(F.lit("Long enough "), F.col("page_id").cast("string")))
    rows = issue_links(spark, sf_dir).withColumn("title", title)
    rows = rows.where(U.is_issue_article("link", "example.com", "/paper/article/")).withColumn("ng", U.query_param("link", "ng"))
    return ranking.keep_first(rows, ["ng"], ["page_id"]).select(
        "page_id", filters.pre_exclude_reason(F.col("title")).alias("exclude_reason")
    )


BEST = f"""best_in AS (SELECT *, CASE WHEN ord % 4 = 0 THEN 'saved' ELSE 'new' END AS source, regexp_extract(url, 'ng=([^&]+)', 1) AS aid,
      CASE WHEN {s_strip('body')} = '' THEN 0 WHEN ord % 4 = 0 THEN 1 ELSE 2 END AS rk FROM art),
    best AS (SELECT *, min(ord) OVER (PARTITION BY aid) AS first_seen FROM best_in
      QUALIFY row_number() OVER (PARTITION BY aid ORDER BY rk DESC, ord) = 1)"""


def best_bodies(spark, sf_dir):
    rows = art(spark, sf_dir).drop("article_id").withColumn(
        "source", F.when(F.col("ord") % 4 == 0, F.lit("saved")).otherwise(F.lit("new"))
    )
    return dedupe.best_body(rows, "url", "body", "source", "ord", existing="saved")


@query("dedupe_best_body", f"WITH {{art}}, {BEST} SELECT aid AS article_id, ord, source, first_seen FROM best")
def dedupe_best_body(spark, sf_dir):
    return best_bodies(spark, sf_dir).select("article_id", "ord", "source", "first_seen")



@query(
    "dedupe_greedy_or",
    """WITH RECURSIVE {links}, g AS (SELECT row_number() OVER (ORDER BY ord) AS i, ord, page_id % 97 AS a, (page_id * 31 + variant * 7) % 89 AS b FROM links),
    walk(i, seen_a, seen_b, kept) AS (
      SELECT 0::BIGINT, []::BIGINT[], []::BIGINT[], NULL::BIGINT
      UNION ALL
      SELECT g.i, CASE WHEN list_contains(seen_a, a) OR list_contains(seen_b, b) THEN seen_a ELSE list_append(seen_a, a) END,
        CASE WHEN list_contains(seen_a, a) OR list_contains(seen_b, b) THEN seen_b ELSE list_append(seen_b, b) END,
        CASE WHEN list_contains(seen_a, a) OR list_contains(seen_b, b) THEN NULL ELSE ord END
      FROM walk JOIN g ON g.i = walk.i + 1)
    SELECT kept AS ord FROM walk WHERE kept IS NOT NULL""",
)
def dedupe_greedy_or(spark, sf_dir):
    rows = links(spark, sf_dir).select(
        "ord", (F.col("page_id") % 97).alias("a"), ((F.col("page_id") * 31 + F.col("variant") * 7) % 89).alias("b")
    )
    return dedupe.greedy_by_either_key(rows, "a", "b", "ord").select("ord")


@query(
    "dedupe_stats",
    f"""WITH {{links}}, k AS (SELECT ord, row_number() OVER (PARTITION BY {s_normalize_url('link')} ORDER BY ord) AS rn FROM links)
    SELECT count(*) AS seen, count(*) FILTER (WHERE rn = 1) AS kept, count(*) FILTER (WHERE rn > 1) AS removed FROM k""",
)
def dedupe_stats(spark, sf_dir):
    rows = links(spark, sf_dir).select("ord", U.normalize_url("link").alias("k"))
    return dedupe.repeated_share(rows, rows.select("k").distinct())


@query(
    "first_n_per_group",
    f"""WITH {{art}}, {CONFIG} SELECT article_id, medium FROM art JOIN config USING (medium)
    QUALIFY row_number() OVER (PARTITION BY medium ORDER BY published DESC, ord) <= max_items""",
)
def first_n_per_group(spark, sf_dir):
    rows = art(spark, sf_dir).select("article_id", "medium", "published", "ord").join(media_config(spark, sf_dir), "medium")
    return ranking.first_n(rows, ["medium"], [F.col("published").desc(), "ord"], "max_items").select("article_id", "medium")


BUDGET = f"""lim AS (SELECT article_id, medium, display_order, ord, max_items, row_number() OVER (PARTITION BY medium ORDER BY ord) AS rn
      FROM art JOIN config USING (medium) WHERE enabled),
    top AS (SELECT * FROM lim WHERE rn <= max_items),
    sizes AS (SELECT medium, display_order, count(*) AS n FROM top GROUP BY ALL),
    room AS (SELECT medium, coalesce(sum(n) OVER (ORDER BY display_order, medium ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sizes)"""


@query(
    "budget_across_groups",
    f"""WITH {{art}}, {CONFIG}, {BUDGET} SELECT article_id, medium FROM top JOIN room USING (medium) WHERE rn <= 50 - before""",
)
def budget_across_groups(spark, sf_dir):
    cfg = media_config(spark, sf_dir).where("enabled")
    rows = art(spark, sf_dir).select("article_id", "medium", "ord").join(cfg, "medium")
    limited = ranking.first_n(rows, ["medium"], ["ord"], "max_items")
    return ranking.budget_across_groups(limited, "medium", ["display_order"], ["ord"], K.ITEMS_TOTAL).select(
        "article_id", "medium"
    )


@query(
    "rank_with_ties",
    f"WITH {{art}}, {SCORED} SELECT article_id, score FROM scored QUALIFY rank() OVER (ORDER BY score DESC) <= 5",
)
def rank_with_ties(spark, sf_dir):
    return ranking.with_ties(scored(spark, sf_dir).select("article_id", "score"), "score", 5)


@query(
    "rank_with_ties_per_medium",
    f"WITH {{art}}, {SCORED} SELECT article_id, medium, score FROM scored QUALIFY rank() OVER (PARTITION BY medium ORDER BY score DESC) <= 3",
)
def rank_with_ties_per_medium(spark, sf_dir):
    rows = scored(spark, sf_dir).select("article_id", "medium", "score")
    return ranking.with_ties(rows, "score", 3, ["medium"]).select("article_id", "medium", "score")


@query(
    "last_wins",
    "WITH {store} SELECT split_part(url, '/', 3) AS host, ord, page_id FROM store QUALIFY row_number() OVER (PARTITION BY split_part(url, '/', 3) ORDER BY ord DESC) = 1",
)
def last_wins(spark, sf_dir):
    rows = store(spark, sf_dir).withColumn("host", F.split_part("url", F.lit("/"), F.lit(3)))
    return ranking.keep_last(rows, ["host"], "ord").select("host", "ord", "page_id")


@query(
    "batch_number",
    """WITH {art}, d AS (SELECT title, min(ord) AS first_seen FROM art GROUP BY 1)
    SELECT title, first_seen, CAST((row_number() OVER (ORDER BY first_seen) - 1) // 30 AS BIGINT) AS batch FROM d""",
)
def batch_number(spark, sf_dir):
    return numbering.with_batch(art(spark, sf_dir), "title", "ord", K.TRANSLATION_BATCH)


@query(
    "attempt_budget",
    """WITH {entries}, a AS (SELECT site, ord, k % 3 = 0 AS ok, row_number() OVER (PARTITION BY site ORDER BY ord) AS rn FROM entries),
    w AS (SELECT *, coalesce(sum(CAST(ok AS INTEGER)) OVER (PARTITION BY site ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wins FROM a)
    SELECT site, ord FROM w WHERE rn <= 40 AND wins < 8""",
)
def attempt_budget(spark, sf_dir):
    rows = entries(spark, sf_dir).select("site", "ord", (F.col("k") % 3 == 0).alias("ok"))
    return ranking.attempt_budget(rows, "site", ["ord"], "ok", max_successes=8).select("site", "ord")


# ---- T ----

TOP_MEDIUM = f"""{SCORED}, top_medium AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY medium
      ORDER BY CASE WHEN score >= 1 THEN 0 ELSE 1 END, strftime(published, '%Y-%m-%d %H:%M') DESC, ord) <= 15)"""


@query("top_per_medium", f"WITH {{art}}, {TOP_MEDIUM} SELECT article_id, medium, score FROM top_medium")
def top_per_medium(spark, sf_dir):
    return ranking.top_per_medium(scored(spark, sf_dir)).select("article_id", "medium", "score")


@query(
    "digest_order",
    f"""WITH {{art}}, {TOP_MEDIUM} SELECT article_id, row_number() OVER (ORDER BY score DESC, strftime(published, '%Y-%m-%d %H:%M') DESC, ord) - 1 AS position FROM top_medium""",
)
def digest_order(spark, sf_dir):
    top = ranking.top_per_medium(scored(spark, sf_dir).drop("body"))
    minute = F.date_format("published", "yyyy-MM-dd HH:mm")
    return numbering.with_position(top, [F.col("score").desc(), minute.desc(), F.col("ord")]).select("article_id", "position")


@query(
    "display_order",
    f"WITH {CONFIG} SELECT medium, display_order, row_number() OVER (ORDER BY display_order, medium) - 1 AS position FROM config",
)
def display_order(spark, sf_dir):
    cfg = media_config(spark, sf_dir)
    return numbering.with_position(cfg, ["display_order", "medium"]).select("medium", "display_order", "position")


CANDIDATES = f"""cand AS (SELECT article_id, ord, title, url, CASE WHEN ord % 17 = 0 THEN NULL ELSE CAST(score * 2 + ord % 3 - 1 AS DOUBLE) END AS importance_score,
      CAST(ord % 4 AS INTEGER) AS priority, CAST(length(body) AS INTEGER) AS text_length, strftime(published, '%Y%m%d') AS issue_date,
      strftime(published, '%Y-%m-%d') AS published_at, {s_any('body', ['スポーツ', '芸能', '俳優'])} AS exclude_candidate FROM scored)"""


def candidates(spark, sf_dir):
    s = scored(spark, sf_dir)
    return s.select(
        "article_id", "ord", "title", "url",
        F.when(F.col("ord") % 17 != 0, (F.col("score") * 2 + F.col("ord") % 3 - 1).cast("double")).alias("importance_score"),
        (F.col("ord") % 4).cast("int").alias("priority"),
        F.length("body").alias("text_length"),
        F.date_format("published", "yyyyMMdd").alias("issue_date"),
        F.date_format("published", "yyyy-MM-dd").alias("published_at"),
        T.contains_any("body", ["スポーツ", "芸能", "俳優"]).alias("exclude_candidate"),
    )


def held_candidates(spark, sf_dir):
    return selection.score_table(candidates(spark, sf_dir), "article_id")


WITH_CANDIDATES = f"WITH {{art}}, {SCORED}, {CANDIDATES}"


@query(
    "scored_order",
    f"""{WITH_CANDIDATES} SELECT article_id, row_number() OVER (ORDER BY exclude_candidate, coalesce(importance_score, 0) DESC, priority DESC, text_length DESC, ord) - 1 AS position FROM cand""",
)
def scored_order(spark, sf_dir):
    rows = candidates(spark, sf_dir).withColumn("importance_score", F.coalesce("importance_score", F.lit(0.0)))
    return numbering.with_position(rows, selection.scored_order()).select("article_id", "position")


REPORT_ORDER = "importance_score DESC, priority DESC, issue_date DESC, title DESC, ord"
POOL_ORDER = "importance_score DESC, priority DESC, published_at, title, ord"


@query(
    "select_report_ties",
    f"""{WITH_CANDIDATES} SELECT article_id FROM cand WHERE importance_score >= (SELECT min(importance_score) FROM
      (SELECT importance_score FROM cand WHERE importance_score IS NOT NULL ORDER BY importance_score DESC LIMIT 5))""",
)
def select_report_ties(spark, sf_dir):
    return selection.select_report(held_candidates(spark, sf_dir)).select("article_id")


@query("select_report", f"{WITH_CANDIDATES} SELECT article_id FROM cand WHERE importance_score IS NOT NULL ORDER BY {REPORT_ORDER} LIMIT 5")
def select_report(spark, sf_dir):
    return selection.select_report(candidates(spark, sf_dir), include_ties=False).select("article_id")


@query("select_report_threshold", f"{WITH_CANDIDATES} SELECT article_id FROM cand WHERE importance_score >= 5")
def select_report_threshold(spark, sf_dir):
    return selection.select_report(candidates(spark, sf_dir), mode="threshold").select("article_id")


POOL = """pool_in AS (SELECT * FROM cand WHERE importance_score IS NOT NULL AND NOT exclude_candidate),
    pool AS (SELECT * FROM pool_in WHERE importance_score > 0 OR (SELECT count(*) FROM pool_in WHERE importance_score > 0) < 5)"""


@query("select_report_pool", f"{WITH_CANDIDATES}, {POOL} SELECT article_id FROM pool ORDER BY {POOL_ORDER} LIMIT 5")
def select_report_pool(spark, sf_dir):
    return selection.select_from_pool(held_candidates(spark, sf_dir), include_ties=False).select("article_id")


@query(
    "select_report_pool_ties",
    f"{WITH_CANDIDATES}, {POOL} SELECT article_id FROM pool QUALIFY rank() OVER (ORDER BY importance_score DESC) <= 5",
)
def select_report_pool_ties(spark, sf_dir):
    return selection.select_from_pool(held_candidates(spark, sf_dir)).select("article_id")


@query(
    "selected_semi",
    f"""{WITH_CANDIDATES}, sel AS (SELECT DISTINCT url FROM (SELECT url FROM cand WHERE importance_score IS NOT NULL ORDER BY {REPORT_ORDER} LIMIT 5))
    SELECT article_id, sel.url IS NOT NULL AS included, CASE WHEN sel.url IS NOT NULL THEN 'top_importance_rank_or_tie' ELSE '' END AS why,
      CASE WHEN sel.url IS NULL THEN 'below_top_rank_cutoff' ELSE '' END AS why_not FROM cand LEFT JOIN sel ON sel.url = cand.url""",
)
def selected_semi(spark, sf_dir):
    rows = held_candidates(spark, sf_dir)
    marked = selection.mark_selected(rows, selection.select_report(rows, include_ties=False))
    return marked.select(
        "article_id",
        F.col("included_in_report").alias("included"),
        F.col("report_selection_reason").alias("why"),
        F.col("report_excluded_reason").alias("why_not"),
    )


@query(
    "selection_log",
    f"""{WITH_CANDIDATES}, {POOL}, sel AS (SELECT * FROM pool ORDER BY {POOL_ORDER} LIMIT 5)
    SELECT 'top_importance_rank' AS mode, (SELECT count(*) FROM pool_in) AS candidates, count(*) AS selected, min(importance_score) AS cutoff,
      string_agg(title, '|' ORDER BY {POOL_ORDER}) AS titles, string_agg(CAST(CAST(importance_score AS INTEGER) AS VARCHAR), '|' ORDER BY {POOL_ORDER}) AS scores,
      greatest(0, (SELECT count(*) FROM pool_in) - count(*)) AS excluded FROM sel""",
)
def selection_log(spark, sf_dir):
    rows = held_candidates(spark, sf_dir)
    pool = rows.where(F.col("importance_score").isNotNull() & ~F.col("exclude_candidate"))
    chosen = selection.select_from_pool(rows, include_ties=False)
    log = selection.selection_log(pool, chosen, selection.pool_order(), None, "top_importance_rank")
    return log.select(
        F.col("report_selection_mode").alias("mode"),
        F.col("report_candidate_count").alias("candidates"),
        F.col("report_selected_count").alias("selected"),
        F.col("report_cutoff_importance_score").alias("cutoff"),
        F.array_join("selected_article_titles", "|").alias("titles"),
        F.array_join(F.transform("selected_article_scores", lambda s: s.cast("int").cast("string")), "|").alias("scores"),
        F.col("excluded_article_count").alias("excluded"),
    )
