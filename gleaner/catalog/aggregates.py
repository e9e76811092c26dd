"""Run summaries, sections, set operations and upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.catalog.base import AS_OF, art, entries, query, s_any, s_normalize_url, s_strip, store, table
from gleaner.catalog.filter_rules import CONFIG, RAW_RULES, live_rules, media_config
from gleaner.catalog.joins import LINKED, NG, RULE_SCORE, RULE_SQL, SCORING, asked, linked, rule_scores
from gleaner.catalog.quality_gates import ACCEPTED, VALIDATED, accepted
from gleaner.catalog.time_windows import DECISION, decided
from gleaner.catalog.windows_and_sorts import BEST, SCORED, TOP_MEDIUM, best_bodies, scored
from gleaner.functions import dates as D
from gleaner.functions import text as T
from gleaner.functions import urls as U
from gleaner.operators import digest, ranking, stats
from gleaner.operators import store as S
from gleaner.operators.quality import wall_hits

FAILED = "starts_with(outcome, 'failed:')"


@query(
    "fetch_summary",
    f"""WITH {{art}}, {VALIDATED}, {ACCEPTED} SELECT count(*) AS attempted, count(*) FILTER (WHERE starts_with(outcome, 'success')) AS fetch_success,
      count(*) FILTER (WHERE {FAILED}) AS fetch_failed, count(*) FILTER (WHERE starts_with(outcome, 'excluded:')) AS excluded,
      count(*) FILTER (WHERE {FAILED} AND text_length = 0) AS empty_body, count(*) FILTER (WHERE {FAILED} AND text_length BETWEEN 1 AND 119) AS too_short,
      count(*) FILTER (WHERE {FAILED} AND {s_any('clean', K.LOGIN_MARKERS)}) AS login_wall, count(*) FILTER (WHERE {FAILED} AND {s_any('clean', K.PAID_MARKERS)}) AS paid_wall,
      count(*) FILTER (WHERE {FAILED} AND {s_any('clean', K.ACCESS_MARKERS)}) AS access_denied,
      count(*) FILTER (WHERE starts_with(outcome, 'success') AND ord % 4 = 0) AS backfill_success, count(*) FILTER (WHERE {FAILED} AND ord % 4 = 0) AS backfill_failed FROM ab""",
)
def fetch_summary(spark, sf_dir):
    rows = accepted(spark, sf_dir).withColumn("w", wall_hits("clean_text"))
    flagged = rows.select(
        "outcome",
        F.length("clean_text").alias("text_length"),
        (F.size("w.login") > 0).alias("login_wall"),
        (F.size("w.paid") > 0).alias("paid_wall"),
        (F.size("w.access") > 0).alias("access_denied"),
        F.when(F.col("ord") % 4 == 0, F.lit("backfill")).otherwise(F.lit("new")).alias("origin"),
    )
    return stats.fetch_summary(flagged)


REASONS = f"""why AS (SELECT CASE WHEN {FAILED} AND ord % 7 <> 0 THEN substring(outcome, 8) ELSE '' END AS reason, CASE WHEN ord % 5 = 0 THEN 'TimeoutError' ELSE '' END AS error_type FROM ab),
    counts AS (SELECT coalesce(nullif(reason, ''), nullif(error_type, ''), 'unknown') AS reason, count(*) AS n FROM why GROUP BY 1)"""


def reason_table(spark, sf_dir):
    o = F.col("ord")
    rows = accepted(spark, sf_dir).select(
        F.when(F.col("outcome").startswith("failed:") & (o % 7 != 0), F.expr("substring(outcome, 8)")).otherwise(F.lit("")).alias("reason"),
        F.when(o % 5 == 0, F.lit("TimeoutError")).otherwise(F.lit("")).alias("error_type"),
    )
    return stats.reason_counts(rows, "reason", "error_type")


@query("failure_reason_counts", f"WITH {{art}}, {VALIDATED}, {ACCEPTED}, {REASONS} SELECT reason, n FROM counts")
def failure_reason_counts(spark, sf_dir):
    return reason_table(spark, sf_dir)


@query(
    "failure_reason_map",
    f"WITH {{art}}, {VALIDATED}, {ACCEPTED}, {REASONS} SELECT string_agg(reason || '=' || n, ',' ORDER BY reason) AS counts FROM counts",
)
def failure_reason_map(spark, sf_dir):
    m = stats.reason_map(reason_table(spark, sf_dir))
    pairs = F.transform(F.array_sort(F.map_entries("failure_reason_counts")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return m.select(F.array_join(pairs, ",").alias("counts"))


@query("decision_rollup", f"WITH {{entries}}, {DECISION} SELECT site, decision, count(*) AS n FROM decided GROUP BY ROLLUP (site, decision)")
def decision_rollup(spark, sf_dir):
    return stats.decision_rollup(decided(spark, sf_dir), "site", "decision")


@query(
    "score_summary",
    f"""WITH {{art}}, {RULE_SQL}, {SCORING}, {RULE_SCORE} SELECT count(*) AS articles, coalesce(max(score), 0.0) AS max_score, coalesce(min(score), 0.0) AS min_score,
      round(coalesce(avg(score), 0.0), 6) AS avg_score, count(*) FILTER (WHERE tags <> '') AS with_match, count(*) FILTER (WHERE {s_strip('body')} = '' AND {s_strip('title')} <> '') AS title_only FROM rule_scored""",
)
def score_summary(spark, sf_dir):
    rows = rule_scores(spark, sf_dir)
    title_only = (T.strip("text") == "") & (T.strip("source_title") != "")
    out = stats.score_summary(rows, "importance_score", F.size("matched_rules") > 0, title_only)
    return out.withColumn("avg_score", F.round("avg_score", 6))


_KWS = f"""list_filter(list_transform(regexp_split_to_array(regexp_replace(replace(keywords, chr(13) || chr(10), chr(10)), '(?i){K.WS}*OR{K.WS}*', chr(10), 'g'), '[\\n,、;|　]+'),
      lambda x: {s_strip('x')}), lambda x: x <> '')"""


@query(
    "rules_by_type",
    f"""WITH {RAW_RULES} SELECT CASE WHEN kind = '' THEN '(empty)' ELSE kind END AS rule_type, count(*) AS rules, CAST(sum(len({_KWS})) AS BIGINT) AS keywords FROM live_rules GROUP BY 1""",
)
def rules_by_type(spark, sf_dir):
    rules = live_rules(spark, sf_dir).withColumn("words", T.split_keywords("keywords"))
    return stats.rules_by_type(rules, "kind", "words")


@query(
    "distinct_keys",
    f"""WITH {{art}} SELECT count(DISTINCT title) AS titles, count(DISTINCT medium || '/' || lang) AS tags, count(DISTINCT url) AS urls FROM art""",
)
def distinct_keys(spark, sf_dir):
    """All three counts in one pass over the articles."""
    return art(spark, sf_dir).agg(
        F.count_distinct("title").alias("titles"), F.count_distinct(F.concat_ws("/", "medium", "lang")).alias("tags"),
        F.count_distinct("url").alias("urls"),
    )


RANGE = """SELECT min(CAST(o_orderdate AS DATE)) - 2 AS low, max(CAST(o_orderdate AS DATE)) + 2 AS high FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 480000"""


@query(
    "key_range",
    f"WITH r AS ({RANGE}) SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders, r WHERE CAST(o_orderdate AS DATE) BETWEEN low AND high",
)
def key_range(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    batch = o.where((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 480000)).select(F.date_format("o_orderdate", "yyyyMMdd").alias("issue_date"))
    low, high = S.date_range(batch, "issue_date", buffer_days=2)
    rows = o.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return rows.where((F.col("day") >= low) & (F.col("day") <= high))


@query(
    "digest_sections",
    f"""WITH {{art}}, {TOP_MEDIUM}, {CONFIG}, t AS (SELECT * FROM top_medium WHERE score >= 2)
    SELECT medium, count(article_id) AS item_count, string_agg(title, '|' ORDER BY ord) AS titles FROM (SELECT DISTINCT medium FROM config) LEFT JOIN t USING (medium) GROUP BY medium""",
)
def digest_sections(spark, sf_dir):
    top = ranking.top_per_medium(scored(spark, sf_dir).drop("body")).where("score >= 2")
    out = digest.sections(top, media_config(spark, sf_dir).select("medium"), "medium", "ord", ["title", "url"])
    return out.select("medium", "item_count", F.array_join(F.transform("items", lambda i: i["title"]), "|").alias("titles"))


@query(
    "run_fingerprint",
    f"""WITH {{art}}, {TOP_MEDIUM} SELECT sha256('2024-01-30' || chr(30) || string_agg(url || chr(31) || title || chr(31) || medium, chr(30) ORDER BY ord)) AS fingerprint FROM top_medium""",
)
def run_fingerprint(spark, sf_dir):
    top = ranking.top_per_medium(scored(spark, sf_dir).drop("body"))
    return digest.fingerprint(top, ["ord"], ["url", "title", "medium"], F.lit("2024-01-30"))


_UP = ", ".join(
    f"h{i + 1} AS (SELECT p // 16 AS p, sha256(string_agg(h, chr(30) ORDER BY p)) AS h FROM h{i} GROUP BY p // 16)" for i in range(4)
)


@query(
    "run_fingerprint_tree",
    f"""WITH {{art}}, h0 AS (SELECT row_number() OVER (ORDER BY ord) - 1 AS p, sha256(concat_ws(chr(31), url, title, medium, body)) AS h FROM art), {_UP}
    SELECT sha256(concat_ws(chr(30), '2024-01-30', string_agg(h, chr(30) ORDER BY p))) AS fingerprint FROM h4""",
)
def run_fingerprint_tree(spark, sf_dir):
    """The fingerprint of every article with its body, hashed by tree."""
    return digest.tree_fingerprint(art(spark, sf_dir), ["ord"], ["url", "title", "medium", "body"], F.lit("2024-01-30"), fan_out=16, levels=4)


@query(
    "usage_totals",
    """SELECT count(*) FILTER (WHERE role = 'user') AS cache_hits, count(*) FILTER (WHERE role <> 'user') AS cache_misses, CAST(sum(turn % 3) AS BIGINT) AS api_calls,
      CAST(sum(length(text)) AS BIGINT) AS prompt_tokens, CAST(sum(length(text) // 2) AS BIGINT) AS completion_tokens,
      CAST(sum(length(text)) + sum(length(text) // 2) AS BIGINT) AS total_tokens FROM conversations""",
)
def usage_totals(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return stats.usage_totals(
        c.select(
            (F.col("role") == "user").alias("hit"), (F.col("turn") % 3).alias("calls"),
            F.length("text").cast("bigint").alias("prompt_tokens"), F.floor(F.length("text") / 2).alias("completion_tokens"),
        )
    )


@query(
    "union_scoring_inputs",
    f"""WITH {{art}}, {BEST} SELECT ord, source, length(body) AS chars FROM best""",
)
def union_scoring_inputs(spark, sf_dir):
    from gleaner.operators import dedupe

    rows = art(spark, sf_dir).drop("article_id", "medium", "lang")
    saved = F.col("ord") % 4 == 0
    fetched = rows.where(~saved).withColumn("source", F.lit("new"))
    existing = rows.where(saved).drop("published").withColumn("source", F.lit("saved"))
    both = fetched.unionByName(existing, allowMissingColumns=True)
    return dedupe.best_body(both, "url", "body", "source", "ord", existing="saved").select(
        "ord", "source", F.length("body").cast("bigint").alias("chars")
    )


# Direct results of each site and search results for all of them; search counts only where direct found nothing.
@query(
    "direct_then_search",
    f"""WITH {{entries}}, d AS (SELECT site, ord, 'https://www.example.com/' || k AS url, published_utc FROM entries WHERE feed = 'click' AND site NOT IN ('site1', 'site2', 'site3')),
    status AS (SELECT site, CASE site WHEN 'site4' THEN '403' WHEN 'site1' THEN 'error' WHEN 'site2' THEN '200' ELSE '200' END AS st, count(d.ord) AS n FROM (SELECT DISTINCT site FROM entries) LEFT JOIN d USING (site) GROUP BY ALL),
    s AS (SELECT e.site, e.ord, 'https://www.example.com/' || k || '/' AS url FROM entries e JOIN status USING (site) WHERE feed = 'view' AND (st IN ('403', '404', 'error', 'not_attempted') OR n = 0)),
    u AS (SELECT site, ord, url, 0 AS part FROM d UNION ALL SELECT site, ord, url, 1 FROM s),
    f AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY site, {s_normalize_url('url')} ORDER BY part, ord) = 1)
    SELECT site, ord, part FROM f QUALIFY row_number() OVER (PARTITION BY site ORDER BY part, ord) <= 20""",
)
def direct_then_search(spark, sf_dir):
    from gleaner.operators.site_watch import direct_then_search as combine

    e = entries(spark, sf_dir)
    url = F.concat(F.lit("https://www.example.com/"), F.col("k").cast("string"))
    direct = e.where((F.col("feed") == "click") & ~F.col("site").isin("site1", "site2", "site3")).select("site", "ord", url.alias("url"))
    search = e.where(F.col("feed") == "view").select("site", "ord", F.concat(url, F.lit("/")).alias("url"))
    status = F.when(F.col("site") == "site4", F.lit("403")).when(F.col("site") == "site1", F.lit("error")).otherwise(F.lit("200"))
    sites = e.select("site").distinct().withColumn("direct_status", status).withColumn("fetch_mode", F.lit("direct_then_search"))
    return combine(sites, direct, search, max_items=20).select("site", "ord", "part")


# Saving: rows that know their page, rows found by URL or id, new rows, and rows whose write failed.
SAVES = f"""{LINKED}, ix AS (SELECT k, arg_max(page_id, ord) AS pid FROM (SELECT url AS k, page_id, ord FROM linked UNION ALL
        SELECT {NG.format(u='url')}, page_id, ord FROM linked) WHERE k <> '' GROUP BY k),
    res AS (SELECT n, asked.url, CASE WHEN own <> '' THEN own ELSE coalesce(a.pid, b.pid, '') END AS pid, CASE WHEN n % 11 = 5 THEN 'HTTP 500' ELSE '' END AS error FROM asked
      LEFT JOIN ix a ON a.k = asked.url LEFT JOIN ix b ON b.k = {NG.format(u='asked.url')}),
    acts AS (SELECT n, url, error, CASE WHEN error <> '' THEN 'failed' WHEN pid <> '' THEN 'updated' ELSE 'created' END AS action,
      CASE WHEN pid <> '' OR error <> '' THEN pid ELSE 'new-' || left(sha256(n || '|' || url), 16) END AS page_id FROM res)"""


def saves(spark, sf_dir):
    n = F.col("n")
    rows = asked(spark, sf_dir).select(
        "n", "url", "page_id",
        F.when(n % 11 == 5, F.lit("HTTP 500")).otherwise(F.lit("")).alias("error"),
        F.when(n % 4 != 2, F.concat(F.lit("Title "), n.cast("string"))).alias("title"),
    )
    saved = linked(spark, sf_dir).withColumn("title", F.concat(F.lit("Old "), F.col("ord").cast("string")))
    return S.upsert(saved, rows, "n", ["title"])


@query(
    "upsert_store",
    f"""WITH {SAVES}, last AS (SELECT page_id, n FROM acts WHERE action = 'updated' QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY n DESC) = 1)
    SELECT l.page_id, l.url, coalesce(CASE WHEN last.n % 4 <> 2 THEN 'Title ' || last.n END, 'Old ' || ord) AS title FROM linked l LEFT JOIN last ON last.page_id = l.page_id
    UNION ALL SELECT page_id, url, CASE WHEN n % 4 <> 2 THEN 'Title ' || n END FROM acts WHERE action = 'created'""",
)
def upsert_store(spark, sf_dir):
    return saves(spark, sf_dir)[0].select("page_id", "url", "title")


@query("upsert_outcomes", f"WITH {SAVES} SELECT n, url, page_id, action, action <> 'failed' AS ok, error FROM acts")
def upsert_outcomes(spark, sf_dir):
    return saves(spark, sf_dir)[1]


@query(
    "persist_state",
    """WITH {entries}, k AS (SELECT ord, site || '|id|' || k AS key, published_utc FROM entries),
    old AS (SELECT DISTINCT key FROM k WHERE published_utc < TIMESTAMP '2024-01-15 00:00:00')
    SELECT key, min(ord) AS ord FROM k WHERE published_utc >= TIMESTAMP '2024-01-15 00:00:00' AND key NOT IN (SELECT key FROM old) GROUP BY key""",
)
def persist_state(spark, sf_dir):
    from gleaner.operators.state import remember, unseen

    rows = entries(spark, sf_dir).select(
        "ord", "published_utc", U.store_dedupe_key("site", F.col("k").cast("string"), F.lit(""), F.lit(""), F.lit("")).alias("key")
    )
    cut = D.ntz("2024-01-15 00:00:00")
    state = remember(None, rows.where(F.col("published_utc") < cut), "key", "ord")
    return unseen(rows.where(F.col("published_utc") >= cut), state, "key", "ord").select("key", "ord")
