"""The four jobs end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.catalog.base import ART, art, entries, pick, query, s_any, s_normalize_url, s_part, s_strip, s_title_key, s_url_key, sql_text, table
from gleaner.catalog.filter_rules import HR_PATTERN, PRE_PATTERN
from gleaner.catalog.filter_rules import MEDIA as TRANSLATED
from gleaner.catalog.joins import RULE_SCORE, RULE_SQL, SCORING, rule_table, scoring_input
from gleaner.catalog.markup import s_entities
from gleaner.catalog.quality_gates import ACCEPTED, CAPTURED, HR_SQL, SELECTORS, VALIDATED
from gleaner.catalog.windows_and_sorts import s_bucket
from gleaner.functions import dates as D
from gleaner.functions import urls as U
from gleaner.operators import ranking, shaping
from gleaner.plans import general_digest as general
from gleaner.plans import issue_report as issue
from gleaner.plans import site_digest as site
from gleaner.plans import special_digest as special
from gleaner.session import cut_lineage

DAY = "2024-01-01 12:00:00"


def feed_entries(spark, sf_dir):
    """Articles as feed entries: five feeds for each medium, newest first."""
    return art(spark, sf_dir).select(
        "medium",
        F.concat(F.col("medium"), F.lit("/"), F.col("lang")).alias("feed"),
        F.ascii("lang").cast("int").alias("feed_ord"),
        (-F.col("ord")).alias("entry_ord"),
        F.concat(F.lit("<b>"), "title", F.lit("</b>")).alias("title"),
        F.col("body").alias("summary"),
        F.col("url").alias("link"),
        F.when(F.col("ord") % 10 != 0, F.col("published")).alias("published_parsed"),
        F.when(F.col("ord") % 20 != 0, F.col("published")).alias("updated_parsed"),
    )


GENERAL = f"""WITH {{art}}, e AS (SELECT medium, medium || '/' || lang AS feed, ascii(lang) AS feed_ord, -ord AS entry_ord, trim(regexp_replace('<b>' || title || '</b>', '<[^<]+?>', '', 'g')) AS title,
      trim(regexp_replace(body, '<[^<]+?>', '', 'g'), ' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(12288)) AS summary, url AS link, CASE WHEN ord % 20 <> 0 THEN published END AS t FROM art),
    f AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY medium, feed ORDER BY entry_ord) <= 15),
    w AS (SELECT * FROM f WHERE t >= TIMESTAMP '{DAY}' - INTERVAL 24 HOUR AND (medium <> 'src3' OR NOT ({s_any('title', K.NOISE_TERMS)} OR {s_any('summary', K.NOISE_TERMS)}))),
    d AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY medium, {s_url_key('link')}, {s_title_key('title')} ORDER BY feed_ord, entry_ord) = 1),
    s AS (SELECT *, {s_bucket('lower(title || summary)')} AS score, strftime(t + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M') AS published FROM d)
    SELECT medium, title, score, published, link FROM s
    QUALIFY row_number() OVER (PARTITION BY medium ORDER BY CASE WHEN score >= 1 THEN 0 ELSE 1 END, published DESC, feed_ord, entry_ord) <= 15"""


@query("general_digest", GENERAL)
def general_digest(spark, sf_dir):
    return general.build(feed_entries(spark, sf_dir), D.ntz(DAY), noise_medium="src3")


# Every other entry has an English title; a third of those titles were translated before, a third got an answer, half of them unusable.
ENGLISH = "CASE WHEN ord % 2 = 1 THEN 'Report ' || ord % 101 || ' of ' || medium ELSE title END"


@query(
    "general_digest_translated",
    f"""WITH digest AS ({GENERAL.replace("'<b>' || title || '</b>'", ENGLISH)}),
    asked AS (SELECT *, CASE WHEN starts_with(title, 'Report ') THEN CAST(split_part(title, ' ', 2) AS INTEGER) END AS n FROM digest)
    SELECT medium, title, CASE WHEN n IS NOT NULL AND medium IN ({', '.join(sql_text(m) for m in TRANSLATED)})
      THEN CASE WHEN n % 3 = 0 THEN 'cached ' || title WHEN n % 3 = 1 AND n % 2 = 1 THEN 'new ' || title ELSE title END ELSE title END AS title_ja, published, link FROM asked""",
)
def general_digest_translated(spark, sf_dir):
    n = -F.col("entry_ord") % 101
    english = F.concat(F.lit("Report "), n.cast("string"), F.lit(" of "), F.col("medium"))
    rows = feed_entries(spark, sf_dir).withColumn("title", F.when(F.col("entry_ord") % 2 != 0, english).otherwise(F.col("title")))
    titles = rows.where(F.col("entry_ord") % 2 != 0).select(F.col("title").alias("key"), n.alias("n")).distinct()
    cache = titles.where("n % 3 = 0").select("key", F.concat(F.lit("cached "), "key").alias("translated"))
    answer = F.when(F.col("n") % 2 == 1, F.concat(F.lit("new "), "key")).otherwise(F.lit(" "))
    digest = general.build(rows, D.ntz(DAY), noise_medium="src3")
    out = general.translated(digest, cache, titles.where("n % 3 = 1").select("key", answer.alias("translated")), TRANSLATED)
    return out.select("medium", "title", "title_ja", "published", "link")


# ---- specialist feeds: five media, one rule each ----

MEDIA = [
    # medium, order, limit, source, pattern, zone, granularity, mode, hours, fallback, fallback pattern
    ("click", 3, 12, "rss", "", "Asia/Tokyo", "datetime", "rolling_24h", 24, "", ""),
    ("view", 1, 8, "url", r"/(\d{4})-(\d{2})-(\d{2})/", "Asia/Tokyo", "date", "calendar_day", 24, "", ""),
    ("purchase", 2, 20, "article_html", r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}", "UTC", "datetime", "rolling_24h", 72, "rss", ""),
    ("signup", 5, 20, "meta", r"\d{4}-\d{2}-\d{2}", "UTC", "date", "calendar_day", 24, "", ""),
    ("error", 4, 10, "json_ld", "x", "UTC", "date", "calendar_day", 24, "url", r"\d{4}-\d{2}-\d{2}"),
]
MEDIA_SCHEMA = (
    "medium string, display_order int, max_items int, date_source_type string, date_parse_pattern string, date_timezone string, "
    "date_granularity string, target_date_mode string, lookback_hours int, fallback_date_source_type string, fallback_date_parse_pattern string"
)
RUN = "2024-01-30 12:00:00"


def special_inputs(spark, sf_dir):
    """(entries, media, captures) from every event."""
    e, t = entries(spark, sf_dir), F.col("published_utc")
    link = F.concat(F.lit("https://n.example.com/"), D.day_text("published_utc"), F.lit("/"), F.col("ord").cast("string"))
    none = F.lit(None).cast("timestamp_ntz")
    rows = e.select(
        F.col("feed").alias("medium"), F.lit(0).alias("feed_ord"), F.col("ord").alias("entry_ord"), "title", link.alias("link"),
        F.when(F.col("k") % 5 != 0, F.date_trunc("second", t).cast("timestamp_ntz")).alias("published_parsed"),
        none.alias("updated_parsed"), F.lit("").alias("published"), F.lit("").alias("updated"),
    )
    meta = F.concat(F.lit('<meta property="article:published_time" content="'), F.replace(D.minute_text(t), F.lit(" "), F.lit("T")), F.lit('"><p>x</p>'))
    captures = e.select(
        link.alias("url"), link.alias("final_url"), F.lit("").alias("canonical_url"),
        F.when(F.col("k") % 2 == 0, meta).otherwise(F.lit("<p>x</p>")).alias("html"), F.lit("").alias("ld_date"),
        F.lit(False).alias("sel_found"), F.lit("").alias("sel_attr"), F.lit("").alias("sel_text"),
    )
    media = spark.createDataFrame(MEDIA, MEDIA_SCHEMA).withColumn("date_css_selector", F.lit(""))
    return rows, media, captures


MEDIA_SQL = "media(medium, display_order, max_items) AS (VALUES " + ", ".join(f"('{m[0]}', {m[1]}, {m[2]})" for m in MEDIA) + ")"
SPECIAL = f"""{MEDIA_SQL}, e AS (SELECT ord, feed AS medium, title, k, published_utc AS t, 'https://n.example.com/' || strftime(published_utc, '%Y-%m-%d') || '/' || ord AS link,
      CASE WHEN k % 5 <> 0 THEN date_trunc('second', published_utc) END AS rss FROM entries),
    p AS (SELECT *, CASE medium WHEN 'click' THEN rss WHEN 'view' THEN date_trunc('day', t) - INTERVAL 9 HOUR
        WHEN 'purchase' THEN CASE WHEN k % 2 = 0 THEN date_trunc('minute', t) ELSE rss END
        WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN date_trunc('day', t) END ELSE date_trunc('day', t) END AS at FROM e),
    d AS (SELECT *, CASE WHEN at IS NULL THEN 'extraction_failed'
        WHEN medium IN ('view', 'signup', 'error') THEN CASE WHEN CAST(date_trunc('day', t) AS DATE) IN (DATE '2024-01-30', DATE '2024-01-29') THEN 'accepted' ELSE 'target_date_mismatch' END
        WHEN at >= TIMESTAMP '{RUN}' - CASE medium WHEN 'purchase' THEN INTERVAL 72 HOUR ELSE INTERVAL 24 HOUR END AND at < TIMESTAMP '{RUN}' THEN 'accepted' ELSE 'out_of_window' END AS decision FROM p)""".replace(
    " AS at ", " AS moment "
).replace("WHEN at ", "WHEN moment ").replace("AND at ", "AND moment ")


@query("special_decisions", f"WITH {{entries}}, {SPECIAL} SELECT ord, decision FROM d")
def special_decisions(spark, sf_dir):
    rows, media, captures = special_inputs(spark, sf_dir)
    return special.decisions(rows, media, captures, D.ntz(RUN)).select(F.col("entry_ord").alias("ord"), "decision")


SPECIAL_ITEMS = f"""{SPECIAL}, u AS (SELECT *, {s_title_key('title')} AS key FROM d WHERE decision = 'accepted'),
    f AS (SELECT * FROM u WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY medium, key ORDER BY ord) = 1),
    n AS (SELECT *, row_number() OVER (PARTITION BY medium ORDER BY ord) AS rn FROM f),
    l AS (SELECT * FROM n JOIN media USING (medium) WHERE rn <= max_items),
    s AS (SELECT medium, display_order, count(*) AS c FROM l GROUP BY ALL),
    b AS (SELECT medium, coalesce(sum(c) OVER (ORDER BY display_order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s),
    kept AS (SELECT medium, ord, title, link, CASE WHEN medium IN ('view', 'signup', 'error') THEN strftime(t, '%Y-%m-%d') WHEN medium = 'click' THEN strftime(moment + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M')
      ELSE strftime(moment, '%Y-%m-%d %H:%M') END AS published FROM l JOIN b USING (medium) WHERE rn <= 30 - before)"""


@query("special_digest", f"WITH {{entries}}, {SPECIAL_ITEMS} SELECT medium, ord, title, link, published FROM kept")
def special_digest(spark, sf_dir):
    rows, media, captures = special_inputs(spark, sf_dir)
    kept = special.items(special.decisions(rows, media, captures, D.ntz(RUN)), 30)
    return kept.select("medium", F.col("entry_ord").alias("ord"), "title", "link", "published")


@query(
    "special_sections",
    f"""WITH {{entries}}, {SPECIAL_ITEMS} SELECT media.medium, display_order, count(ord) AS item_count,
      coalesce(string_agg(title || ' | ' || link || ' | ' || published, chr(10) ORDER BY ord), '') AS items
    FROM media LEFT JOIN kept USING (medium) GROUP BY ALL""",
)
def special_sections(spark, sf_dir):
    """The digest as it is sent: one section a medium, empty ones too."""
    rows, media, captures = special_inputs(spark, sf_dir)
    kept = special.items(special.decisions(rows, media, captures, D.ntz(RUN)), 30)
    line = lambda i: F.concat_ws(" | ", i["title"], i["link"], i["published"])
    items = F.coalesce(F.array_join(F.transform("items", line), "\n"), F.lit(""))
    return special.sections(kept, media).select("medium", "display_order", "item_count", items.alias("items"))


# ---- site watch: every host is a site whose listing pages are its captured pages ----


SITE_LINK = r'(?s)<a href="([^"]*)">(.*?)</a>'
SITE_NEXT = '<a class="next" href="/paged/@">more</a>'


@query(
    "site_digest",
    f"""WITH RECURSIVE p AS (SELECT page_id, url, html, regexp_replace(split_part(regexp_replace(lower({s_part('url', 2)}), '^.*@', ''), ':', 1), '^www[.]', '') AS site,
        {s_part('url', 1)} || '://' || {s_part('url', 2)} AS root FROM pages),
    visit AS (SELECT site, url AS start, 0 AS depth, root, html FROM p UNION ALL SELECT site, url, 1, root, '<a href="/paged/item' || page_id % 11 || '">Item ' || page_id % 11 || '</a>' FROM p WHERE page_id % 3 = 0),
    a AS (SELECT site, start, depth, root, unnest(regexp_extract_all(html, {sql_text(SITE_LINK)}, 1)) AS href, unnest(regexp_extract_all(html, {sql_text(SITE_LINK)}, 2)) AS body,
      generate_subscripts(regexp_extract_all(html, {sql_text(SITE_LINK)}, 1), 1) AS pos FROM visit),
    c AS (SELECT site, start, depth, pos, root || trim(href) AS url, {s_entities("regexp_replace(body, '(?s)<[^>]*>', ' ', 'g')")} AS title FROM a WHERE trim(href) <> ''),
    k AS (SELECT *, {s_normalize_url('url')} AS u FROM c),
    f AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY site, start, depth, u ORDER BY pos) = 1),
    s AS (SELECT * FROM f WHERE title <> '' QUALIFY row_number() OVER (PARTITION BY site, u ORDER BY start, depth, pos) = 1),
    five AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY site ORDER BY start, depth, pos) <= 5),
    g AS (SELECT *, lower(title) AS t, row_number() OVER (ORDER BY length(site) * 7 % 50, site, start, depth, pos) AS i FROM five),
    walk(i, us, ts, n, hit) AS (SELECT 0::BIGINT, []::VARCHAR[], []::VARCHAR[], 0, false
      UNION ALL SELECT g.i, CASE WHEN list_contains(us, u) OR list_contains(ts, t) THEN us ELSE list_append(us, u) END,
        CASE WHEN list_contains(us, u) OR list_contains(ts, t) THEN ts ELSE list_append(ts, t) END,
        n + CASE WHEN list_contains(us, u) OR list_contains(ts, t) THEN 0 ELSE 1 END, NOT (list_contains(us, u) OR list_contains(ts, t))
      FROM walk JOIN g ON g.i = walk.i + 1 WHERE n < 40)
    SELECT site, url, title, 'fetched_at' AS date_source, CAST(n - 1 AS BIGINT) AS position FROM walk JOIN g USING (i) WHERE hit""",
)
def site_digest(spark, sf_dir):
    """Every captured page is a listing page of its host's site, in the order of urls; every third goes on to a next page of its own."""
    n = F.col("page_id")
    site_, root = U.bare_host("url").alias("site"), F.concat(U.scheme("url"), F.lit("://"), U.authority("url"))
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html", site_, root.alias("root"))
    onward = F.replace(F.lit(SITE_NEXT), F.lit("@"), n.cast("string"))
    listing = p.select("url", F.concat(F.col("html"), F.when(n % 3 == 0, onward).otherwise(F.lit(""))).alias("html"))
    item = F.concat(F.lit('<a href="/paged/item'), n % 11, F.lit('">Item '), n % 11, F.lit("</a>"))
    paged = p.where(n % 3 == 0).select(F.concat("root", F.lit("/paged/"), n.cast("string")).alias("url"), item.alias("html"))
    raw = p.select("site").distinct().select(
        F.col("site").alias("site_name"), (F.length("site") * 7 % 50).alias("display_order"), F.lit("5").alias("max_items_per_site"), F.lit("40").alias("max_items_total"),
        F.lit("use_fetched_at").alias("date_fallback_mode"), F.lit("2").alias("max_pages"), F.lit("^(?!.*/paged/[0-9]+$)").alias("article_url_pattern"),
    )
    sites = cut_lineage(shaping.normalize_site_config(raw).withColumnRenamed("site_name", "site"))
    starts = p.select("site", F.col("url").alias("start"), "url")
    return site.build(sites, listing.unionByName(paged), D.ntz(RUN), starts).select("site", "url", "title", "date_source", "position")


# ---- newspaper issue: every article scored, the report's five chosen ----


@query(
    "issue_report",
    f"""WITH {{art}}, {RULE_SQL}, {SCORING}, {RULE_SCORE},
    pool_in AS (SELECT * FROM rule_scored WHERE exclude_reason = ''),
    pool AS (SELECT * FROM pool_in WHERE score > 0 OR (SELECT count(*) FROM pool_in WHERE score > 0) < 5)
    SELECT 'A' || row_number() OVER (ORDER BY score DESC, priority DESC, {s_strip('title')}, ord) AS ref_id, article_id, score FROM pool
    QUALIFY row_number() OVER (ORDER BY score DESC, priority DESC, {s_strip('title')}, ord) <= 5""",
)
def issue_report(spark, sf_dir):
    rows = scoring_input(spark, sf_dir).withColumn("issue_date", F.lit("20240101"))
    _, final = issue.score_and_select(rows, rule_table(spark), "article_id")
    return issue.report_input(final).select("ref_id", "article_id", F.col("importance_score").alias("score"))


# ---- newspaper issue from its links on: every article is a link, its page captured, every third saved before ----


BASE = ART.replace("art AS (", "base AS (", 1)
ISSUE_TARGETS = f"""{BASE},
    link AS (SELECT ord, title, CASE WHEN ord % 9 = 4 THEN 'https://news.example.com/other/?ng=N' || ord ELSE url END AS url FROM base),
    page AS (SELECT * FROM base QUALIFY row_number() OVER (PARTITION BY url ORDER BY ord) = 1),
    saved AS (SELECT 'pg-' || ord AS page_id, CASE WHEN (ord // 2) % 9 = 3 THEN 'https://m.example.com/paper/?ng=N' || (ord // 2) ELSE url END AS url,
      title, CASE WHEN (ord // 2) % 6 = 0 THEN '' ELSE body END AS text, regexp_extract(url, 'ng=(.*)', 1) AS ng FROM page WHERE (ord // 2) % 3 = 0),
    first_link AS (SELECT *, regexp_extract(url, 'ng=(.*)', 1) AS ng, CASE WHEN regexp_matches(title, '{PRE_PATTERN}') THEN 'pre_title_regex' WHEN regexp_matches(title, '{HR_PATTERN}') THEN 'pre_hr_like_title'
      WHEN length(title) <= 6 THEN 'pre_short_title' ELSE '' END AS left_out FROM link WHERE NOT contains(url, '/other/') QUALIFY row_number() OVER (PARTITION BY url ORDER BY ord) = 1),
    target AS (SELECT f.ord, f.url, f.ng, f.title, left_out, CASE WHEN left_out <> '' THEN 'left_out' WHEN k.ng IS NULL THEN 'new' WHEN {s_strip("coalesce(s.text, '')")} = '' THEN 'backfill' ELSE 'skipped' END AS action,
      coalesce(nullif(s.title, ''), f.title) AS saved_title, s.text AS saved_text FROM first_link f LEFT JOIN saved s ON s.url = f.url LEFT JOIN saved k ON k.ng = f.ng)"""
ISSUE_CAUGHT = """caught AS (SELECT t.ord AS article_id, t.ord, t.url, t.ng, action, p.body, t.title, t.title AS source_title,
      CASE (p.ord // 2) % 4 WHEN 0 THEN p.title || ' - 日本経済新聞' WHEN 1 THEN '朝刊・夕刊 3月12日付' WHEN 2 THEN left(p.title, CAST((length(p.title) + 1) // 2 AS INTEGER)) ELSE 'Unrelated page' END AS page_title
      FROM target t JOIN page p USING (url) WHERE action IN ('new', 'backfill'))"""
ISSUE_GATE = f"""{ISSUE_TARGETS}, judged AS (WITH {VALIDATED.replace(CAPTURED, ISSUE_CAUGHT)},
    {ACCEPTED.replace(HR_SQL, HR_SQL.replace('body', 'clean')).replace('ord % 5 = 1', '(ord // 2) % 5 = 1')} SELECT ord, url, ng, action, title, page_title, clean, outcome FROM ab)"""


def issue_tables(spark, sf_dir):
    """(links, saved pages, captures) from every article."""
    a, o = art(spark, sf_dir), F.col("ord")
    other = F.concat(F.lit("https://news.example.com/other/?ng=N"), o.cast("string"))
    links = a.select("ord", "title", F.when(o % 9 == 4, other).otherwise(F.col("url")).alias("url"), F.lit("20240101").alias("issue_date"))
    page, pair = ranking.keep_first(a, ["url"], ["ord"]), F.floor(o / 2)
    mobile = F.concat(F.lit("https://m.example.com/paper/?ng=N"), pair.cast("string"))
    saved = page.where(pair % 3 == 0).select(
        F.concat(F.lit("pg-"), o.cast("string")).alias("page_id"), F.when(pair % 9 == 3, mobile).otherwise(F.col("url")).alias("url"), "title",
        F.when(pair % 6 == 0, F.lit("")).otherwise(F.col("body")).alias("text"), F.lit("20240101").alias("issue_date"), F.lit("morning").alias("edition"), "ord",
    )
    half = F.left("title", F.ceil(F.length("title") / 2).cast("int"))
    page_title = (
        F.when(pair % 4 == 0, F.concat("title", F.lit(" - 日本経済新聞"))).when(pair % 4 == 1, F.lit("朝刊・夕刊 3月12日付"))
        .when(pair % 4 == 2, half).otherwise(F.lit("Unrelated page"))
    )
    captures = page.select("url", page_title.alias("page_title"), F.col("body").alias("text"), pick(pair, SELECTORS).alias("selector"))
    return links, saved, captures


@query(
    "issue_audit",
    f"""WITH {ISSUE_GATE} SELECT ord, action, CASE WHEN action = 'left_out' THEN left_out WHEN action = 'skipped' THEN '' ELSE outcome END AS outcome
    FROM target LEFT JOIN (SELECT ord, outcome FROM judged) USING (ord)""",
)
def issue_audit(spark, sf_dir):
    _, audit = issue.articles(*issue_tables(spark, sf_dir), "example.com", "/paper/article/")
    return audit.select("ord", "action", "outcome")


_TWICE, _BOTH = "title || chr(10) || title", "title || chr(10) || page_title"
ISSUE_SCORED = f"""{ISSUE_GATE}, art AS (SELECT ng AS article_id, ord, url, title, page_title, clean AS body, 'fetched' AS source FROM judged WHERE starts_with(outcome, 'success')
      UNION ALL SELECT ng, ord, url, saved_title, saved_title, saved_text, 'store_existing' FROM target WHERE action = 'skipped')"""


@query("issue_scoring_inputs", f"WITH {ISSUE_SCORED} SELECT article_id, ord, url, title AS source_title, page_title, md5(body) AS text_md5, source FROM art")
def issue_scoring_inputs(spark, sf_dir):
    articles, _ = issue.articles(*issue_tables(spark, sf_dir), "example.com", "/paper/article/")
    return articles.select("article_id", "ord", "url", "source_title", "page_title", F.md5("text").alias("text_md5"), "source")


@query(
    "issue_job",
    f"""WITH {ISSUE_SCORED}, {RULE_SQL}, {SCORING.replace(_TWICE, _BOTH)}, {RULE_SCORE.replace(_TWICE, _BOTH)},
    pool_in AS (SELECT * FROM rule_scored WHERE exclude_reason = ''),
    pool AS (SELECT * FROM pool_in WHERE score > 0 OR (SELECT count(*) FROM pool_in WHERE score > 0) < 5)
    SELECT 'A' || row_number() OVER (ORDER BY score DESC, priority DESC, {s_strip('title')}, ord) AS ref_id, article_id, score FROM pool
    QUALIFY row_number() OVER (ORDER BY score DESC, priority DESC, {s_strip('title')}, ord) <= 5""",
)
def issue_job(spark, sf_dir):
    """From the issue's links to the report's five: filter, store, body gate, scores, selection."""
    articles, _ = issue.articles(*issue_tables(spark, sf_dir), "example.com", "/paper/article/")
    _, final = issue.score_and_select(articles, rule_table(spark), "article_id")
    return issue.report_input(final).select("ref_id", "article_id", F.col("importance_score").alias("score"))
