"""URL and id functions over every written variant of every page's URL."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog.base import (
    links, query, s_article_key, s_collapse, s_normalize_link, s_normalize_url, s_part, s_title_key, s_url_key, sql_list,
    table,
)
from gleaner.functions import html as H
from gleaner.functions import urls as U

# Issue links shaped like a newspaper's: an id parameter, an id in the path, or neither.
ISSUE_LINK = (
    "CASE page_id % 4 "
    "WHEN 0 THEN concat('https://www.example.com/paper/article/?b=20240', page_id % 9 + 100, '&ng=DGKKZO', page_id / 8) "
    "WHEN 1 THEN concat('https://WWW.example.com//paper/article/DGXMZO', page_id + 1000, '/') "
    "WHEN 2 THEN concat('https://www.example.com/paper/other/?ng=', CASE WHEN page_id % 8 = 2 THEN '' ELSE 'K1' END) "
    "ELSE concat(url, '/DGXM', page_id + 10000) END"
)
ISSUE_SPARK = ISSUE_LINK.replace("page_id / 8", "page_id div 8")
ISSUE_SQL = ISSUE_LINK.replace("page_id / 8", "page_id // 8")


def issue_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.expr(ISSUE_SPARK).alias("link"))


ISSUES = f"issues AS (SELECT page_id, {ISSUE_SQL} AS link FROM pages)"


@query("normalize_link", f"WITH {{links}} SELECT ord, {s_normalize_link('link')} AS clean FROM links")
def normalize_link(spark, sf_dir):
    return links(spark, sf_dir).select("ord", U.normalize_link("link").alias("clean"))


@query("normalize_url", f"WITH {{links}} SELECT ord, {s_normalize_url('link')} AS clean FROM links")
def normalize_url(spark, sf_dir):
    return links(spark, sf_dir).select("ord", U.normalize_url("link").alias("clean"))


@query("dedupe_url_key", f"WITH {{links}} SELECT ord, {s_url_key('link')} AS url_key FROM links")
def dedupe_url_key(spark, sf_dir):
    return links(spark, sf_dir).select("ord", U.dedupe_url_key("link").alias("url_key"))


@query(
    "dedupe_key",
    f"""WITH {{links}}, v AS (SELECT ord, title, CASE WHEN variant = 3 AND page_id % 5 = 0 THEN '' ELSE link END AS link FROM links)
    SELECT ord, CASE WHEN link = '' THEN 'title_only' ELSE {s_url_key('link')} END || '|' || {s_title_key('title')} AS k FROM v""",
)
def dedupe_key(spark, sf_dir):
    v = links(spark, sf_dir).withColumn(
        "link", F.when((F.col("variant") == 3) & (F.col("page_id") % 5 == 0), F.lit("")).otherwise(F.col("link"))
    )
    return v.select("ord", U.dedupe_key("title", "link").alias("k"))


@query(
    "store_dedupe_key",
    """WITH {entries}, v AS (SELECT ord, title, CASE WHEN k % 11 = 0 THEN '' ELSE site END AS source,
        CASE WHEN k % 3 = 0 THEN CAST(ord AS VARCHAR) ELSE '' END AS aid,
        CASE WHEN k % 3 = 1 THEN 'https://example.com/' || k ELSE '' END AS u,
        strftime(published_utc, '%Y-%m-%d') AS day FROM entries)
    SELECT ord, CASE WHEN source <> '' AND aid <> '' THEN source || '|id|' || aid
        WHEN source <> '' AND u <> '' THEN source || '|url|' || u
        ELSE source || '|tp|' || title || '|' || day END AS store_key FROM v""",
)
def store_dedupe_key(spark, sf_dir):
    from gleaner.catalog.base import entries

    e, blank, k = entries(spark, sf_dir), F.lit(""), F.col("k")
    return e.select(
        "ord",
        U.store_dedupe_key(
            F.when(k % 11 == 0, blank).otherwise(F.col("site")),
            F.when(k % 3 == 0, F.col("ord").cast("string")).otherwise(blank),
            F.when(k % 3 == 1, F.concat(F.lit("https://example.com/"), k.cast("string"))).otherwise(blank),
            "title",
            F.date_format("published_utc", "yyyy-MM-dd"),
        ).alias("store_key"),
    )


@query(
    "strip_url",
    f"""WITH {{links}}, v AS (SELECT ord, CASE WHEN variant = 2 THEN regexp_replace(link, '^https?:', '') ELSE link END AS link FROM links)
    SELECT ord, CASE WHEN {s_part('link', 1)} = '' THEN 'https' ELSE {s_part('link', 1)} END || '://'
      || lower({s_part('link', 2)}) || {s_collapse(s_part('link', 3))} AS clean FROM v""",
)
def strip_url(spark, sf_dir):
    bare = F.when(F.col("variant") == 2, F.regexp_replace("link", "^https?:", "")).otherwise(F.col("link"))
    return links(spark, sf_dir).select("ord", U.strip_url(bare).alias("clean"))


@query(
    "article_key",
    f"""WITH {ISSUES}, {{links}} SELECT 'issue' AS kind, page_id AS ord, {s_article_key('link')} AS article_key FROM issues
    UNION ALL SELECT 'link', ord, {s_article_key('link', 'ref')} FROM links""",
)
def article_key(spark, sf_dir):
    a = issue_links(spark, sf_dir).select(
        F.lit("issue").alias("kind"), F.col("page_id").alias("ord"), U.article_key("link").alias("article_key")
    )
    b = links(spark, sf_dir).select(F.lit("link").alias("kind"), "ord", U.article_key("link", "ref").alias("article_key"))
    return a.unionByName(b)


@query(
    "article_id",
    f"""WITH {ISSUES} SELECT page_id,
      CASE WHEN regexp_extract({s_part('link', 4)}, '(?:^|&)ng=([^&]+)', 1) <> ''
           THEN regexp_extract({s_part('link', 4)}, '(?:^|&)ng=([^&]+)', 1)
           ELSE regexp_extract({s_part('link', 3)}, '/article/([A-Z0-9]+)/', 1) END AS article_id,
      coalesce(nullif(regexp_extract(link, '/article/([A-Z0-9]{{8,}})', 1), ''),
               nullif(regexp_extract(link, '/([A-Z0-9]{{8,}})/?$', 1), '')) AS long_id
    FROM issues""",
)
def article_id(spark, sf_dir):
    return issue_links(spark, sf_dir).select(
        "page_id", U.article_id("link").alias("article_id"), U.long_article_id("link").alias("long_id")
    )


@query(
    "query_param",
    f"""WITH {{links}} SELECT ord, regexp_extract({s_part('link', 4)}, '(?:^|&)page=([^&]+)', 1) AS page_no,
      regexp_extract({s_part('link', 4)}, '(?:^|&)ref=([^&]+)', 1) AS ref FROM links""",
)
def query_param(spark, sf_dir):
    return links(spark, sf_dir).select(
        "ord", U.query_param("link", "page").alias("page_no"), U.query_param("link", "ref").alias("ref")
    )


# Each link of a page is also written as another kind of reference.
REFERENCE_KINDS = ["", "rel/", "../up/", "?q=", "#f", "//cdn.example.com", "https://other.example.com", "./a/../b"]


def _reference_rows(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.posexplode(H.anchors("html")).alias("pos", "a"))
    slug = F.regexp_replace(F.col("a.href"), "^/", "")
    kind = F.col("pos") % 8
    ref = F.concat(
        F.element_at(F.array(*[F.lit(k) for k in REFERENCE_KINDS]), kind + 1),
        F.when(kind.isin(1, 2, 3, 4, 7), slug).otherwise(F.concat(F.lit("/"), slug)),
    )
    return p.select("page_id", "pos", "url", kind.alias("kind"), slug.alias("slug"), ref.alias("ref"))


@query(
    "url_join",
    f"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '{H.ANCHOR.replace("'", "''")}', 1)) AS head,
        generate_subscripts(regexp_extract_all(html, '{H.ANCHOR.replace("'", "''")}', 1), 1) - 1 AS pos FROM pages),
    r AS (SELECT page_id, url, pos, pos % 8 AS kind,
        regexp_replace(trim(regexp_extract(head, '{H.HREF.replace("'", "''")}', 1)), '^/', '') AS slug FROM a),
    b AS (SELECT page_id, pos, kind, slug, {s_part('url', 1)} || '://' || {s_part('url', 2)} AS root,
        {s_part('url', 3)} AS path, {s_part('url', 4)} AS q FROM r),
    d AS (SELECT *, regexp_replace(path, '[^/]*$', '') AS dir FROM b)
    SELECT page_id, CAST(pos AS INTEGER) AS pos, CASE kind
        WHEN 0 THEN root || '/' || slug
        WHEN 1 THEN root || dir || 'rel/' || slug
        WHEN 2 THEN root || regexp_replace(dir, '[^/]+/$', '') || 'up/' || slug
        WHEN 3 THEN root || path || '?q=' || slug
        WHEN 4 THEN root || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END || '#f' || slug
        WHEN 5 THEN {s_part("root", 1)} || '://cdn.example.com/' || slug
        WHEN 6 THEN 'https://other.example.com/' || slug
        ELSE root || dir || 'b' || slug END AS absolute
    FROM d""",
)
def url_join(spark, sf_dir):
    return _reference_rows(spark, sf_dir).select("page_id", "pos", U.url_join("url", "ref").alias("absolute"))


# Every page is wrapped with the head tags and scripts that name another address.
HEADS = [
    "<link rel=\"canonical\" href=\" {u} \">",
    "<meta property='og:url' content='{u}'>",
    "<script>var redirectUrl = '{u}';</script>",
    "<script>google.navigateTo(\"{u}\")</script>",
    "<meta http-equiv=\"refresh\" content=\"0; url={u}\">",
    "",
]


def wrapped(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    head = F.element_at(F.array(*[F.lit(h) for h in HEADS]), (F.col("page_id") % 6).cast("int") + 1)
    target = F.substring_index("url", "#", 1)
    return p.select("page_id", "url", F.concat(F.replace(head, F.lit("{u}"), target), F.col("html")).alias("html"))


WRAPPED = f"""wrapped AS (SELECT page_id, url,
  replace(list_extract({sql_list(HEADS)}, CAST(page_id % 6 AS INTEGER) + 1), '{{u}}', split_part(url, '#', 1)) || html AS html FROM pages)"""


@query(
    "canonical_url",
    f"""WITH {WRAPPED} SELECT page_id, CASE WHEN page_id % 6 IN (0, 1) THEN split_part(url, '#', 1) ELSE '' END AS canonical FROM wrapped""",
)
def canonical_url(spark, sf_dir):
    return wrapped(spark, sf_dir).select("page_id", H.canonical_url("html").alias("canonical"))


@query(
    "redirect_url",
    f"""WITH {WRAPPED} SELECT page_id, CASE WHEN page_id % 6 IN (2, 3, 4) THEN split_part(url, '#', 1) ELSE '' END AS target FROM wrapped""",
)
def redirect_url(spark, sf_dir):
    return wrapped(spark, sf_dir).select("page_id", H.redirect_url("html").alias("target"))


@query(
    "parse_url_list",
    f"""WITH t AS (SELECT page_id, url, replace(split_part(url, '#', 1), '?', '/?') AS u2 FROM pages),
    f AS (SELECT page_id, [u2, url, 'https://a.example.com/x'] AS found FROM t)
    SELECT page_id, array_to_string(list_transform(list_filter(
        list_transform(found, lambda u, i: CASE WHEN list_position(list_transform(found, lambda w: {s_normalize_url('w')}), {s_normalize_url('u')}) = i
            THEN {s_normalize_url('u')} END), lambda u: u IS NOT NULL), lambda u: u), ' ') AS urls,
      array_to_string(list_filter([url, u2], lambda u, i: i = 1 OR u2 <> url), ' ') AS feeds
    FROM f JOIN t USING (page_id)""",
)
def parse_url_list(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    u2 = F.replace(F.substring_index("url", "#", 1), F.lit("?"), F.lit("/?"))
    free = F.concat(
        F.lit(" see "), F.col("url"), F.lit(", [doc]("), u2, F.lit(")"), F.col("url"), F.lit("https://a.example.com/x\n")
    )
    per_line = F.concat(F.lit("  "), F.col("url"), F.lit("\r\nnot a url\n\n"), u2, F.lit("\n"), F.col("url"))
    return p.select(
        "page_id",
        F.array_join(U.parse_url_list(free), " ").alias("urls"),
        F.array_join(U.parse_feed_urls(per_line), " ").alias("feeds"),
    )


@query(
    "page_link",
    """WITH {store} SELECT ord, CASE WHEN ord % 3 = 0 THEN trim(url) WHEN ord % 3 = 1 THEN 'https://pages.example.com/pg' || ord
      ELSE '' END AS page_link FROM store""",
)
def page_link(spark, sf_dir):
    from gleaner.catalog.base import store

    n = F.col("ord") % 3
    given = F.when(n == 0, F.concat(F.lit(" "), F.col("url"), F.lit(" ")))
    pid = F.when(n == 1, F.col("page_id"))
    return store(spark, sf_dir).select("ord", U.page_link(given, pid, "https://pages.example.com/").alias("page_link"))
