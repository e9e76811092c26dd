"""Date functions over texts written from every event's and order's time in many shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog.base import AS_OF, ZONE_HOURS, ZONES, art, entries, pick, query, sql_list, table
from gleaner.functions import dates as D



def zone():
    return pick(F.col("user_id"), ZONES)


def gran():
    return F.when(F.col("ord") % 2 == 0, F.lit("date")).otherwise(F.lit("datetime"))


OFFSET = f"list_extract({ZONE_HOURS}, CAST(user_id % 3 AS INTEGER) + 1)"


@query(
    "entry_datetime",
    """WITH {entries}, v AS (SELECT ord, CASE WHEN k % 3 = 0 THEN NULL ELSE published_utc END AS p,
      CASE WHEN k % 5 = 0 THEN NULL ELSE published_utc + INTERVAL 1 HOUR END AS u FROM entries)
    SELECT ord, coalesce(strftime(coalesce(p, u) + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M'), 'N/A') AS published FROM v""",
)
def entry_datetime(spark, sf_dir):
    k, ts = F.col("k"), F.col("published_utc")
    p = F.when(k % 3 != 0, ts)
    u = F.when(k % 5 != 0, ts + F.expr("INTERVAL '1' HOUR"))
    local = D.to_zone(D.entry_datetime_utc(p, u), "Asia/Tokyo")
    return entries(spark, sf_dir).select("ord", F.coalesce(D.label(local), F.lit("N/A")).alias("published"))


@query(
    "entry_datetime_ranked",
    """WITH {entries}, v AS (SELECT ord, k % 5 AS kind, date_trunc('second', published_utc) AS t FROM entries)
    SELECT ord, CASE kind WHEN 0 THEN t WHEN 1 THEN t WHEN 2 THEN t - INTERVAL 9 HOUR WHEN 4 THEN t END AS published_utc,
      CASE kind WHEN 0 THEN 'published_parsed' WHEN 1 THEN 'updated_parsed' WHEN 2 THEN 'published' WHEN 3 THEN 'published'
        ELSE 'updated' END AS source FROM v""",
)
def entry_datetime_ranked(spark, sf_dir):
    kind, t = F.col("k") % 5, F.date_trunc("second", "published_utc").cast("timestamp_ntz")
    mail = F.concat(F.date_format(t, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0900"))
    naive = F.date_format(t, "dd MMM yyyy HH:mm:ss")
    value, source = D.ranked_entry_datetime(
        F.when(kind == 0, t),
        F.when(kind <= 1, t),
        F.when(kind == 2, mail).when(kind == 3, F.lit("yesterday")).when(kind == 4, F.lit("")),
        F.when(kind >= 2, naive),
    )
    return entries(spark, sf_dir).select("ord", value.alias("published_utc"), source.alias("source"))


MAIL_SHAPES = [
    ("EEE, dd MMM yyyy HH:mm:ss", " GMT", "t"),
    ("dd MMM yyyy HH:mm:ss", " +0530", "t - INTERVAL 330 MINUTE"),
    ("d MMMM yyyy HH:mm", " EST", "date_trunc('minute', t) + INTERVAL 5 HOUR"),
    ("EEE, d MMM yy HH:mm:ss", " -0000", "t - INTERVAL 9 HOUR"),
    ("dd/MM/yyyy HH:mm", "", "NULL"),
]


@query(
    "parse_rfc2822",
    """WITH {entries}, v AS (SELECT ord, ord % 5 AS kind, date_trunc('second', published_utc) AS t FROM entries)
    SELECT ord, CASE kind """
    + " ".join(f"WHEN {i} THEN {e}" for i, (_, _, e) in enumerate(MAIL_SHAPES))
    + " END AS parsed FROM v",
)
def parse_rfc2822(spark, sf_dir):
    shaped = None
    for i, (fmt, tail, _) in enumerate(MAIL_SHAPES):
        value = F.concat(F.date_format("published_utc", fmt), F.lit(tail))
        shaped = F.when(F.col("ord") % 5 == i, value) if shaped is None else shaped.when(F.col("ord") % 5 == i, value)
    return entries(spark, sf_dir).select("ord", D.parse_mail_utc(shaped, F.lit("Asia/Tokyo")).alias("parsed"))


MINUTE = "date_trunc('minute', t)"
CUT = "CASE WHEN ord % 2 = 0 THEN date_trunc('day', t) ELSE {x} END - off"
FLEXIBLE = [
    ("yyyy-MM-dd'T'HH:mm:ss'+09:00'", "t - INTERVAL 9 HOUR"),
    ("yyyy-MM-dd'T'HH:mm:ss'Z'", "t"),
    ("yyyy-MM-dd HH:mm", f"{MINUTE} - off"),
    ("yyyy'年'M'月'd'日' HH:mm", CUT.format(x=MINUTE)),
    ("yyyy/MM/dd HH:mm:ss", CUT.format(x="t")),
    ("EEE, dd MMM yyyy HH:mm:ss 'GMT'", "t"),
    ("dd MMM yyyy HH:mm:ss '+0530'", "t - INTERVAL 330 MINUTE"),
    ("yyyy/M/d", "date_trunc('day', t) - off"),
    ("'about' yyyy", "NULL"),
    ("yyyy-'02-30'", "NULL"),
    ("' 'd MMMM yyyy HH:mm:ss '-0500 '", "t + INTERVAL 5 HOUR"),
    ("yyyyMMdd", "date_trunc('day', t) - off"),
]
TEXTS = [
    ("'Posted' yyyy/MM/dd HH:mm 'by desk'", f"CASE WHEN ord % 2 = 0 THEN date_trunc('day', t) ELSE {MINUTE} END"),
    ("'更新 'yyyy'年'M'月'd'日' HH:mm", f"CASE WHEN ord % 2 = 0 THEN date_trunc('day', t) ELSE {MINUTE} END"),
    ("yyyy-MM-dd'T'HH:mm:ss'+09:00'", "date_trunc('day', t)"),
    ("'公開 'yyyy'年'M'月'd'日'", "date_trunc('day', t)"),
    ("'on' d MMMM yyyy", "date_trunc('day', t)"),
    ("MMM d, yyyy", "date_trunc('day', t)"),
    ("yyyy'-02-30 then 'dd MMM yyyy", "date_trunc('day', t)"),
    ("'around noon'", "NULL"),
    ("yyyyMMdd'T'HHmmss", "t"),
    ("yyyy'年'M'月'd'日'H:", "CASE WHEN ord % 2 = 0 THEN date_trunc('day', t) ELSE date_trunc('hour', t) END"),
    ("d 'Foo' yyyy", "NULL"),
]


def _written(shapes):
    n = len(shapes)
    out = F.when(F.lit(False), F.lit(""))
    for i, (fmt, _) in enumerate(shapes):
        out = out.when(F.floor(F.col("ord") / 2) % n == i, F.date_format("published_utc", fmt))
    return out


def _expected(shapes):
    return "CASE (ord // 2) % " + str(len(shapes)) + " " + " ".join(f"WHEN {i} THEN {e}" for i, (_, e) in enumerate(shapes)) + " END"


SHAPED = f"""v AS (SELECT ord, date_trunc('second', published_utc) AS t, to_hours({OFFSET}) AS off FROM entries)"""


@query("parse_flexible_datetime", f"WITH {{entries}}, {SHAPED} SELECT ord, {_expected(FLEXIBLE)} AS parsed FROM v")
def parse_flexible_datetime(spark, sf_dir):
    return entries(spark, sf_dir).select("ord", D.parse_flexible_utc(_written(FLEXIBLE), zone(), gran()).alias("parsed"))


@query("parse_date_text", f"WITH {{entries}}, {SHAPED} SELECT ord, {_expected(TEXTS)} AS parsed FROM v")
def parse_date_text(spark, sf_dir):
    return entries(spark, sf_dir).select("ord", D.parse_date_text_local(_written(TEXTS), zone(), gran()).alias("parsed"))


@query(
    "date_from_url",
    """SELECT page_id, CASE WHEN page_id % 3 < 2 THEN strftime(DATE '2023-12-31' + CAST(page_id % 300 + 1 AS INTEGER), '%Y-%m-%d') END AS day,
      CASE WHEN page_id % 3 = 2 THEN NULL ELSE strftime(DATE '2023-12-31' + CAST(page_id % 300 + 1 AS INTEGER), '%Y%m%d') END AS whole FROM pages""",
)
def date_from_url(spark, sf_dir):
    day = F.date_add(F.lit("2023-12-31").cast("date"), (F.col("page_id") % 300).cast("int") + 1)
    dated = F.concat(F.lit("https://n.example.com/news-t"), F.date_format(day, "yyyyMMdd"), F.lit("77.html"))
    kind = F.col("page_id") % 3
    lines = F.concat_ws("\n", F.when(kind == 0, dated), F.col("url"), F.when(kind == 1, dated))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        D.date_text_from_url(lines, r"news-t(\d{4})(\d{2})(\d{2})\d+\.html", 3).alias("day"),
        F.regexp_replace(D.date_text_from_url(lines, r"news-t\d{8}", 0), "news-t", "").alias("whole"),
    )


@query(
    "fallback_fetched_at",
    f"""WITH {{entries}}, v AS (SELECT ord, CASE WHEN k % 4 = 0 THEN NULL ELSE published_utc END AS t,
      CASE WHEN ord % 2 = 0 THEN 'use_fetched_at' ELSE 'require_date' END AS mode FROM entries)
    SELECT ord, CASE WHEN t IS NULL THEN TIMESTAMP '{AS_OF}' ELSE t END AS published_utc,
      CASE WHEN t IS NULL THEN 'fetched_at' ELSE 'list_regex' END AS date_source
    FROM v WHERE t IS NOT NULL OR mode = 'use_fetched_at'""",
)
def fallback_fetched_at(spark, sf_dir):
    t = F.when(F.col("k") % 4 != 0, F.col("published_utc"))
    mode = F.when(F.col("ord") % 2 == 0, F.lit("use_fetched_at")).otherwise(F.lit("require_date"))
    when_, source = D.fallback_to_run_time(t, mode, F.lit("list_regex"), D.ntz(AS_OF))
    out = entries(spark, sf_dir).select("ord", when_.alias("published_utc"), source.alias("date_source"))
    return out.where(F.col("published_utc").isNotNull())


DATE_SHAPES = ["yyyyMMdd", "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm", "yyyy/MM/dd", "' 'yyyyMMdd' '"]


@query(
    "normalize_issue_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 3 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS issue_date,
      CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
        WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M') WHEN 3 THEN strftime(o_orderdate, '%Y/%m/%d')
        ELSE strftime(o_orderdate, ' %Y%m%d ') END AS shown FROM orders""",
)
def normalize_issue_date(spark, sf_dir):
    raw = F.when(F.lit(False), F.lit(""))
    for i, fmt in enumerate(DATE_SHAPES):
        raw = raw.when(F.col("o_orderkey") % 5 == i, F.date_format("o_orderdate", fmt))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", D.normalize_issue_date(raw).alias("issue_date"), D.display_date(raw).alias("shown")
    )


@query(
    "format_label",
    f"""WITH {{entries}} SELECT ord, CASE WHEN ord % 2 = 0 THEN strftime(published_utc + to_hours({OFFSET}), '%Y-%m-%d')
      ELSE strftime(published_utc + to_hours({OFFSET}), '%Y-%m-%d %H:%M') END AS label FROM entries""",
)
def format_label(spark, sf_dir):
    return entries(spark, sf_dir).select("ord", D.label(D.to_zone("published_utc", zone()), gran()).alias("label"))


@query(
    "target_date",
    """WITH {entries} SELECT ord, CASE WHEN k % 3 = 0 THEN '20231224' ELSE strftime(published_utc + INTERVAL 9 HOUR, '%Y%m%d') END AS target FROM entries""",
)
def target_date(spark, sf_dir):
    setting = pick(F.col("k"), ["20231224", "auto", ""])
    return entries(spark, sf_dir).select("ord", D.target_date(setting, F.col("published_utc")).alias("target"))


# Feed entries with every date source, and a rule for each kind of source and fallback.
RULES = [
    # source type, pattern, selector, zone, granularity, fallback type, fallback pattern
    ("rss", "", "", "Asia/Tokyo", "datetime", "", ""),
    ("url", r"news-t(\d{4})(\d{2})(\d{2})\d+\.html", "", "Asia/Tokyo", "date", "rss", ""),
    ("article_html", r"\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}|\d{4}/\d{1,2}/\d{1,2}\s+\d{1,2}:\d{2}", "time.pub", "Asia/Tokyo", "datetime", "rss", ""),
    ("meta", r"\d{4}-\d{2}-\d{2}", "", "UTC", "date", "", ""),
    ("json_ld", r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z", "", "UTC", "datetime", "url", r"\d{4}-\d{2}-\d{2}"),
    ("article_html", r"\d{4}/\d{2}/\d{2}", "", "UTC", "date", "", ""),
]


def ruled_entries(spark, sf_dir):
    """Each event as a feed entry with a captured page and its feed's date rule."""
    n, t = F.col("ord"), F.col("published_utc")
    kind = F.col("k") % 6
    stamp = lambda fmt: F.date_format(t, fmt)
    empty = F.lit("")
    html = F.concat(
        F.when(
            n % 4 == 0,
            F.concat(F.lit('<meta name="author" content="x"><meta property="article:published_time" content="'), stamp("yyyy-MM-dd"), F.lit('T00:00">')),
        ).otherwise(empty),
        F.when(
            n % 4 == 1,
            F.concat(
                F.lit('<script type="application/ld+json">{"@type":"NewsArticle","datePublished":"'),
                stamp("yyyy-MM-dd'T'HH:mm:ss'Z'"),
                F.lit('"}</script>'),
            ),
        ).otherwise(empty),
        F.when(n % 8 < 6, F.lit("<p>text</p>")).otherwise(empty),
    )
    rule = F.element_at(
        F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(
            ("date_source_type", "date_parse_pattern", "date_css_selector", "date_timezone", "date_granularity",
             "fallback_date_source_type", "fallback_date_parse_pattern"), r)]) for r in RULES]),
        kind + 1,
    )
    base = entries(spark, sf_dir).withColumn("rule", rule)
    return base.select(
        "ord",
        kind.alias("kind"),
        F.when(n % 3 == 0, F.concat(F.lit("https://n.example.com/news-t"), stamp("yyyyMMdd"), F.lit("001.html")))
        .otherwise(F.concat(F.lit("https://n.example.com/"), stamp("yyyy-MM-dd"), F.lit("/a"))).alias("link"),
        F.when(n % 5 != 0, F.date_trunc("second", t).cast("timestamp_ntz")).alias("published_parsed"),
        F.lit(None).cast("timestamp_ntz").alias("updated_parsed"),
        empty.alias("published"),
        F.when(n % 10 == 0, stamp("dd MMM yyyy HH:mm:ss")).otherwise(empty).alias("updated"),
        empty.alias("final_url"),
        empty.alias("canonical_url"),
        html.alias("html"),
        F.when(n % 4 == 1, stamp("yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(empty).alias("ld_date"),
        (n % 4 == 2).alias("sel_found"),
        F.when(n % 8 == 2, stamp("yyyy/M/d H:mm")).otherwise(empty).alias("sel_attr"),
        F.when(n % 16 != 6, F.concat(F.lit("Pub "), stamp("yyyy-MM-dd HH:mm"))).otherwise(empty).alias("sel_text"),
        "rule.*",
    )


@query(
    "extract_datetime_by_rule",
    """WITH {entries}, v AS (SELECT ord, k % 6 AS kind, date_trunc('second', published_utc) AS t, ord AS n FROM entries),
    s AS (SELECT *, date_trunc('day', t) AS d, date_trunc('minute', t) AS m,
      CASE WHEN n % 5 <> 0 THEN t WHEN n % 10 = 0 THEN t END AS rss,
      CASE WHEN n % 5 <> 0 THEN 'published_parsed' WHEN n % 10 = 0 THEN 'updated' END AS rss_src,
      n % 8 < 6 OR n % 4 IN (0, 1) AS has_html FROM v),
    a AS (SELECT *, CASE
        WHEN kind = 0 THEN rss
        WHEN kind = 1 THEN CASE WHEN n % 3 = 0 THEN d - INTERVAL 9 HOUR ELSE rss END
        WHEN kind = 2 THEN CASE WHEN n % 4 = 2 AND (n % 8 = 2 OR n % 16 <> 6) THEN m - INTERVAL 9 HOUR
          WHEN n % 4 = 1 THEN t ELSE rss END
        WHEN kind = 3 THEN CASE WHEN n % 4 = 0 THEN d END
        WHEN kind = 4 THEN CASE WHEN n % 4 = 1 THEN t WHEN n % 3 <> 0 THEN d END
        ELSE CASE WHEN n % 4 = 1 THEN t END END AS p FROM s)
    SELECT ord, p AS published_utc,
      CASE WHEN p IS NULL THEN NULL WHEN kind = 0 THEN rss_src
        WHEN kind = 1 THEN CASE WHEN n % 3 = 0 THEN 'url' ELSE rss_src END
        WHEN kind = 2 THEN CASE WHEN n % 4 = 2 AND (n % 8 = 2 OR n % 16 <> 6) THEN 'article_html(selector)'
          WHEN n % 4 = 1 THEN 'article_html(json_ld_newsarticle)' ELSE rss_src END
        WHEN kind = 3 THEN 'meta' WHEN kind = 4 THEN CASE WHEN n % 4 = 1 THEN 'json_ld' ELSE 'url' END
        ELSE 'article_html(json_ld_newsarticle)' END AS adopted_source,
      CASE WHEN p IS NULL OR kind = 0 THEN NULL
        WHEN kind = 1 AND n % 3 <> 0 THEN NULL
        WHEN kind = 2 AND NOT ((n % 4 = 2 AND (n % 8 = 2 OR n % 16 <> 6)) OR n % 4 = 1) THEN NULL
        ELSE strftime(p + CASE WHEN kind IN (1, 2) THEN INTERVAL 9 HOUR ELSE INTERVAL 0 HOUR END, '%Y-%m-%d') END AS parsed_date,
      CASE WHEN p IS NOT NULL THEN NULL WHEN kind = 0 THEN 'rss datetime not found'
        WHEN kind = 1 THEN 'primary=date text not matched by pattern; fallback=rss datetime not found'
        WHEN kind = 2 THEN 'primary=' || CASE WHEN n % 4 = 2 THEN 'selector value is empty'
            WHEN n % 4 = 0 THEN 'date text not matched by pattern'
            WHEN has_html THEN 'selector not found: time.pub' ELSE 'article html empty' END || '; fallback=rss datetime not found'
        WHEN kind = 3 THEN 'meta content not found'
        WHEN kind = 4 THEN 'primary=json_ld block not found; fallback=date text not matched by pattern'
        ELSE CASE WHEN n % 4 = 0 THEN 'date text not matched by pattern' WHEN has_html THEN 'selector empty' ELSE 'article html empty' END
        END AS failure_reason
    FROM a""",
)
def extract_datetime_by_rule(spark, sf_dir):
    from gleaner.operators.extraction import extract_datetime_by_rule as extract

    return extract(ruled_entries(spark, sf_dir)).select(
        "ord", "published_utc", "adopted_source", "parsed_date", "failure_reason"
    )
