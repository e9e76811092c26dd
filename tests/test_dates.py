"""Literal cases for publication times and windows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gleaner.functions import dates as D
from gleaner.functions import html as H
from gleaner.operators import elements
from gleaner.operators import windows as W
from gleaner.operators.extraction import extract_datetime_by_rule

JST = "Asia/Tokyo"


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "granularity", "expected"),
    [
        ("2026-03-16T06:00:00+09:00", "datetime", datetime(2026, 3, 15, 21)),
        ("2026-03-16T06:00:00Z", "datetime", datetime(2026, 3, 16, 6)),
        ("2026/03/12 10:30", "datetime", datetime(2026, 3, 12, 1, 30)),
        ("2026年3月12日 10:30", "date", datetime(2026, 3, 11, 15)),
        ("2026-03-12 10:30", "date", datetime(2026, 3, 12, 1, 30)),  # readable as ISO, so not cut to the day
        ("Thu, 12 Mar 2026 10:30:00 +0000", "datetime", datetime(2026, 3, 12, 10, 30)),
        ("12 Mar 2026 10:30:00 EST", "datetime", datetime(2026, 3, 12, 15, 30)),
        ("2026-02-30", "datetime", None),
        ("yesterday", "datetime", None),
    ],
)
def test_flexible(spark, text, granularity, expected):
    assert one(spark, D.parse_flexible_utc(F.lit(text), F.lit(JST), F.lit(granularity))) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2026/04/05 08:30", datetime(2026, 4, 5, 8, 30)),
        ("2026年4月4日", datetime(2026, 4, 4)),
        ("May 1, 2026", datetime(2026, 5, 1)),
        ("1 May 2026", datetime(2026, 5, 1)),
        ("2026-04-05T08:30:00+09:00", datetime(2026, 4, 5)),  # the numeric date is found first
        ("26年04月05日", None),
        ("2026-02-30, then 3 Mar 2026", datetime(2026, 3, 3)),
        ("", None),
    ],
)
def test_date_text(spark, text, expected):
    assert one(spark, D.parse_date_text_local(F.lit(text), F.lit(JST), F.lit("datetime"))) == expected


def test_results_do_not_depend_on_the_session_zone(spark):
    col = D.label(D.to_zone(D.parse_flexible_utc(F.lit("2024-03-10 02:30"), F.lit("UTC"), F.lit("datetime")), "UTC"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist there that day
        assert one(spark, col) == "2024-03-10 02:30"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_first_field_decides_even_if_unreadable(spark):
    empty = F.lit(None).cast("timestamp_ntz")
    value, source = D.ranked_entry_datetime(empty, empty, F.lit("not a date"), F.lit("Thu, 12 Mar 2026 10:30:00 GMT"))
    row = spark.range(1).select(value.alias("v"), source.alias("s")).first()
    assert (row["v"], row["s"]) == (None, "published")


def test_window_edges(spark):
    now = D.ntz("2026-03-12 03:00:00")
    rows = spark.createDataFrame(
        [("2026-03-11 03:00:00",), ("2026-03-11 02:59:59",), ("2026-03-12 03:00:00",), ("2026-03-13 00:00:00",)], "t string"
    ).select(F.col("t").cast("timestamp_ntz").alias("t"))
    got = rows.select(
        W.since(F.col("t"), now), W.rolling_half_open(F.col("t"), now, F.lit(24)), W.rolling_closed(F.col("t"), now, F.lit(24))
    ).collect()
    assert [tuple(r) for r in got] == [(True, True, True), (False, False, False), (True, False, True), (True, False, False)]


def test_calendar_day_accepts_today_and_yesterday(spark):
    now = D.ntz("2026-03-17 00:00:00")
    days = spark.createDataFrame([("2026-03-15",), ("2026-03-16",), ("2026-03-17",), ("2026-03-18",)], "d string")
    got = days.select(W.calendar_home(F.col("d").cast("date"), now)).collect()
    assert [r[0] for r in got] == [False, True, True, False]


RULE = dict(
    date_source_type="article_html", date_parse_pattern=r"\d{4}/\d{1,2}/\d{1,2}\s+\d{1,2}:\d{2}", date_css_selector="time.pub",
    date_timezone=JST, date_granularity="datetime", fallback_date_source_type="rss", fallback_date_parse_pattern="",
)


def extract(spark, html, **changes):
    rule = {**RULE, **{k: v for k, v in changes.items() if k in RULE}}
    link = changes.get("link", "https://n.example.com/a")
    rows = spark.createDataFrame([(link, html)], "link string, html string").select(
        "*", *[F.lit(v).alias(k) for k, v in rule.items()], F.lit("").alias("published"), F.lit("").alias("updated"),
        F.lit(changes.get("rss")).cast("timestamp_ntz").alias("published_parsed"), F.lit(None).cast("timestamp_ntz").alias("updated_parsed"),
        F.lit("").alias("final_url"), H.canonical_url("html").alias("canonical_url"),
    )
    chosen = elements.select_first(rows, "link", F.array("date_css_selector"), longest=1)
    chosen = chosen.select("link", F.col("found").alias("sel_found"), F.col("datetime").alias("sel_attr"), F.col("text").alias("sel_text"))
    rows = rows.withColumn("ld_date", H.news_article_date("html")).join(chosen, "link", "left")
    return extract_datetime_by_rule(rows).first()


def test_datetime_attribute_beats_text(spark):
    row = extract(spark, '<div><time class="x pub" datetime="2026/03/12 10:30">2026/03/12 11:59</time></div>')
    assert (row["published_utc"], row["adopted_source"]) == (datetime(2026, 3, 12, 1, 30), "article_html(selector)")


def test_empty_selector_value_skips_to_the_fallback(spark):
    row = extract(spark, '<time class="pub"></time><meta name="date" content="2026/03/12 10:30">', rss="2026-03-11 00:00:00")
    assert (row["published_utc"], row["adopted_source"]) == (datetime(2026, 3, 11), "published_parsed")


def test_nested_structured_data_needs_no_pattern(spark):
    html = '<script type="application/ld+json">[{"@graph":[{"@type":"NewsArticle","datePublished":"2026-03-16T06:00:00+09:00"}]}]</script>'
    row = extract(spark, html, date_parse_pattern="never")
    assert (row["published_utc"], row["parsed_date"]) == (datetime(2026, 3, 15, 21), "2026-03-16")


def test_url_groups_make_the_date(spark):
    row = extract(
        spark, "", link="https://n.example.com/news-t20260316148097.html", date_source_type="url", date_granularity="date",
        date_parse_pattern=r"news-t(\d{4})(\d{2})(\d{2})\d+\.html",
    )
    assert (row["published_utc"], row["parsed_date"]) == (datetime(2026, 3, 15, 15), "2026-03-16")


def test_first_date_meta_is_used(spark):
    html = '<meta name="a" content="2026-01-01"><meta property="article:section" content="x"><meta property="article:published_time" content="2026-03-12T10:00">'
    row = extract(spark, html, date_source_type="meta", date_parse_pattern=r"\d{4}-\d{2}-\d{2}", date_css_selector="")
    assert row["parsed_date"] == "2026-03-12"


def test_both_failures_are_told(spark):
    row = extract(spark, "<p>none</p>")
    assert row["failure_reason"] == "primary=selector not found: time.pub; fallback=rss datetime not found"


def test_a_full_width_blank_parts_date_and_time(spark):
    rows = [("2026/04/05\u300008:30", datetime(2026, 4, 5, 8, 30)), ("2026年4月5日\u30008:30", datetime(2026, 4, 5, 8, 30)), ("5\u3000Apr\u00a02026", datetime(2026, 4, 5))]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string")
    got = df.select(D.parse_date_text_local("t", F.lit(JST), F.lit("datetime"))).collect()
    assert [r[0] for r in got] == [w for _, w in rows]
