"""Jobs and markup on small fixtures, checked by hand."""

from pyspark.sql import functions as F

from gleaner.functions import dates as D
from gleaner.functions import html as H
from gleaner.operators import elements, shaping
from gleaner.plans import issue_report, site_digest

PAGE_1 = """<html><body><ul>
<li><a href="/news/1">Plant opens 2026/04/05 08:30</a></li><li><a href="/news/1#top">again</a></li>
<li><a href="/news/2">Undated</a></li><li><a href="/about">About 2026/04/05 08:30</a></li>
<li><a href="/news/3">Old 2026/04/01 08:30</a></li><li><a href="/news/9">[PR] 2026/04/05 08:30</a></li></ul>
<a rel="next" href="?page=2">more</a></body></html>"""
PAGE_2 = '<a href="/news/4">Second page 2026/04/05 07:00</a><a href="/list">next</a>'
OTHER = '<a href="https://a.example.com/news/1?">Other wording 2026/04/05 09:00</a><a href="/x/1">plant  OPENS 2026/04/05 08:30</a><a href="/x/2">Only here 2026/04/05 06:00</a>'


def sites_and_captures(spark):
    names = "site_name string, list_page_urls string, display_order string, article_url_pattern string, exclude_title_pattern string, list_date_pattern string, article_date_pattern string, max_pages string, max_items_total string"
    pattern = r"\d{4}/\d{2}/\d{2} \d{2}:\d{2}"
    raw = spark.createDataFrame(
        [
            ("A", "https://a.example.com/list", "1", "^/news/ \n", r"^\[PR\]", pattern, pattern, "3", "9"),
            ("B", "https://b.example.com/list", "2", "", "", pattern, "", "1", "40"),
        ],
        names,
    )
    sites = shaping.normalize_site_config(raw).withColumnRenamed("site_name", "site")
    captures = spark.createDataFrame(
        [
            ("https://a.example.com/list", PAGE_1), ("https://a.example.com/list?page=2", PAGE_2), ("https://b.example.com/list", OTHER),
            ("https://a.example.com/news/2", "<p>Posted 2026/04/05 05:00 by desk</p>"),
        ],
        "url string, html string",
    )
    return sites, captures


def test_site_watch_end_to_end(spark):
    sites, captures = sites_and_captures(spark)
    got = site_digest.build(sites, captures, D.ntz("2026-04-05 01:00:00")).orderBy("position").collect()
    assert [(r["site"], r["url"].split(".com")[1], r["date_source"]) for r in got] == [
        ("A", "/news/1", "list_regex"), ("A", "/news/2", "article_regex"), ("A", "/news/4", "list_regex"),
        ("B", "/x/2", "list_regex"),
    ]


def test_site_watch_decisions(spark):
    sites, captures = sites_and_captures(spark)
    pages = site_digest.visited_pages(sites, captures)
    assert {(r["site"], r["depth"]) for r in pages.collect()} == {("A", 0), ("A", 1), ("B", 0)}
    _, judged = site_digest.decisions(sites, pages, captures, D.ntz("2026-04-05 01:00:00"))
    got = {r["url"].split(".com")[1]: r["decision"] for r in judged.where("site = 'A'").collect()}
    assert got == {
        "/news/1": "accepted", "/news/2": "accepted", "/news/3": "out_of_window", "/news/9": "exclude_pattern_matched", "/news/4": "accepted",
    }


def test_issue_links(spark):
    url = "https://www.example.com/paper/article/?b=20240101&ng={}"
    rows = [(0, url.format("A"), "12日"), (1, url.format("A"), "A long enough title"), (2, url.format("B"), "A long enough title"), (3, "https://www.example.com/x", "t")]
    keep, left = issue_report.issue_links(spark.createDataFrame(rows, "ord int, url string, title string"), "example.com", "/paper/article/")
    assert [r["ord"] for r in keep.collect()] == [2]
    assert [(r["ord"], r["exclude_reason"]) for r in left.collect()] == [(0, "pre_title_regex")]


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_select_elements(spark):
    page = '<div id="m"><p class="a b">one <i>two</i></p><br><section><p class="b">three</p><time datetime=" 2026 ">x</time></section></div>'
    wanted = ["p.b", "section .b", "#m p i", "h1", '[datetime*="26"]', "time"]
    pages = spark.createDataFrame([(1, page)], "k int, html string")
    got = elements.select_first(pages, "k", F.array(*map(F.lit, wanted)), longest=3).collect()
    assert {(r["selector"], r["found"], r["datetime"], r["text"]) for r in got} == {
        ("p.b", True, "", "one two"), ("section .b", True, "", "three"), ("#m p i", True, "", "two"), ("h1", False, "", ""),
        ('[datetime*="26"]', True, "2026", "x"), ("time", True, "2026", "x"),
    }


def test_select_agrees_with_the_heading_pattern(spark, sf_dir):
    from gleaner.catalog.base import table

    p = table(spark, sf_dir, "pages").select("page_id", "html")
    picked = elements.select_first(p, "page_id", F.array(F.lit("article h1")), longest=2)
    by_pattern = H.inner_text(F.regexp_extract("html", r"(?s)<article><h1>(.*?)</h1>", 1))
    assert picked.join(p, "page_id").where(F.col("text") != by_pattern).count() == 0 and picked.where("found").count() > 0


def test_anchor_dates(spark):
    page = '<ul><li>2024/01/05 <a href="/a">A</a></li><li><a href="/b">B <time>Jan 5, 2024</time></a></li><li><a href="/c">C</a></li></ul>'
    pages = spark.createDataFrame([(1, page)], "k int, html string")
    found, source = elements.list_date(F.lit(r"\d{4}/\d{2}/\d{2}"))
    a = elements.links_in_context(pages, "k", selector=F.lit("time")).orderBy("pos")
    assert [tuple(r) for r in a.select(found, source).collect()] == [("2024/01/05", "list_regex"), ("Jan 5, 2024", "list_selector"), ("", "failed")]


def test_links_and_redirects(spark):
    assert one(spark, H.redirect_url(F.lit("<script>google.navigateTo('https://a.com/x')</script>"))) == "https://a.com/x"
    assert one(spark, H.redirect_url(F.lit('<meta http-equiv="refresh" content="0;url=https://a.com/y">'))) == "https://a.com/y"
    links = one(spark, H.anchors(F.lit('<a href="/a"><b>x</b> &amp; y</a><a href="">n</a><a title="T" href="/c"><img></a>')))
    assert [(r["href"], r["title"]) for r in links] == [("/a", "x & y"), ("/c", "T")]


def test_issue_articles_from_links(spark):
    url = "https://news.example.com/paper/article/?ng={}"
    body = "。\n".join(f"Steel demand rose again in the {i}th quarter and the mills raised prices in many places" for i in range(6)) + "。"
    links = spark.createDataFrame(
        [(0, url.format("A"), "Steel demand rose again"), (1, url.format("A"), "Second link of A"), (2, url.format("B"), "Saved article of the day"),
         (3, url.format("C"), "12日"), (4, url.format("D"), "Never captured article"), (5, url.format("E"), "Saved without its text"), (6, "https://x.org/", "Elsewhere")],
        "ord int, url string, title string",
    )
    store = spark.createDataFrame(
        [("p1", url.format("B"), "Saved B", "20240101", "morning", "Body B", 1), ("p2", url.format("E"), "Saved E", "20240101", "morning", " ", 2)],
        "page_id string, url string, title string, issue_date string, edition string, text string, ord int",
    )
    captures = spark.createDataFrame(
        [(url.format("A"), "Steel demand rose again", body, "article"), (url.format("E"), "Saved without its text", "short", "article")],
        "url string, page_title string, text string, selector string",
    )
    rows, audit = issue_report.articles(links, store, captures, "example.com", "/paper/article/")
    assert {(r["article_id"], r["source"], r["text"]) for r in rows.collect()} == {("A", "fetched", body), ("B", "store_existing", "Body B")}
    assert {(r["ord"], r["action"], r["outcome"]) for r in audit.collect()} == {
        (0, "new", "success"), (2, "skipped", ""), (3, "left_out", "pre_title_regex"), (4, "new", "failed:empty_text"), (5, "backfill", "failed:navigation_like_text"),
    }
