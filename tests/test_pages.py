"""Pages as rows: links in context, link selectors, body candidates; walks over many pages; the site watch with all its settings."""

from __future__ import annotations

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from gleaner.functions import dates as D
from gleaner.operators import dedupe, elements, lookup, page_bodies, shaping
from gleaner.plans import site_digest

LIST = '<ul><li>2024/01/05 <a href="/a">A</a></li><li><a href="/b">B <time>Jan 5, 2024</time></a></li><li><a href=/c title="C t"><img src="x"></a></li></ul><p class="x y"><a href="/z">Z</a></p>'


def test_links_by_selector_with_their_dates(spark):
    pages = spark.createDataFrame([(1, LIST, "time", r"\d{4}/\d{2}", "li a"), (2, LIST, "", "", ""), (3, LIST, "b", "x", "p.x a"), (4, "", "", "", "a"), (5, None, "", "", "")], "k int, html string, s string, p string, l string")
    rows = elements.links_in_context(pages, "k", selector=F.col("s"), pattern=F.col("p"), link=F.col("l")).collect()
    assert {(r.k, r.href, r.title, r.selected, r.around) for r in rows} == {
        (1, "/a", "A", "", "2024/01"), (1, "/b", "B Jan 5, 2024", "Jan 5, 2024", ""), (1, "/c", "C t", "", ""),
        (2, "/a", "A", "", ""), (2, "/b", "B Jan 5, 2024", "", ""), (2, "/c", "C t", "", ""), (2, "/z", "Z", "", ""), (3, "/z", "Z", "", ""),
    }


def test_five_thousand_links_under_one_parent_are_as_many_rows(spark):
    page = "<div>" + "".join(f'<a href="/{i}">t{i}</a> 2024/01/{i % 28 + 1:02d} ' for i in range(5000)) + "</div>"
    start = time.time()
    rows = elements.links_in_context(spark.createDataFrame([(1, page)], "k int, html string"), "k", pattern=F.lit(r"\d{4}/\d{2}/\d{2}")).collect()
    assert len(rows) == 5000 and {r.around for r in rows} == {"2024/01/01"} and {r.title for r in rows} == {f"t{i}" for i in range(5000)}
    assert time.time() - start < 240


def test_every_element_of_a_chain(spark):
    page = '<div class="m"><p><a id="1">x</a></p><section class="m"><a id="2">y</a></section></div><p><a id="3">z</a></p><br class="m">'
    for chain, want in [("a", "123"), (".m a", "12"), (".m .m a", "2"), ("div.m p a", "1"), ("p .m a", ""), ("br", "b"), ("a b c d", "")]:
        rows = elements.select_all(spark.createDataFrame([(1, page)], "k int, html string"), "k", F.lit(chain)).orderBy("pos").collect()
        assert "".join("b" if r.tag == "br" else r.piece[-3] for r in rows) == want, chain


def test_body_candidates_leave_boilerplate_and_count_links(spark):
    page = """<html><head><title>no</title></head><body><nav><article>menu</article></nav>
      <article>First   line<br>second <b>bo</b>ld&apos;s <a href="/x">link</a><div class="my-share"><p>shared shared shared shared</p></div>
      <p>A paragraph of enough characters.<p>A paragraph of enough characters.<ul><li>one</ul></article><footer>end</footer></body></html>"""
    rows = page_bodies.body_candidates(spark.createDataFrame([(1, page), (2, ""), (3, None)], "k int, html string"), "k").collect()
    found = {r.k: {c.selector: c for c in r.candidates} for r in rows}
    text = "First line\nsecond bold's link\nA paragraph of enough characters.\nA paragraph of enough characters.\none"
    article = found[1]["article"]
    assert (article.text, article.text_length, article.paragraph_count, article.link_text_ratio) == (text, len(text), 2, round(4 / len(text), 3))
    assert found[1]["paragraph_fallback"].text == "A paragraph of enough characters." and found[1][page_bodies.BODY_FALLBACK].text == text
    assert found[1]["main"].text == "" and set(found[2]) == set(found[3]) == {*found[1]} - {"paragraph_fallback"}
    assert {c.text_length for k in (2, 3) for c in found[k].values()} == {0}


def plain_walks(starts, edges, limit):
    out, seen = [], {}
    for site, start, url in sorted(starts):
        at = url
        for depth in range(limit):
            if at is None or at in seen.setdefault(site, set()):
                break
            seen[site].add(at)
            out.append((site, start, depth, at))
            at = edges.get(at)
    return sorted(out)


def test_many_starts_and_long_walks_take_few_jobs(spark):
    rng = random.Random(2)
    edges = {f"p{i}": f"p{rng.choice([i + 1, i + 1, rng.randrange(900)])}" for i in range(900)}
    starts = [("s", i, f"p{rng.randrange(900)}") for i in range(200)] + [("t", i, f"p{rng.randrange(900)}") for i in range(3)]
    frame = spark.createDataFrame([(*s, 64) for s in starts], "site string, start int, url string, max_pages int")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    found = lookup.crawl_pages(frame, spark.createDataFrame(list(edges.items()), "url string, next_url string"))
    got = sorted(map(tuple, found.select("site", "start", "depth", "url").collect()))
    assert got == plain_walks(starts, edges, 64)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) - before < 120


@pytest.mark.parametrize("fold_rows", [0, 7, dedupe.FOLD_ROWS])
def test_greedy_rounds_and_walk_agree(spark, fold_rows):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, *range(25)]), rng.randrange(25)) for i in range(200)]
    rows = [r for r in rows if r[1] is not None]
    used, want = (set(), set()), []
    for o, a, b in rows:
        if a not in used[0] and b not in used[1]:
            used[0].add(a)
            used[1].add(b)
            want.append(o)
    got = dedupe.greedy_by_either_key(spark.createDataFrame(rows, "ord int, a int, b int").repartition(4), "a", "b", "ord", fold_rows)
    assert sorted(r.ord for r in got.collect()) == want


def test_a_chain_of_ten_thousand_conflicts(spark):
    rows = [(i, (i + 1) // 2, i // 2) for i in range(10_000)]  # each row shares one key with the row before it
    start = time.time()
    got = dedupe.greedy_by_either_key(spark.createDataFrame(rows, "ord int, a int, b int"), "a", "b", "ord")
    assert sorted(r.ord for r in got.collect()) == list(range(0, 10_000, 2))
    assert time.time() - start < 240


def test_site_watch_with_selectors_final_urls_and_search(spark):
    config = [
        # site, lists, order, fetch mode, link, list date, article date, next page, fallback
        ("Sel", "https://a.example.com/list", "1", "", "ul.news a", "time", "", "a.more", "require_date"),
        ("Art", "https://b.example.com/", "2", "", "", "", "p.when b", "", "require_date"),
        ("Find", "https://gone.example.com/", "3", "direct_then_search", "", "", "", "", "use_fetched_at"),
        ("Only", "", "4", "search_only", "", "", "", "", "require_date"),
    ]
    names = ["site_name", "list_page_urls", "display_order", "fetch_mode", "article_link_selector", "list_date_selector", "article_date_selector", "next_page_selector", "date_fallback_mode"]
    raw = spark.createDataFrame([(*c, "3") for c in config], ", ".join(f"{n} string" for n in [*names, "max_pages"]))
    sites = shaping.normalize_site_config(raw).withColumnRenamed("site_name", "site")
    first = '<ul class="news"><li><a href="n/1">One <time>2026/04/05 08:30</time></a></li></ul><a href="/other">Other 2026/04/05 08:30</a><a class="more" href="?p=2">on</a><a rel="next" href="/trap">next</a>'
    captures = spark.createDataFrame(
        [
            ("https://a.example.com/list", "https://a.example.com/moved/list", first), ("https://a.example.com/moved/list?p=2", None, '<ul class="news"><a href="/n/2">Two <time>2026/04/05 07:30</time></a></ul>'),
            ("https://a.example.com/trap", None, '<ul class="news"><a href="/n/9">Trap <time>2026/04/05 07:30</time></a></ul>'),
            ("https://b.example.com/", None, '<a href="/x">Article</a>'), ("https://b.example.com/x", None, '<p class="when">on <b>2026/04/05 06:00</b></p>'),
        ],
        "url string, final_url string, html string",
    )
    results = lambda *items: json.dumps({"organic_results": [dict(zip(("title", "link", "date"), i, strict=True)) for i in items]})
    payloads = spark.createDataFrame(
        [
            ("Find", "", results(("Found", "https://f.example.com/1", "soon"), ("One", "https://f.example.com/2", ""))), ("Only", "", results(("Undated", "https://o.example.com/1", ""), ("Dated", "https://o.example.com/2", "2026/04/05"))),
            ("Sel", "", results(("Not asked", "https://q.example.com/1", "2026/04/05"))),
        ],
        "site string, search_url_pattern string, payload string",
    )
    got = site_digest.build(sites, captures, D.ntz("2026-04-05 01:00:00"), payloads=payloads).orderBy("position").collect()
    assert [(r.site, r.url.split("example.com")[1], r.title, r.date_source) for r in got] == [
        ("Sel", "/moved/n/1", "One 2026/04/05 08:30", "list_selector"), ("Sel", "/n/2", "Two 2026/04/05 07:30", "list_selector"), ("Art", "/x", "Article", "article_selector"),
        ("Find", "/1", "Found", "fetched_at"), ("Find", "/2", "One", "fetched_at"), ("Only", "/2", "Dated", "search_date"),
    ]


def test_a_url_captured_several_times_is_several_pages(spark):
    names = ["site_name", "list_page_urls", "max_pages", "max_items_per_site", "date_fallback_mode", "next_page_selector"]
    raw = spark.createDataFrame([(s, f"https://{s or 'a'}.example.com/list", "3", "9", "use_fetched_at", s and "a.more") for s in ("", "b")], ", ".join(f"{n} string" for n in names))
    sites = shaping.normalize_site_config(raw.replace("", "a", ["site_name"])).withColumnRenamed("site_name", "site")
    old = '<p><b>x</b><a href="/n/1">One</a> <a href="/n/2">Two</a></p><a class="more" rel="next" href="/list/old">next</a>'
    new = '<a href="/n/3">Three</a> <a href="/n/2">Two again</a><p><i>y</i></p><a class="more" rel="next" href="/list/new">onward</a>'
    more = [("/list", old), ("/list", new), ("/list", old), ("/list/old", '<a href="/n/4">Four</a>'), ("/list/new", '<a href="/n/5">Five</a><a class="more" rel="next" href="/list">first</a>')]
    captures = spark.createDataFrame([(f"https://{s}.example.com{at}", html) for s in "ab" for at, html in more], "url string, html string")
    starts = spark.createDataFrame([(s, "x", f"https://{s}.example.com/list") for s in "ab" for _ in range(2)], "site string, start string, url string")
    pages = site_digest.visited_pages(sites, captures, starts)
    assert sorted((r.site, r.depth, r.url.split(".com")[1]) for r in pages.collect()) == [(s, *at) for s in "ab" for at in ((0, "/list"), (0, "/list"), (1, "/list/new"), (1, "/list/old"))]
    kept, _ = site_digest.decisions(sites, pages, captures, D.ntz("2026-04-05 01:00:00"))
    assert sorted((r.site, r.url.split(".com")[1]) for r in kept.collect()) == [(s, f"/{at}") for s in "ab" for at in ("list", "list/new", "list/old", "n/1", "n/2", "n/3", "n/4", "n/5")]


def test_walks_over_several_next_pages_stop_branch_by_branch(spark):
    starts = spark.createDataFrame([("s", 0, "c", 1), ("s", 1, "a", 4), ("s", 1, "a", 4), ("t", 1, "a", 4)], "site string, start int, url string, max_pages int")
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "b"), ("b", "d"), ("c", "e"), ("d", "a"), ("e", "f")], "url string, next_url string")
    got = sorted(map(tuple, lookup.crawl_pages(starts, edges, several=True).collect()))
    assert got == [
        ("s", 0, 0, "c"), ("s", 1, 0, "a"), ("s", 1, 1, "b"), ("s", 1, 2, "d"),
        ("t", 1, 0, "a"), ("t", 1, 1, "b"), ("t", 1, 1, "c"), ("t", 1, 2, "d"), ("t", 1, 2, "e"), ("t", 1, 3, "f"),
    ]
