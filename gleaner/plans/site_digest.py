"""Site watch: crawl order, link candidates, dates from lists or article pages, windows, limits, search fallback, cross-site dedupe.

``captures`` is ``url, html`` and may have ``final_url``, where the page was in the end: links count from there. A url that was captured
several times with different content is as many pages; exact repeats are one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import dates as D
from gleaner.functions import html as H
from gleaner.functions import text as T
from gleaner.functions import urls as U
from gleaner.operators import dedupe, elements, filters, lookup, ranking, site_watch, windows
from gleaner.session import cut_lineage

#: How sites that read listings are fetched; the others only search.
DIRECT = ["direct", "direct_then_search"]
#: Settings of a site that judge its items.
RULES = [
    "article_date_pattern", "article_date_selector", "fetch_article_body", "date_timezone", "date_granularity", "target_date_mode", "lookback_hours",
    "date_fallback_mode", "max_items_per_site", "include_title_pattern", "exclude_title_pattern",
]


def _base(captures: DataFrame) -> Column:
    return F.coalesce("final_url", "url") if "final_url" in captures.columns else F.col("url")


def keyed_pages(captures: DataFrame) -> DataFrame:
    """``(url, base, html, page)`` for each capture; ``page`` is its key, the same for exact repeats."""
    each = captures.select("url", _base(captures).alias("base"), "html")
    return each.withColumn("page", F.md5(F.concat_ws("\x01", "url", "base", F.md5("html"))))


def distinct_pages(captures: DataFrame) -> DataFrame:
    """Each different capture once. Rows move once, by url, also for a join by url that follows."""
    return keyed_pages(captures).repartition("url").distinct()


def page_edges(pages: DataFrame) -> DataFrame:
    """Next-page link of every page, resolved; empty when there is none. The link is found once, before it is resolved."""
    found = pages.select("page", "url", "base", T.fence(H.next_page_href("html")).alias("_href"))
    return found.select("page", "url", F.when(F.col("_href") != "", U.url_join("base", "_href")).otherwise(F.lit("")).alias("next_url"))


def own_edges(sites: DataFrame, pages: DataFrame) -> DataFrame:
    """``(site, url, next_url)`` for sites with a next-page selector and the pages of their hosts: the first link that it names, else as ``page_edges``."""
    hosts = sites.select("site", F.col("next_page_selector").alias("_s"), F.explode("list_page_urls").alias("u")).select("site", "_s", U.bare_host("u").alias("_h")).distinct()
    hosted = pages.withColumn("_h", U.bare_host("url")).join(hosts, "_h")
    keyed = hosted.withColumn("_page", F.concat_ws("\x01", "site", "page"))
    named = elements.select_all(keyed, "_page", F.col("_s")).groupBy("_page").agg(F.min_by("piece", "pos").alias("piece"))
    target = named.select("_page", F.concat(*[F.regexp_extract("piece", H.TARGET, i) for i in (1, 2, 3)]).alias("_href"))
    own = keyed.select("site", "page", "base", "_page").join(target, "_page", "left").withColumn("_href", T.fence(T.strip(T.text("_href"))))
    both = own.join(page_edges(pages), "page")
    return both.select("site", "url", F.when(F.col("_href") != "", U.url_join("base", "_href")).otherwise(F.col("next_url")).alias("next_url"))


def visited_pages(sites: DataFrame, captures: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """Captured listing pages of every enabled site in visiting order, with their markup: as many from each start as the site allows.

    ``starts`` (``site, start, url``, by the order of ``start``) stands for the sites' own lists where these are too long for a row.
    """
    config = sites.where(F.col("enabled") & F.col("fetch_mode").isin(DIRECT))
    given = config.select("site", F.posexplode("list_page_urls").alias("start", "url")) if starts is None else starts
    limits = given.join(config.select("site", "max_pages", (F.col("next_page_selector") != "").alias("_own")), "site")
    pages = distinct_pages(captures)
    walks = lookup.crawl_pages(limits.where("NOT _own").drop("_own"), page_edges(keyed_pages(captures)).drop("page"), several=True)
    chosen = config.where("next_page_selector <> ''")
    if not chosen.isEmpty():
        walks = walks.unionByName(lookup.crawl_pages(limits.where("_own").drop("_own"), own_edges(chosen, pages), several=True))
    # what follows reads these pages many times: without their history its plans stay small
    return cut_lineage(cut_lineage(walks).join(pages, "url"))


def _used(config: DataFrame) -> set[str]:
    """Selectors that some site sets: steps that none needs are left out of the plan."""
    names = ["article_link_selector", "list_date_selector", "article_date_selector"]
    found = config.agg(*[F.coalesce(F.max(F.col(n) != ""), F.lit(False)).alias(n) for n in names]).first()
    return {n for n in names if found[n]}


def candidates(config: DataFrame, pages: DataFrame, used: set[str]) -> DataFrame:
    """Links of the visited pages that fit their site's selector and pattern, with the date text beside them: the first of each url at a place of a walk.

    Places of links count within each page, also where a walk reads several pages at once.
    """
    told = config.select("site", *[F.col(c).alias(f"_{c}") for c in ("article_link_selector", "list_date_selector", "list_date_pattern", "article_url_pattern")])
    visit = F.concat_ws("\x01", "site", F.col("start").cast("string"), F.col("depth").cast("string"), "page")
    keyed = pages.withColumn("_page", F.md5(visit)).join(told, "site")
    asked = lambda name: F.col(f"_{name}") if name in used else None
    links = elements.links_in_context(keyed, "_page", selector=asked("list_date_selector"), pattern=F.col("_list_date_pattern"), link=asked("article_link_selector"))
    text, source = elements.list_date(F.lit(".+"))
    dated = links.select("_page", "pos", "href", "title", text.alias("date_text"), source.alias("date_source"))
    placed = dated.join(keyed.select("_page", "site", "start", "depth", "page", "base", "_article_url_pattern"), "_page")
    rows = placed.withColumn("link", U.url_join("base", "href")).where(filters.passes_url_pattern(F.col("link"), F.col("href"), F.col("_article_url_pattern")))
    return dedupe.candidates(rows, ["site", "start", "depth"], "link", "title", ["pos", "page"]).select(
        "site", F.struct(F.lit(0).alias("part"), "start", "depth", "pos", "page").alias("ord"), F.col("link").alias("url"), "title", "date_text", "date_source"
    )


def decisions(sites: DataFrame, pages: DataFrame, captures: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted items of each site, every candidate with its decision)."""
    config = sites.where("enabled")
    # links are found once, and what follows reads them several times
    used = _used(config)
    rows = cut_lineage(candidates(config, pages, used)).join(config.select("site", *RULES), "site")
    tz, gran = F.col("date_timezone"), F.col("date_granularity")
    parse = D.parse_date_text_local("date_text", tz, gran)
    dated = lookup.enrich_dates(
        rows.withColumn("published_local", parse), captures, "published_local", "article_date_pattern", parse, "fetch_article_body",
        "article_date_selector" if "article_date_selector" in used else None,
    )
    in_window = windows.in_site_window(
        D.from_zone("published_local", tz), as_of, F.col("target_date_mode"), F.col("lookback_hours"), tz
    )
    reason = filters.title_filter_reason(F.col("title"), F.col("include_title_pattern"), F.col("exclude_title_pattern"))
    return site_watch.site_items(dated, as_of, in_window, reason, "max_items_per_site")


def search_items(sites: DataFrame, payloads: DataFrame, as_of: Column) -> DataFrame:
    """Search results of the given sites whose date lies in the window; one without a date only where the site takes the run's time or any."""
    rows = site_watch.search_candidates(payloads, as_of).select("site", "pos", "title", "url", "date_text", "date_source").join(sites.select("site", *RULES), "site")
    tz = F.col("date_timezone")
    parsed = D.parse_date_text_local("date_text", tz, F.col("date_granularity"))
    when_, source = D.fallback_to_run_time(parsed, F.col("date_fallback_mode"), F.col("date_source"), D.to_zone(as_of, tz))
    dated = rows.withColumns({"published_local": when_, "date_source": source})
    inside = windows.in_site_window(D.from_zone("published_local", tz), as_of, F.col("target_date_mode"), F.col("lookback_hours"), tz)
    undated = F.col("published_local").isNull() & (F.col("date_fallback_mode") != "require_date")
    kept = dated.where(undated | (F.col("published_local").isNotNull() & inside))
    return kept.withColumn("published_local", F.coalesce("published_local", D.to_zone(as_of, tz)))


def with_search(sites: DataFrame, starts: DataFrame, pages: DataFrame, kept: DataFrame, judged: DataFrame, payloads: DataFrame, as_of: Column) -> DataFrame:
    """Accepted items with search results behind them, for sites that only search or whose listings failed or named no link."""
    seen = pages.groupBy("site").agg(F.lit(True).alias("_read"))
    linked = judged.groupBy("site").agg(F.lit(True).alias("_linked"))
    asked = sites.where("enabled").join(seen, "site", "left").join(linked, "site", "left")
    failed = F.col("_read").isNull() | F.col("_linked").isNull()
    wants = asked.where((F.col("fetch_mode") == "search_only") | ((F.col("fetch_mode") == "direct_then_search") & failed)).drop("_read", "_linked")
    shape = kept.schema["ord"].dataType
    first = F.struct(F.lit(1).alias("part"), *[F.lit(None).cast(shape[f].dataType).alias(f) for f in ("start", "depth")], F.col("pos").cast(shape["pos"].dataType).alias("pos"), F.lit(None).cast("string").alias("page"))
    columns = ["site", "ord", "url", "title", "date_source", "published_local", "max_items_per_site"]
    found = search_items(wants, payloads, as_of).withColumn("ord", first).select(columns)
    unique = dedupe.accepted(kept.select(columns).unionByName(found), "site", "url", F.lit(True), ["ord"])
    return ranking.first_n(unique, ["site"], ["ord"], "max_items_per_site")


def build(sites: DataFrame, captures: DataFrame, as_of: Column, starts: DataFrame | None = None, payloads: DataFrame | None = None) -> DataFrame:
    pages = visited_pages(sites, captures, starts)
    kept, judged = decisions(sites, pages, captures, as_of)
    columns = ["site", "ord", "url", "title", "date_source", "published_local"]
    if payloads is not None:
        kept = with_search(sites, starts, pages, kept, judged, payloads, as_of)
    return site_watch.dedupe_and_limit(sites, kept.select(columns))
