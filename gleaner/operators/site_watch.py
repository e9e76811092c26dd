"""Steps of the site watch: links of listing pages, search results, and the cross-site budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import dates as D
from gleaner.functions import html as H
from gleaner.functions import text as T
from gleaner.functions import urls as U
from gleaner.operators import dedupe, numbering, ranking
from gleaner.operators.filters import passes_url_pattern

RETRY_STATUSES = ["403", "404", "error", "not_attempted"]


def page_links(pages: DataFrame, keys: list[str], url: str = "url", html: str = "html") -> DataFrame:
    """Anchors of each page in page order: absolute link, href as written, title."""
    exploded = pages.select(*keys, F.col(url).alias("_base"), F.posexplode(H.anchors(html)).alias("pos", "_a"))
    return exploded.select(
        *keys, "pos", U.url_join("_base", "_a.href").alias("link"), F.col("_a.href").alias("href"), F.col("_a.title").alias("title")
    )


def link_candidates(pages: DataFrame, keys: list[str], pattern: Column, url: str = "url", html: str = "html") -> DataFrame:
    """Links that pass the site's URL pattern, first per comparable URL on the page, with a title."""
    rows = page_links(pages, keys, url, html).where(passes_url_pattern(F.col("link"), F.col("href"), pattern))
    return dedupe.candidates(rows, keys, "link", "title", ["pos"])


def search_candidates(payloads: DataFrame, as_of: Column) -> DataFrame:
    """Rows of captured search payloads: link and title needed, optional link pattern, source name or the site's."""
    schema = "struct<organic_results:array<struct<title:string,link:string,date:string,snippet:string,source:string>>>"
    items = payloads.select(
        "site", F.coalesce(F.col("search_url_pattern"), F.lit("")).alias("_p"),
        F.posexplode(F.from_json("payload", schema)["organic_results"]).alias("pos", "r"),
    )
    rows = items.select(
        "site", "_p", "pos", T.strip(T.text("r.title")).alias("title"), T.strip(T.text("r.link")).alias("url"),
        T.strip(T.text("r.date")).alias("date_text"),
        F.when(T.text("r.date") != "", F.lit("search_date")).otherwise(F.lit("fetched_at")).alias("date_source"),
        T.strip(T.text("r.snippet")).alias("snippet"),
        F.coalesce(T.presence("r.source"), F.col("site")).alias("site_name"), as_of.alias("fetched_at"),
    )
    kept = rows.where((F.col("url") != "") & (F.col("title") != "") & ((T.strip("_p") == "") | F.rlike(F.col("url"), T.strip("_p"))))
    return kept.drop("_p")


def direct_then_search(sites: DataFrame, direct: DataFrame, search: DataFrame, max_items: int | str) -> DataFrame:
    """Direct rows, then search rows of sites whose direct fetch failed or found nothing (or that only search).

    ``sites`` is ``site, fetch_mode, direct_status``; rows are ``site, ord, url``; ``part`` tells 0 from 1.
    """
    found = direct.groupBy("site").agg(F.count("*").alias("_n"))
    known = sites.join(found, "site", "left")
    empty = F.coalesce("_n", F.lit(0)) == 0
    failed = F.col("direct_status").isin(RETRY_STATUSES)
    wants = known.where(
        (F.col("fetch_mode") == "search_only") | ((F.col("fetch_mode") == "direct_then_search") & (failed | empty))
    ).select("site")
    extra = search.join(wants, "site", "left_semi")
    both = direct.withColumn("part", F.lit(0)).unionByName(extra.withColumn("part", F.lit(1)), allowMissingColumns=True)
    unique = dedupe.accepted(both, "site", "url", F.lit(True), ["part", "ord"])
    return ranking.first_n(unique, ["site"], ["part", "ord"], max_items)


def site_items(
    candidates: DataFrame, as_of: Column, in_window: Column, title_reason: Column, max_items: str
) -> tuple[DataFrame, DataFrame]:
    """(accepted items of each site in page order, every candidate with its decision).

    ``published_local`` is the parsed time or null; ``date_fallback_mode`` may replace a missing one by the run time.
    """
    when_, source = D.fallback_to_run_time(
        F.col("published_local"), F.col("date_fallback_mode"), F.col("date_source"), D.to_zone(as_of, F.col("date_timezone"))
    )
    dated = candidates.withColumns({"published_local": when_, "date_source": source})
    decision = (
        F.when(title_reason != "accepted", title_reason)
        .when(F.col("published_local").isNull(), F.lit("date_parse_failed"))
        .when(~in_window, F.lit("out_of_window"))
        .otherwise(F.lit("accepted"))
    )
    judged = dated.withColumn("decision", decision)
    items = dedupe.accepted(judged, "site", "url", F.col("decision") == "accepted", ["ord"])
    return ranking.first_n(items, ["site"], ["ord"], max_items), judged


def dedupe_and_limit(sites: DataFrame, items: DataFrame) -> DataFrame:
    """Cross-site digest: sites in display order (then ``config_ord`` when given), repeats by URL or title dropped, one overall budget.

    The budget is the smallest ``max_items_total`` among sites that deliver, 50 when none does. Dropped rows do not
    count, so the kept rows are the first of the greedy order.
    """
    limit = F.coalesce(
        sites.agg(F.min(F.when(F.col("delivery_enabled"), F.col("max_items_total"))).alias("b")).scalar(), F.lit(50)
    )
    place = ["display_order", *(["config_ord"] if "config_ord" in sites.columns else [])]
    rows = items.join(sites.select("site", *place), "site").withColumns(
        {"_u": U.normalize_url("url"), "_t": T.title_space_key("title")}
    )
    placed = numbering.with_position(rows, [*place, "site", "ord"], "_at")
    kept = dedupe.greedy_by_either_key(placed, "_u", "_t", "_at")
    ranked = numbering.with_position(kept, ["_at"], "position")
    return ranked.where(F.col("position") < limit).drop("_u", "_t", "_at")
