"""Specialist feeds: date rules, windows, title dedupe, a limit for each medium and one overall budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions import dates as D
from gleaner.functions import text as T
from gleaner.functions import urls as U
from gleaner.operators import dedupe, digest, ranking, windows
from gleaner.operators.extraction import extract_datetime_by_rule

PAGE_COLUMNS = ["final_url", "canonical_url", "html", "ld_date", "sel_found", "sel_attr", "sel_text"]


def decisions(entries: DataFrame, media: DataFrame, captures: DataFrame, as_of: Column) -> DataFrame:
    """Every entry with its publication time and decision: the audit table.

    ``media`` holds one row of rule and limits for each medium and joins by size; ``captures`` holds one row for each
    link with the columns of ``PAGE_COLUMNS``. Only entries whose rule reads pages join them.
    """
    ruled = entries.withColumn("link", U.normalize_link("link")).join(media, "medium")
    reads_page = ["article_html", "meta", "json_ld", "url"]
    needs = F.col("date_source_type").isin(reads_page) | F.col("fallback_date_source_type").isin(reads_page)
    pages = captures.select(F.col("url").alias("_u"), *PAGE_COLUMNS)
    joined = ruled.where(needs).join(pages, F.col("link") == F.col("_u"), "left").drop("_u")
    plain = ruled.where(~needs)
    for c in PAGE_COLUMNS:
        plain = plain.withColumn(c, F.lit(None).cast(dict(pages.dtypes)[c]))
    return windows.decide(extract_datetime_by_rule(joined.unionByName(plain)), as_of)


def items(decided: DataFrame, budget: int | Column = K.ITEMS_TOTAL) -> DataFrame:
    """Kept items of each medium, within its limit and the overall budget.

    Media fill the budget by ``display_order``, then ``config_ord`` when given.
    """
    local = D.to_zone("published_utc", F.col("date_timezone"))
    place = ["display_order", *(["config_ord"] if "config_ord" in decided.columns else [])]
    accepted = decided.where(F.col("decision") == "accepted").select(
        "medium", *place, "max_items", "feed_ord", "entry_ord",
        T.strip_tags(T.text("title")).alias("title"), "link", D.label(local, F.col("date_granularity")).alias("published"),
    )
    order = ["feed_ord", "entry_ord"]
    unique = dedupe.by_title(accepted, "medium", "title", list(order))
    limited = ranking.first_n(unique, ["medium"], list(order), "max_items")
    return ranking.budget_across_groups(limited, "medium", place, list(order), budget)


def sections(kept: DataFrame, media: DataFrame) -> DataFrame:
    """One row for each medium in display order; media without items stay."""
    placed = kept.withColumn("_at", F.struct("feed_ord", "entry_ord"))
    listed = digest.sections(placed, media.select("medium", "display_order"), "medium", "_at", ["title", "link", "published"])
    return listed.orderBy("display_order", "medium")
