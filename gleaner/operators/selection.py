"""Choosing the report's articles from scored ones, by two rule sets that differ in ties and order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import text as T
from gleaner.operators.numbering import with_position
from gleaner.operators.ranking import kth_value
from gleaner.session import cut_lineage

# What the selections look at.
SCORES = ["exclude_candidate", "importance_score", "priority", "text_length", "issue_date", "published_at", "title", "url"]


def score_table(df: DataFrame, key: str, ord: str = "ord") -> DataFrame:
    """Key, order and scores of every row, evaluated once and kept in the checkpoint folder.

    Each selection below reads its input more than once: for a cutoff, a count, and the rows themselves. Give it
    this table, so that scoring runs once; texts are joined by key to the rows that were chosen.
    """
    return cut_lineage(df.select(key, ord, *[c for c in SCORES if c in df.columns and c not in (key, ord)]))


def scored_order(ord: str = "ord") -> list[Column]:
    return [
        F.col("exclude_candidate").asc(), F.col("importance_score").desc(), F.col("priority").desc(),
        F.col("text_length").desc(), F.col(ord).asc(),
    ]


def select_report(
    df: DataFrame, mode: str = "top_importance_rank", min_score: float = 5.0, top_rank: int = 5, include_ties: bool = True,
    ord: str = "ord",
) -> DataFrame:
    """Selected rows; off-topic rows stay eligible and every order runs downwards."""
    rows = df.where(F.col("importance_score").isNotNull())
    if mode.strip().lower() == "threshold":
        return rows.where(F.col("importance_score") >= min_score)
    if top_rank <= 0:
        return rows
    if include_ties:
        return rows.where(F.col("importance_score") >= kth_value(rows, "importance_score", top_rank))
    return rows.orderBy(
        F.col("importance_score").desc(), F.col("priority").desc(), T.text("issue_date").desc(), T.text("title").desc(),
        F.col(ord).asc(),
    ).limit(top_rank)


def pool_order(ord: str = "ord") -> list[Column]:
    return [
        F.col("importance_score").desc(), F.coalesce("priority", F.lit(0)).desc(), T.text("published_at").asc(),
        T.text("title").asc(), F.col(ord).asc(),
    ]


def select_from_pool(
    df: DataFrame, mode: str = "top_importance_rank", min_score: float = 0.0, top_rank: int = 5, include_ties: bool = True,
    ord: str = "ord",
) -> DataFrame:
    """Selected rows; off-topic and unscored rows are out, and rows without a positive score count only when
    there are too few positive ones."""
    rows = df.where(F.col("importance_score").isNotNull() & ~F.coalesce("exclude_candidate", F.lit(False)))
    if mode == "threshold":
        return rows.where(F.col("importance_score") >= min_score)
    enough = rows.agg(F.count_if(F.col("importance_score") > 0).alias("n")).scalar() >= top_rank
    pool = rows.where(~enough | (F.col("importance_score") > 0))
    if include_ties:
        return pool.where(F.col("importance_score") >= kth_value(pool, "importance_score", top_rank))
    return pool.orderBy(*pool_order(ord)).limit(top_rank)


def selection_log(
    candidates: DataFrame, selected: DataFrame, order: list[Column], cutoff: Column | None, mode: str, title: str = "title"
) -> DataFrame:
    """One row about a selection: counts, cutoff, and titles and scores in order; ``order`` must be total.

    Rows get their place by ranges, not in one task; only titles and scores, which become one value, are gathered.
    """
    n = candidates.agg(F.count("*").alias("n")).scalar()
    listed = F.array_sort(
        F.collect_list(F.struct(F.col("_at").alias("at"), F.col(title).alias("title"), F.col("importance_score").alias("score")))
    )
    ranked = with_position(selected, order, "_at")
    out = ranked.agg(F.count("*").alias("report_selected_count"), listed.alias("_rows"), F.min("importance_score").alias("_min"))
    return out.select(
        F.lit(mode).alias("report_selection_mode"),
        n.alias("report_candidate_count"),
        "report_selected_count",
        (F.col("_min") if cutoff is None else cutoff).alias("report_cutoff_importance_score"),
        F.transform("_rows", lambda r: r["title"]).alias("selected_article_titles"),
        F.transform("_rows", lambda r: r["score"]).alias("selected_article_scores"),
        F.greatest(F.lit(0), n - F.col("report_selected_count")).alias("excluded_article_count"),
    )


def mark_selected(df: DataFrame, selected: DataFrame, url: str = "url", threshold_mode: bool = False) -> DataFrame:
    """Flag every row whose URL was selected, with the reason; equal URLs share the flag."""
    picked = selected.select(T.text(url).alias("_picked")).distinct()
    included = F.col("_picked").isNotNull()
    chosen = "above_threshold" if threshold_mode else "top_importance_rank_or_tie"
    left_out = "below_threshold" if threshold_mode else "below_top_rank_cutoff"
    joined = df.join(picked, T.text(url) == F.col("_picked"), "left")
    return joined.withColumns(
        {
            "included_in_report": included,
            "report_selection_reason": F.when(included, F.lit(chosen)).otherwise(F.lit("")),
            "report_excluded_reason": F.when(included, F.lit("")).otherwise(F.lit(left_out)),
        }
    ).drop("_picked")
