"""Run summaries. One pass of conditional counts each, combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import text as T


def fetch_summary(outcomes: DataFrame) -> DataFrame:
    """Counts over ``outcome`` (``success…``, ``failed:…``, ``excluded:…``), flags and ``origin``."""
    o = F.col("outcome")
    failed = o.startswith("failed:")
    return outcomes.agg(
        F.count("*").alias("attempted"),
        F.count_if(o.startswith("success")).alias("fetch_success"),
        F.count_if(failed).alias("fetch_failed"),
        F.count_if(o.startswith("excluded:")).alias("excluded"),
        F.count_if(failed & (F.col("text_length") == 0)).alias("empty_body"),
        F.count_if(failed & F.col("text_length").between(1, 119)).alias("too_short"),
        F.count_if(failed & F.col("login_wall")).alias("login_wall"),
        F.count_if(failed & F.col("paid_wall")).alias("paid_wall"),
        F.count_if(failed & F.col("access_denied")).alias("access_denied"),
        F.count_if(o.startswith("success") & (F.col("origin") == "backfill")).alias("backfill_success"),
        F.count_if(failed & (F.col("origin") == "backfill")).alias("backfill_failed"),
    )


def reason_counts(df: DataFrame, *columns: str) -> DataFrame:
    """How often each first non-empty reason occurs."""
    reason = F.coalesce(*[F.nullif(T.text(c), F.lit("")) for c in columns], F.lit("unknown"))
    return df.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def reason_map(counts: DataFrame) -> DataFrame:
    """The counts as one map; reasons are a fixed small set."""
    entries = F.array_sort(F.collect_list(F.struct("reason", "n")))
    return counts.agg(F.map_from_entries(entries).alias("failure_reason_counts"))


def decision_rollup(df: DataFrame, site: str, decision: str) -> DataFrame:
    """Counts for each site and decision, each site, and overall."""
    return df.rollup(site, decision).agg(F.count("*").alias("n"))


def score_summary(scored: DataFrame, score: str, matched: Column, title_only: Column) -> DataFrame:
    s = F.col(score)
    return scored.agg(
        F.count("*").alias("articles"),
        F.coalesce(F.max(s), F.lit(0.0)).alias("max_score"),
        F.coalesce(F.min(s), F.lit(0.0)).alias("min_score"),
        F.coalesce(F.avg(s), F.lit(0.0)).alias("avg_score"),
        F.count_if(matched).alias("with_match"),
        F.count_if(title_only).alias("title_only"),
    )


def rules_by_type(rules: DataFrame, kind: str, keywords: str) -> DataFrame:
    return rules.groupBy(F.coalesce(F.nullif(T.text(kind), F.lit("")), F.lit("(empty)")).alias("rule_type")).agg(
        F.count("*").alias("rules"), F.sum(F.size(keywords)).alias("keywords")
    )


def usage_totals(calls: DataFrame) -> DataFrame:
    """Hits, misses, calls and token counts of a lookup run."""
    return calls.agg(
        F.count_if(F.col("hit")).alias("cache_hits"),
        F.count_if(~F.col("hit")).alias("cache_misses"),
        F.sum("calls").alias("api_calls"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        (F.sum("prompt_tokens") + F.sum("completion_tokens")).alias("total_tokens"),
    )
