"""What the plans look like: limits before shuffles, hashed joins, no Python in expression-only operators."""

import pytest
from pyspark.sql import functions as F

from gleaner.catalog import base, load
from gleaner.operators import ranking

QUERIES, _ = load()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["first_n_per_feed", "dedupe_title", "dedupe_url_title", "top_per_medium", "general_digest", "last_wins"])
def test_rows_are_cut_before_the_shuffle(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "WindowGroupLimit" in text and "Partial" in text


EXPRESSION_ONLY = [
    "normalize_url", "dedupe_key", "parse_flexible_datetime", "parse_date_text", "body_metrics", "validate_body", "accept_body",
    "exclude_topics", "topic_score", "bucket_score", "page_links", "paragraph_text", "window_decision", "chunk_text",
]


@pytest.mark.parametrize("name", EXPRESSION_ONLY)
def test_expressions_stay_in_the_engine(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "Python" not in text and "Pandas" not in text
    assert "Exchange" not in text  # map-only


@pytest.mark.parametrize("name", ["split_existing", "resolve_page_id", "match_rules", "match_rules_joined", "translation_lookup", "selected_semi", "general_digest"])
def test_no_nested_loop_or_cross_product(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(base.entries(spark, sf_dir).groupBy("feed").agg(F.count("*")))
    assert "ReadSchema: struct<event_type:string>" in text


def test_time_windows_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["window_main"](spark, sf_dir))
    assert "PushedFilters" in text and "GreaterThanOrEqual(ts" in text


def test_per_group_limits_split_hot_groups(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id", F.lit(2).alias("n"))
    text = plan(ranking.first_n(df, ["g"], ["id"], "n"))
    assert text.count("Window [row_number()") == 2 and "_salt" in text


def test_costly_columns_are_not_copied_into_filters(spark, sf_dir):
    text = plan(QUERIES["select_report_threshold"](spark, sf_dir))
    assert text.count("least(3") == 1
