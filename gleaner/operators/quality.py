"""Is this text a real article body? Metrics and gates, computed within the row.

Duplicate lines are counted by sorting a page's lines and comparing neighbours, so a page with very many
lines costs n log n in its own row and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions import text as T
from gleaner.functions.numbers import ratio


def _repeated_lines(ordered: Column) -> Column:
    """How many lines of a sorted array have an equal neighbour."""
    before = F.concat(F.array(F.lit(None).cast("string")), ordered)
    after = F.slice(ordered, F.lit(2), F.greatest(F.size(ordered), F.lit(1)))
    pairs = F.zip_with(
        ordered, before, lambda cur, prev: F.struct(cur.alias("line"), F.coalesce(cur == prev, F.lit(False)).alias("same"))
    )
    marks = F.zip_with(
        pairs, after, lambda p, nxt: (p["same"] | F.coalesce(p["line"] == nxt, F.lit(False))).cast("int")
    )
    return F.aggregate(marks, F.lit(0), lambda acc, m: acc + F.coalesce(m, F.lit(0)))


def _is_link_like(line: Column) -> Column:
    found = F.contains(line, F.lit(K.LINK_MARKS[0]))
    for mark in K.LINK_MARKS[1:]:
        found = found | F.contains(line, F.lit(mark))
    return found


def with_body_metrics(df: DataFrame, body: str, out: str = "metrics", clean: str = "clean_text") -> DataFrame:
    """Add the cleaned text and a struct of measures."""
    staged = df.withColumn(clean, T.clean_article_text(body)).withColumn("_lines", F.array_sort(T.lines(clean)))
    c, ls = F.col(clean), F.col("_lines")
    n = F.size(ls)
    linkish = F.size(F.filter(ls, _is_link_like))
    measures = F.struct(
        F.length(c).alias("text_length"),
        F.size(F.filter(ls, lambda x: F.length(x) >= 20)).alias("paragraph_count"),
        T.count_occurrences(c, ["。"]).alias("sentence_count"),
        T.count_occurrences(c, K.BODY_NAV_TERMS).alias("nav_keyword_hits"),
        ratio(_repeated_lines(ls), n, None).alias("duplicate_line_ratio"),
        ratio(linkish, n).alias("link_text_ratio"),
    )
    return staged.withColumn(out, T.fence(measures)).drop("_lines")


def is_navigation_text(m: Column) -> Column:
    """Strict gate over the metrics struct."""
    article_shape = (
        (m["text_length"] >= K.MIN_BODY_CHARS)
        & (m["sentence_count"] >= 3)
        & (m["paragraph_count"] >= 3)
        & (m["link_text_ratio"] <= 0.35)
    )
    listing = (
        (m["nav_keyword_hits"] >= 3)
        | (m["sentence_count"] <= 1)
        | (m["link_text_ratio"] >= 0.55)
        | (m["duplicate_line_ratio"] >= 0.35)
        | ((m["paragraph_count"] <= 2) & (m["text_length"] < 700))
    )
    return ~article_shape & listing


def is_navigation_body(body: Column | str) -> Column:
    """Scoring gate: such a body is not scored."""

    def listing(b: Column) -> Column:
        hits = T.count_occurrences(b, K.SCORING_NAV_TERMS)
        return (b != "") & ((hits >= 2) | ((T.count_occurrences(b, ["。"]) <= 1) & (F.length(b) > 150)))

    return T.let(T.strip(T.text(body)), listing)


def is_navigation_for_store(body: Column | str) -> Column:
    return T.count_occurrences(T.strip(T.text(body)), K.STORE_NAV_TERMS) >= 3


def is_index_title(title: Column | str) -> Column:
    return F.contains(T.text(title), F.lit("朝刊・夕刊"))


def looks_like_noise(body: Column | str) -> Column:
    b = T.text(body)
    short = (F.length(b) < K.MIN_BODY_CHARS) & (T.count_terms(b, K.PAGE_NOISE_MARKERS) >= 2)
    return (T.strip(b) == "") | short | b.rlike(K.LOGIN_PAIR_PATTERN)


def wall_hits(body: Column | str) -> Column:
    """First five markers of each kind found in the text."""
    return F.struct(
        F.slice(T.hits_of(body, K.LOGIN_MARKERS), 1, 5).alias("login"),
        F.slice(T.hits_of(body, K.PAID_MARKERS), 1, 5).alias("paid"),
        F.slice(T.hits_of(body, K.ACCESS_MARKERS), 1, 5).alias("access"),
    )


def with_title_match(df: DataFrame, source_title: str, page_title: str, out: str = "title_match") -> DataFrame:
    staged = df.withColumns(
        {"_src": T.title_match_norm(source_title), "_page": T.title_match_norm(page_title)}
    ).withColumn("_tokens", T.title_tokens(F.col("_src")))
    src, page, tokens = F.col("_src"), F.col("_page"), F.col("_tokens")
    hit = F.filter(tokens, lambda t: F.contains(page, t))
    partial = (src != "") & (page != "") & (F.contains(page, src) | F.contains(src, page))
    staged = staged.withColumn("_hit", hit)
    share = ratio(F.size("_hit"), F.size(tokens), None)
    result = F.struct(
        (partial | (F.size("_hit") >= 2) | (share >= 0.4)).alias("matched"),
        partial.alias("partial_match"),
        F.size(tokens).alias("source_token_count"),
        F.col("_hit").alias("matched_tokens"),
        F.size("_hit").alias("token_match_count"),
        F.round(share, 3).alias("token_match_ratio"),
    )
    return staged.withColumn(out, result).drop("_src", "_page", "_tokens", "_hit")


def with_headline_checks(df: DataFrame, title: str, body: str) -> DataFrame:
    """Add ``headline_aligned`` (title against the head of the text) and ``title_overlaps`` (against all of it)."""
    staged = df.withColumns(
        {
            "_t": T.title_match_norm(title),
            "_head": T.title_match_norm(F.left(T.text(body), F.lit(280))),
            "_body": T.title_match_norm(body),
        }
    ).withColumn("_tokens", T.title_tokens(F.col("_t")))
    t, head, whole, tokens = F.col("_t"), F.col("_head"), F.col("_body"), F.col("_tokens")
    in_head = F.size(F.filter(tokens, lambda k: F.contains(head, k)))
    in_body = F.size(F.filter(tokens, lambda k: F.contains(whole, k)))
    usable = (T.text(title) != "") & (T.text(body) != "")
    aligned = (
        usable
        & (t != "")
        & (head != "")
        & (F.contains(head, F.left(t, F.lit(20))) | F.contains(t, F.left(head, F.lit(20))) | (in_head >= 2))
    )
    overlaps = usable & (whole != "") & (F.size(tokens) > 0) & ((in_body >= 2) | (ratio(in_body, F.size(tokens), None) >= 0.4))
    return staged.withColumns({"headline_aligned": aligned, "title_overlaps": overlaps}).drop("_t", "_head", "_body", "_tokens")


def validate_body(
    df: DataFrame, body: str, source_title: str, page_title: str, url: str, article_path: str = "/paper/article/"
) -> DataFrame:
    """Add ``rejection_reason``: empty for an acceptable body."""
    staged = with_body_metrics(df, body)
    staged = with_title_match(staged, source_title, page_title)
    title = F.when(T.text(source_title) != "", F.col(source_title)).otherwise(F.col(page_title))
    staged = with_headline_checks(staged.withColumn("_title", title), "_title", "clean_text").drop("_title")
    m, match = F.col("metrics"), F.col("title_match")
    strong = (m["text_length"] >= K.MIN_BODY_CHARS) & (m["sentence_count"] >= 2) & (m["paragraph_count"] >= 2)
    likely = strong & (match["matched"] | F.col("headline_aligned") | F.col("title_overlaps"))
    is_article_url = F.contains(T.text(url), F.lit(article_path))
    reason = (
        F.when(F.col("clean_text") == "", F.lit("empty_text"))
        .when(is_index_title(page_title) & ~is_article_url & ~likely, F.lit("paper_index_page_title"))
        .when(is_navigation_text(m) & ~likely, F.lit("navigation_like_text"))
        .when(m["text_length"] < K.MIN_BODY_CHARS, F.lit("too_short"))
        .when(
            (T.text(source_title) != "") & (T.text(page_title) != "") & ~match["matched"] & (m["sentence_count"] < 3),
            F.lit("title_mismatch_with_low_quality"),
        )
        .otherwise(F.lit(""))
    )
    return staged.withColumn("rejection_reason", T.fence(reason))


def accept_body(body: Column, page_text: Column, title: Column, selector: Column, rejection: Column, excluded: Column) -> Column:
    """Final outcome: ``excluded:…``, ``failed:…``, ``success`` or ``success_short``."""
    b = T.text(body)
    too_short = F.length(b) < K.MIN_BODY_CHARS
    walls = wall_hits(F.concat(b, F.lit("\n"), T.text(page_text)))
    walled = (F.size(walls["login"]) + F.size(walls["paid"]) + F.size(walls["access"])) > 0
    reason = F.when(selector.isin(K.DISALLOWED_SELECTORS), F.lit("disallowed_selector")).otherwise(rejection)
    return (
        F.when(excluded != "", F.concat(F.lit("excluded:"), excluded))
        .when(reason != "", F.concat(F.lit("failed:"), reason))
        .when(too_short & looks_like_noise(b), F.lit("failed:noise_or_empty_body"))
        .when(too_short & ((F.length(b) < K.MIN_SHORT_BODY_CHARS) | walled), F.lit("failed:too_short"))
        .when(too_short, F.lit("success_short"))
        .otherwise(F.lit("success"))
    )


def empty_body_reason(body: Column, page_text: Column, login_like: Column, has_candidates: Column, blocked: Column) -> Column:
    text_chars, page_chars = F.length(T.strip(T.text(body))), F.length(T.strip(T.text(page_text)))
    return (
        F.when(login_like, F.lit("empty_body_login_like_text"))
        .when(~has_candidates, F.lit("empty_body_dom_missing"))
        .when((page_chars > 400) & (text_chars == 0), F.lit("empty_body_page_text_present_but_selector_failed"))
        .when(blocked & (page_chars < 80), F.lit("empty_body_resource_block_suspected"))
        .when(text_chars == 0, F.lit("empty_body_dom_missing"))
        .otherwise(F.lit("empty_body_unknown"))
    )
