"""Row predicates and reason labels. All are expressions: they run map-only and keep the scan's partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions import text as T


def title_filter_reason(title: Column, include: Column, exclude: Column) -> Column:
    inc, exc = T.text(include), T.text(exclude)
    return (
        F.when((inc != "") & ~F.rlike(title, inc), F.lit("include_pattern_not_matched"))
        .when((exc != "") & F.rlike(title, exc), F.lit("exclude_pattern_matched"))
        .otherwise(F.lit("accepted"))
    )


def url_pattern(pattern: Column) -> Column:
    """Patterns may be written over several lines: blanks are dropped."""
    return F.regexp_replace(T.text(pattern), K.WS + "+", "")


def passes_url_pattern(absolute: Column, href: Column, pattern: Column) -> Column:
    p = url_pattern(pattern)
    return (p == "") | F.rlike(absolute, p) | F.rlike(href, p)


def is_noise(title: Column, summary: Column) -> Column:
    return T.contains_any(F.concat_ws("\n", title, summary), K.NOISE_TERMS)


def keep_after_noise(medium: Column, filtered_medium: str, title: Column, summary: Column) -> Column:
    """Only one medium is checked for noise."""
    return (medium != filtered_medium) | ~is_noise(title, summary)


def pre_exclude_reason(
    title: Column, title_regex: str = "", extra_regex: str = "", enabled: bool = True, hr: bool = True, short: bool = True
) -> Column:
    t = T.text(title)
    out = F.when(F.lit(False), F.lit(""))
    if title_regex:
        out = out.when(t.rlike(title_regex), F.lit("title_regex"))
    if enabled:
        patterns = [T.java_pattern(p) for p in K.PRE_TITLE_PATTERNS] + ([extra_regex] if extra_regex else [])
        out = out.when(t.rlike("|".join(patterns)), F.lit("pre_title_regex"))
        if hr:
            people = "|".join(T.java_pattern(p) for p in K.HR_TITLE_PATTERNS)
            out = out.when(t.rlike(people), F.lit("pre_hr_like_title"))
        if short:
            out = out.when(F.length(t) <= K.SHORT_TITLE_CHARS, F.lit("pre_short_title"))
    return out.otherwise(F.lit(""))


def exclude_topics(full: Column) -> Column:
    """Names of off-topic subjects found, sorted and joined; empty when none."""

    def topics(f: Column) -> Column:
        named = [F.when(T.contains_any(f, terms), F.lit(name)) for name, terms in K.EXCLUDE_TOPICS.items()]
        return F.array_join(F.array_sort(F.array_compact(F.array(*named))), "、")

    return T.let(
        T.let(full, topics),
        lambda r: F.when(r == K.ONLY_PERSONNEL_TOPIC, F.lit(K.ONLY_PERSONNEL_REASON)).otherwise(r),
    )


def exclude_by_body_reason(title: Column, body: Column) -> Column:
    t, b = T.text(title), T.text(body)
    short_notice = (
        t.rlike(T.java_pattern(K.HR_TITLE_PATTERNS[0]))
        & T.contains_any(b, K.HR_BODY_WORDS)
        & (F.length(b) < 600)
        & ~T.contains_any(b, K.BUSINESS_WORDS)
    )
    return (
        F.when(F.contains(b, F.lit(K.HR_BODY_MARKER)), F.lit("hr_article_marker"))
        .when(short_notice, F.lit("hr_short_executive_article"))
        .otherwise(F.lit(""))
    )


def needs_translation(medium: Column, title: Column, media: list[str] | None = None) -> Column:
    return medium.isin(media or K.TRANSLATED_MEDIA) & ~T.is_japanese(title)


def enrichment_skip_reason(
    processed: Column, score: Column, body: Column, force: bool = False, min_score: float = 3.0
) -> Column:
    """Why an article is not enriched; null when it is."""
    value = F.coalesce(score.try_cast("double"), F.lit(0.0))
    done = F.lit(False) if force else F.coalesce(processed, F.lit(False))
    return (
        F.when(done, F.lit("already_processed"))
        .when(value <= min_score, F.lit(f"importance_score_lte_{min_score:g}"))
        .when(F.length(T.strip(T.text(body))) < K.MIN_BODY_CHARS, F.lit("missing_or_short_text"))
    )


def detected_editions(body: Column, issue_date: Column) -> Column:
    """Edition ids of the issue's date named in the text, first seen order."""
    ids = F.regexp_extract_all(T.text(body), F.lit(r"(?i)editionID=([0-9]{8}[ME][0-9A-Za-z]+)"), F.lit(1))
    return F.array_distinct(F.filter(ids, lambda i: (issue_date != "") & i.startswith(issue_date)))


def edition_check(expected_edition: Column, ids: Column) -> tuple[Column, Column, Column]:
    """(first detected id, expected marker, ok or edition_mismatch)."""
    name = F.lower(T.strip(T.text(expected_edition)))
    marker = F.when(F.lit(False), F.lit(""))
    for edition, m in K.EDITION_MARKERS.items():
        marker = marker.when(name == edition, F.lit(m))
    marker = marker.otherwise(F.lit(""))
    first = F.coalesce(F.try_element_at(ids, F.lit(1)), F.lit(""))
    found = F.substring(first, 9, 1)
    mismatch = (marker != "") & (found != "") & (marker != found)
    return first, marker, F.when(mismatch, F.lit("edition_mismatch")).otherwise(F.lit("ok"))


def run_outcome(targets: Column, succeeded: Column, existing_skips: Column, allow_empty: Column) -> Column:
    return (
        F.when(targets == 0, F.lit("skip_no_targets"))
        .when((succeeded > 0) | (existing_skips > 0) | allow_empty, F.lit("continue"))
        .otherwise(F.lit("fail"))
    )


def systemic_failure(
    targets: Column, succeeded: Column, failed: Column, empty: Column, login: Column, access: Column, paid: Column
) -> Column:
    """Common cause when every failure is an empty body; null otherwise."""
    all_empty = (targets > 0) & (succeeded == 0) & (empty == failed)
    some = failed > 0
    return F.when(
        all_empty,
        F.when((login == failed) & some, F.lit("login_state_invalid"))
        .when((access == failed) & some, F.lit("resource_block_side_effect"))
        .when((paid == failed) & some, F.lit("selector_mismatch"))
        .otherwise(F.lit("article_dom_changed")),
    )


def rule_enabled(enabled: Column, rule_type: Column, wanted: list[str]) -> Column:
    kind = F.lower(T.strip(T.text(rule_type)))
    typed = F.lit(True) if not wanted else (kind == "") | kind.isin(wanted)
    return (F.lower(T.text(enabled)) == "true") & typed
