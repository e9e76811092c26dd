"""Publication time of each entry by its medium's rule, with a fallback source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import dates as D
from gleaner.functions import html as H
from gleaner.functions import urls as U
from gleaner.functions.text import fence, let, strip, text


def _candidate(kind: Column, selector: Column) -> Column:
    """What one source offers: a direct time or a text to match, with its source label or a failure reason."""

    def offer(source: Column | str, found: Column, reason: Column | str, direct: bool = False) -> Column:
        src = F.lit(source) if isinstance(source, str) else source
        why = F.lit(reason) if isinstance(reason, str) else reason
        return let(
            F.nullif(found, F.lit("")),
            lambda f: F.struct(
                F.when(f.isNotNull(), src).alias("source"),
                f.alias("text"),
                F.when(f.isNull(), why).alias("reason"),
                F.lit(direct).alias("direct"),
            ),
        )

    def failed(reason: Column | str) -> Column:
        return offer("none", F.lit(None).cast("string"), reason)

    first_meta = F.try_element_at(F.col("_meta_any"), F.lit(1))
    chosen = F.when(F.col("sel_attr") != "", F.col("sel_attr")).otherwise(F.col("sel_text"))
    no_selector = F.when(selector != "", F.concat(F.lit("selector not found: "), selector)).otherwise(F.lit("selector empty"))
    article = (
        F.when((selector != "") & F.col("sel_found"), offer("article_html(selector)", chosen, "selector value is empty"))
        .when(
            F.col("ld_date") != "",
            offer("article_html(json_ld_newsarticle)", F.col("ld_date"), "", direct=True),
        )
        .when(first_meta.isNotNull(), offer("article_html(meta)", first_meta, "meta content not found"))
        .when(F.col("html") != "", failed(no_selector))
        .otherwise(failed("article html empty"))
    )
    return (
        F.when(kind == "url", offer("url", F.col("_urls"), "url not found"))
        .when(kind == "article_html", article)
        .when(
            kind == "meta", offer("meta", F.try_element_at(H.meta_dates("html", selector), F.lit(1)), "meta content not found")
        )
        .when(
            kind == "json_ld",
            offer("json_ld", F.array_join(H.ld_json_blocks("html", selector), "\n"), "json_ld block not found"),
        )
        .otherwise(failed("unsupported source type"))
    )


def _attempt(a: Column, selector: Column) -> Column:
    """Outcome of one ``(kind, pattern)``: the pattern picks the date text, except for direct times."""
    kind, pattern = a["kind"], a["pattern"]
    tz = F.col("date_timezone")
    groups = F.regexp_count(pattern, F.lit(r"(?<!\\)\((?!\?)"))
    dotall = F.concat(F.lit("(?s)"), pattern)

    def outcome(cand: Column) -> Column:
        first = F.call_function("regexp_extract", cand["text"], dotall, F.lit(0))
        three = F.concat_ws("-", *[F.call_function("regexp_extract", cand["text"], dotall, F.lit(g)) for g in (1, 2, 3)])
        matched = F.when(
            pattern != "",
            let(first, lambda m: F.when(m != "", F.when((kind == "url") & (groups >= 3), three).otherwise(strip(m)))),
        )
        granularity = F.when(cand["direct"], F.lit("datetime")).otherwise(F.col("date_granularity"))
        return let(
            let(
                F.when(cand["direct"], cand["text"]).otherwise(matched),
                lambda m: F.struct(m.alias("text"), D.parse_flexible_utc(m, tz, granularity).alias("utc")),
            ),
            lambda d: F.struct(
                d["utc"].alias("utc"),
                cand["source"].alias("source"),
                D.day_text(D.to_zone(d["utc"], tz)).alias("day"),
                F.when(cand["reason"].isNotNull(), cand["reason"])
                .when(~cand["direct"] & (pattern == ""), F.lit("date parse pattern is empty"))
                .when(d["text"].isNull(), F.lit("date text not matched by pattern"))
                .when(d["utc"].isNull(), F.concat(F.lit("unparseable datetime text: "), d["text"]))
                .alias("reason"),
            ),
        )

    rss = F.struct(
        F.col("_rss_utc").alias("utc"),
        F.col("_rss_source").alias("source"),
        F.lit(None).cast("string").alias("day"),
        F.when(F.col("_rss_utc").isNull(), F.lit("rss datetime not found")).alias("reason"),
    )
    return F.when(kind == "rss", rss).otherwise(let(_candidate(kind, selector), outcome))


def extract_datetime_by_rule(df: DataFrame) -> DataFrame:
    """Add ``published_utc``, ``adopted_source``, ``parsed_date`` and ``failure_reason``.

    Expects the entry (``link``, ``published_parsed``, ``updated_parsed``, ``published``, ``updated``), its page
    (``final_url``, ``canonical_url``, ``html``, ``ld_date``, ``sel_found``, ``sel_attr``, ``sel_text``; blank when
    not captured) and the nine rule columns. Patterns are Java regular expressions. The work is one map-only
    projection; page columns are dropped from the result.
    """
    kept = [
        c for c in df.columns
        if c not in ("html", "final_url", "canonical_url", "ld_date", "sel_found", "sel_attr", "sel_text")
    ]
    rss_utc, rss_source = D.ranked_entry_datetime(
        F.col("published_parsed"), F.col("updated_parsed"), F.col("published"), F.col("updated")
    )
    selector = strip(text("date_css_selector"))
    url_lines = [F.nullif(text(c), F.lit("")) for c in ("final_url", "canonical_url")]
    source_url = F.nullif(U.normalize_link("link"), F.lit(""))
    filled = df.withColumns(
        {
            "html": text("html"),
            "sel_found": F.coalesce(F.col("sel_found"), F.lit(False)),
            "sel_attr": strip(text("sel_attr")),
            "sel_text": strip(text("sel_text")),
            "ld_date": strip(text("ld_date")),
            "_rss_utc": rss_utc,
            "_rss_source": rss_source,
            "_urls": F.concat_ws("\n", F.coalesce(url_lines[0], source_url), url_lines[1], source_url),
            "_meta_any": F.when(
                F.array_contains(F.array("date_source_type", "fallback_date_source_type"), "article_html"),
                H.meta_dates("html"),
            ),
        }
    )
    own, other = text("date_parse_pattern"), text("fallback_date_parse_pattern")
    pairs = F.array(
        F.struct(F.col("date_source_type").alias("kind"), own.alias("pattern")),
        F.struct(F.col("fallback_date_source_type").alias("kind"), F.when(other != "", other).otherwise(own).alias("pattern")),
    )
    resolved = filled.select(*kept, fence(F.transform(pairs, lambda a: _attempt(a, selector))).alias("_tries"))
    first, second = F.col("_tries")[0], F.col("_tries")[1]
    has_fallback = text("fallback_date_source_type") != ""
    first_ok, second_ok = first["utc"].isNotNull(), has_fallback & second["utc"].isNotNull()

    def adopted(field: str) -> Column:
        return F.when(first_ok, first[field]).when(second_ok, second[field])

    return resolved.select(
        *kept,
        adopted("utc").alias("published_utc"),
        adopted("source").alias("adopted_source"),
        adopted("day").alias("parsed_date"),
        F.when(first_ok | second_ok, F.lit(None).cast("string"))
        .when(has_fallback, F.concat(F.lit("primary="), first["reason"], F.lit("; fallback="), second["reason"]))
        .otherwise(first["reason"])
        .alias("failure_reason"),
    )
