"""General feeds: the newest entries of each feed, filtered, deduplicated, scored and ranked.

Two shuffles carry rows: the position within each feed and the medium's keys and top list; both are cut map-side.
Bodies are scored before the first shuffle that needs only keys, so no text travels further than it must.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions import dates as D
from gleaner.functions import text as T
from gleaner.functions import urls as U
from gleaner.operators import dedupe, filters, lookup, ranking, rules, windows
from gleaner.session import cut_lineage

ENTRY_ORDER = ["feed_ord", "entry_ord"]


def build(
    entries: DataFrame, as_of: Column, noise_medium: str = "", entries_per_feed: int = K.ENTRIES_PER_FEED,
    top: int = K.TOP_PER_MEDIUM,
) -> DataFrame:
    """Rows of the digest, best first.

    ``entries``: ``medium, feed, feed_ord, entry_ord, title, summary, link, published_parsed, updated_parsed`` (UTC).
    """
    scanned = ranking.first_n(entries, ["medium", "feed"], ["entry_ord"], entries_per_feed)
    shaped = scanned.select(
        "medium", *ENTRY_ORDER,
        T.strip_tags(T.text("title")).alias("title"),
        T.strip_tags(T.text("summary")).alias("summary"),
        U.normalize_link("link").alias("link"),
        D.entry_datetime_utc(F.col("published_parsed"), F.col("updated_parsed")).alias("published_utc"),
    )
    recent = shaped.where(F.col("published_utc").isNotNull() & windows.since(F.col("published_utc"), as_of))
    clean = recent.where(filters.keep_after_noise(F.col("medium"), noise_medium, F.col("title"), F.col("summary")))
    unique = dedupe.by_url_and_title(clean, "medium", "title", "link", list(ENTRY_ORDER))
    scored = rules.with_bucket_score(unique, F.concat("title", "summary")).drop("summary")
    local = scored.withColumn("published", D.label(D.to_zone("published_utc", K.HOME_TZ)))
    first = F.when(F.col("score") >= 1, 0).otherwise(1)
    best = ranking.first_n(local, ["medium"], [first, F.col("published").desc(), *map(F.col, ENTRY_ORDER)], top)
    return best.orderBy(F.col("score").desc(), F.col("published").desc(), "medium", *ENTRY_ORDER).select(
        "medium", "title", "score", "published", "link"
    )


def translated(digest: DataFrame, cache: DataFrame, responses: DataFrame, media: list[str] | None = None) -> DataFrame:
    """Add ``title_ja``: for titles of the media that are translated and hold no Japanese the cached translation, else a valid
    response; every other title stays as it is. The digest, at most ``top`` rows a medium, is computed once."""
    held = cut_lineage(digest)
    answered = lookup.translate_titles(held, cache, responses, "title", F.struct("published", "link"))
    asked = filters.needs_translation(F.col("medium"), F.col("title"), media)
    return answered.withColumn("title_ja", F.when(asked, F.col("title_ja")).otherwise(F.col("title")))
