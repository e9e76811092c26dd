"""Working against the saved-article store: matching, overlays, upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions import dates as D
from gleaner.functions import urls as U
from gleaner.functions.text import strip, text
from gleaner.operators.ranking import keep_last


def split_existing(
    incoming: DataFrame, store: DataFrame, backfill: bool = True, skip_existing: bool = True, id_param: str = "ng"
) -> DataFrame:
    """Add ``page_id`` and ``outcome`` (new, backfill or skipped) to incoming rows with a ``url``.

    A row exists when its URL or its article key equals a stored URL or key: two equi-joins on slim key tables,
    since a join on "either" could not be hashed. Text is looked up by URL alone, so a row known only by its key
    counts as having none. What is known about a URL is put together on the store's side, so incoming rows move twice. Rows
    without a URL or key are new; they are spread over the partitions, not sent to one as equal keys.
    """
    keys = store.select(F.explode(F.array("url", U.article_key("url", id_param))).alias("_k")).where("_k <> ''").distinct()
    saved = keep_last(store.select("url", "page_id", "text", "ord"), ["url"], "ord").select(
        F.col("url").alias("_k"), F.col("page_id"), (strip(text("text")) != "").alias("_has_body")
    )
    by_url = keys.join(saved, "_k", "left").withColumnRenamed("_k", "_k1")
    by_key = keys.withColumnRenamed("_k", "_k2")
    plain = [f"`{c}`" for c, kind in incoming.dtypes if "map<" not in kind and "variant" not in kind]
    nowhere = F.concat(F.lit("\x00"), F.xxhash64(*plain).cast("string"))  # no stored key begins so
    probe = lambda c: F.coalesce(F.nullif(c, F.lit("")), nowhere)
    rows = incoming.withColumns({"_key": probe(U.article_key("url", id_param)), "_url": probe(F.col("url"))})
    joined = rows.join(by_url, F.col("_url") == F.col("_k1"), "left").join(by_key, F.col("_key") == F.col("_k2"), "left")
    exists = F.lit(skip_existing) & (F.col("_k1").isNotNull() | F.col("_k2").isNotNull())
    refetch = F.lit(backfill) & ~F.coalesce("_has_body", F.lit(False))
    outcome = F.when(~exists, F.lit("new")).when(refetch, F.lit("backfill")).otherwise(F.lit("skipped"))
    return joined.withColumn("outcome", outcome).drop("_key", "_url", "_k1", "_k2", "_has_body")


def store_index(store: DataFrame, id_param: str = "ng", wanted: DataFrame | None = None) -> DataFrame:
    """One row for each lookup key (URL, id, ``<param>:id``) in ``wanted``, or for all keys; later store rows win."""
    aid = U.query_param("url", id_param)
    keys = F.array(F.col("url"), aid, F.when(aid != "", F.concat(F.lit(f"{id_param}:"), aid)))
    exploded = store.select("page_id", "ord", F.explode(keys).alias("_k")).where("_k IS NOT NULL AND _k <> ''")
    if wanted is not None:
        exploded = exploded.join(wanted.select("_k").distinct(), "_k", "left_semi")
    return keep_last(exploded, ["_k"], "ord").select("_k", F.col("page_id").alias("_found"))


def resolve_page_id(incoming: DataFrame, store: DataFrame, key: str, id_param: str = "ng") -> DataFrame:
    """Fill ``page_id``: the row's own, else by URL, else by id, else by prefixed id.

    Only ``key`` and the lookup texts are shuffled; the rows themselves join once at the end.
    """
    aid = U.query_param("url", id_param)
    wanted = F.array(strip(text("url")), aid, F.when(aid != "", F.concat(F.lit(f"{id_param}:"), aid)))
    open_rows = incoming.where(text("page_id") == "").select(key, F.posexplode(wanted).alias("_p", "_k")).where("_k <> ''")
    hits = open_rows.join(store_index(store, id_param, open_rows), "_k")
    best = hits.groupBy(key).agg(F.min_by("_found", "_p").alias("_found"))
    return incoming.join(best, key, "left").withColumn(
        "page_id", F.coalesce(F.nullif(text("page_id"), F.lit("")), F.col("_found"), F.lit(""))
    ).drop("_found")


def score_update_lookup(scored: DataFrame, store: DataFrame) -> DataFrame:
    """Add ``target_page`` and ``lookup`` (own_id, url, or skipped) for writing scores back."""
    index = keep_last(store.where(strip(text("url")) != "").withColumn("_u", strip("url")), ["_u"], "ord").select(
        "_u", F.col("page_id").alias("_page")
    )
    url, own = strip(text("url")), strip(text("page_id"))
    joined = scored.join(index, url == F.col("_u"), "left")
    target = F.when(url == "", F.lit(None)).when(own != "", own).otherwise(F.col("_page"))
    how = (
        F.when((url == "") | ((own == "") & F.col("_page").isNull()), F.lit("skipped"))
        .when(own != "", F.lit("own_id"))
        .otherwise(F.lit("url"))
    )
    return joined.withColumns({"target_page": target, "lookup": how}).drop("_u", "_page")


def overlay_fields(articles: DataFrame, saved: DataFrame, fields: list[str], base: str, link: str = "page_url") -> DataFrame:
    """Saved fields replace the article's when its URL is known, even with empty text; then the link is completed."""
    right = keep_last(saved.where(strip(text("url")) != ""), ["url"], "ord").select(
        strip("url").alias("_u"), *[text(c).alias(f"_{c}") for c in fields]
    )
    joined = articles.join(right, strip(text("url")) == F.col("_u"), "left")
    known = F.col("_u").isNotNull()
    merged = joined.withColumns({c: F.when(known, F.col(f"_{c}")).otherwise(F.col(c)) for c in fields})
    return merged.withColumn(link, U.page_link(link, "page_id", base)).drop("_u", *[f"_{c}" for c in fields])


def inventory_to_scoring(inventory: DataFrame, fetched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to score from the store, rows fetched again for the store), from a run's inventory; ``ord`` stays where given."""
    src = F.col("existing")
    place = [c for c in ("ord",) if c in inventory.columns]
    title = F.coalesce(F.nullif(text(src["title"]), F.lit("")), F.col("title"))
    existing = inventory.where(F.col("status") == "existing_in_store").select(
        *place, title.alias("source_title"), title.alias("page_title"),
        F.coalesce(F.nullif(text(src["url"]), F.lit("")), F.col("url")).alias("url"),
        text(src["issue_date"]).alias("issue_date"), text(src["edition"]).alias("edition"), text(src["text"]).alias("text"),
        F.length(text(src["text"])).alias("text_length"), text(src["page_id"]).alias("page_id"),
        F.lit("store_existing").alias("source"),
    )
    again = inventory.where(F.col("status") == "backfilled_existing").select("url")
    return existing, again.join(fetched.select("url").distinct(), "url")


def date_range(rows: DataFrame, column: str, buffer_days: int = 1) -> tuple[Column, Column]:
    """First and last readable date of a batch, widened; scalars to prune a store partitioned by date."""
    day = D.normalize_issue_date(column).try_cast("date")
    low = rows.agg(F.date_sub(F.min(day), buffer_days).alias("d")).scalar()
    high = rows.agg(F.date_add(F.max(day), buffer_days).alias("d")).scalar()
    return low, high


def judge(store: DataFrame, incoming: DataFrame, key: str, id_param: str = "ng") -> DataFrame:
    """Add ``action`` (created, updated or failed) to incoming rows and fill ``page_id``.

    A new page's id depends only on its row, so a repeated run makes the same one.
    """
    resolved = resolve_page_id(incoming, store, key, id_param)
    failed = text("error") != ""
    known = F.col("page_id") != ""
    new_id = F.concat(F.lit("new-"), F.left(F.sha2(F.concat_ws("|", F.col(key).cast("string"), "url"), 256), F.lit(16)))
    return resolved.withColumn(
        "action", F.when(failed, F.lit("failed")).when(known, F.lit("updated")).otherwise(F.lit("created"))
    ).withColumn("page_id", F.when(known | failed, F.col("page_id")).otherwise(new_id))


def upsert(store: DataFrame, incoming: DataFrame, key: str, fields: list[str], id_param: str = "ng", order: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(new snapshot, outcome of each incoming row: created, updated or failed).

    The snapshot has all columns of ``store``; new pages have null where the row says nothing, and ``order`` as their ``ord``.

    ``incoming`` has ``url``, ``page_id``, ``error`` and the fields; rows with an error change nothing. Null fields
    leave the saved value as it is. When several rows update one page the last by ``key`` wins; new rows each
    make a page, with an id that depends only on the row.
    """
    judged = judge(store, incoming, key, id_param)
    outcome = judged.select(key, "url", "page_id", "action", (F.col("action") != "failed").alias("ok"), text("error").alias("error"))
    changes = judged.where(F.col("action") == "updated").select(
        "page_id", F.col(key).alias("_k"), *[F.col(f).alias(f"_{f}") for f in fields]
    )
    latest = keep_last(changes, ["page_id"], "_k").drop("_k")
    kept = store.join(latest, "page_id", "left").select(
        *[F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in store.columns]
    )
    ordered = [order.cast(store.schema["ord"].dataType).alias("ord")] if order is not None and "ord" in store.columns else []
    created = judged.where(F.col("action") == "created").select("page_id", "url", *fields, *ordered)
    return kept.unionByName(created, allowMissingColumns=True), outcome


def replace_blocks(
    blocks: DataFrame, chunks: DataFrame, titles: DataFrame, text_chars: int = K.TEXT_CHARS, max_blocks: int = K.MAX_BLOCKS
) -> DataFrame:
    """Block rows of updated pages: the old body section goes, new blocks follow what is left.

    ``blocks``: ``page_id, pos, kind, heading, content`` in page order; ``chunks``: ``page_id, pos, content``;
    ``titles``: ``page_id, title``. Pages without new text keep their blocks. A page gets at most ``max_blocks`` new
    blocks of ``text_chars`` characters, the destination's limits; ``blocks_cut`` tells what that leaves out.
    """
    updated = chunks.select("page_id").distinct()
    starts = blocks.where(F.col("heading").isin(K.BODY_START_HEADINGS)).groupBy("page_id").agg(F.min("pos").alias("_from"))
    stops = (
        blocks.where(F.col("heading").isin(K.BODY_STOP_HEADINGS))
        .join(starts, "page_id")
        .where("pos > _from")
        .groupBy("page_id")
        .agg(F.min("pos").alias("_to"))
    )
    ranges = starts.join(stops, "page_id", "left").join(updated, "page_id", "left_semi")
    inside = (F.col("pos") >= F.col("_from")) & (F.col("_to").isNull() | (F.col("pos") < F.col("_to")))
    kept = blocks.join(ranges, "page_id", "left").where(~F.coalesce(inside, F.lit(False))).select(
        "page_id", F.lit(0).alias("part"), "pos", "kind", "content"
    )

    def fixed(pos: int, kind: str, content: Column) -> Column:
        return F.struct(F.lit(pos).alias("pos"), F.lit(kind).alias("kind"), F.left(content, F.lit(text_chars)).alias("content"))

    heads = updated.join(titles, "page_id", "left").select(
        "page_id",
        F.explode(
            F.array_compact(
                F.array(
                    fixed(0, "heading_2", F.lit(K.TITLE_HEADING)),
                    F.when(text("title") != "", fixed(1, "heading_3", F.col("title"))),
                    fixed(2, "heading_2", F.lit(K.BODY_HEADING)),
                )
            )
        ).alias("b"),
    )
    lead = heads.groupBy("page_id").agg(F.count("*").alias("_lead"))
    heads = heads.select("page_id", F.lit(1).alias("part"), F.col("b.pos").alias("pos"), "b.kind", "b.content")
    body = chunks.join(lead, "page_id").where(F.col("pos") + F.col("_lead") < max_blocks).select(
        "page_id", F.lit(2).alias("part"), "pos", F.lit("paragraph").alias("kind"),
        F.left("content", F.lit(text_chars)).alias("content"),
    )
    return kept.unionByName(heads).unionByName(body)


def blocks_cut(
    chunks: DataFrame, titles: DataFrame, text_chars: int = K.TEXT_CHARS, max_blocks: int = K.MAX_BLOCKS
) -> DataFrame:
    """Of each updated page that loses something to ``replace_blocks``: chunks left out, and characters cut off others."""
    named = titles.where(text("title") != "").select("page_id", F.lit(1).alias("_named")).distinct()
    lead = F.lit(2) + F.coalesce("_named", F.lit(0))
    out = F.col("pos") + lead >= max_blocks
    over = F.greatest(F.lit(0), F.length(text("content")) - text_chars)
    sums = chunks.join(named, "page_id", "left").groupBy("page_id").agg(
        F.count_if(out).alias("chunks_left_out"), F.coalesce(F.sum(F.when(~out, over)), F.lit(0).cast("bigint")).alias("chars_cut")
    )
    return sums.where("chunks_left_out > 0 OR chars_cut > 0")
