"""The digest: sections of selected items, report input and fallback sections.

Sections and the fingerprint run on rows whose number the top-k and budget steps bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions import dates as D
from gleaner.functions import text as T
from gleaner.operators.numbering import with_position


def sections(items: DataFrame, section_list: DataFrame | None, section: str, order: str, fields: list[str]) -> DataFrame:
    """One row for each section with its count and its items in order; listed sections stay when empty."""
    packed = items.groupBy(section).agg(
        F.count("*").alias("item_count"),
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("_at"), *fields))).alias("_items"),
    )
    shaped = packed.select(
        section, "item_count", F.transform("_items", lambda i: F.struct(*[i[f].alias(f) for f in fields])).alias("items")
    )
    if section_list is None:
        return shaped
    return section_list.join(shaped, section, "left").withColumn("item_count", F.coalesce("item_count", F.lit(0).cast("bigint")))


def report_input(selected: DataFrame, order: list[Column], text_columns: list[str], chars: int = K.CHUNK_CHARS) -> DataFrame:
    """Reference ids in selection order, which must be total, and a clipped excerpt of the first non-blank text.

    Places come from sorted ranges, so a selection by threshold or with ties may be of any size.
    """
    body = T.first_present(*text_columns)
    numbered = with_position(selected, order).withColumn("position", (F.col("position") + 1).cast("int"))
    return numbered.withColumns(
        {
            "ref_id": F.concat(F.lit("A"), F.col("position").cast("string")),
            "text_excerpt": F.left(body, F.lit(chars)) if chars > 0 else F.lit(""),
        }
    )


def fallback_sections(df: DataFrame) -> DataFrame:
    """Sections written from whatever an article has: ``summary``, ``reason_to_read``, ``business_implications``
    and ``text_excerpt``."""
    summary, excerpt = T.presence("summary"), T.presence("text_excerpt")
    reason, action = T.presence("reason_to_read"), T.presence("business_implications")
    fact = F.coalesce(summary, excerpt, F.lit(K.SECTION_DEFAULT_FACT))
    implication = F.coalesce(reason, action, F.lit(K.SECTION_DEFAULT_IMPLICATION))
    outlook = F.coalesce(action, reason, F.lit(K.SECTION_DEFAULT_OUTLOOK))
    return df.withColumns(
        {
            "what_happened": fact,
            "one_line_summary": F.coalesce(summary, F.left(excerpt, F.lit(160)), F.lit(K.SECTION_DEFAULT_SUMMARY)),
            "why_it_matters": F.coalesce(reason, F.lit(K.SECTION_DEFAULT_WHY)),
            "watch_points": F.slice(F.array_compact(F.array(action, reason)), 1, 2),
            "business_action_hint": F.coalesce(action, F.lit(K.SECTION_DEFAULT_ACTION)),
            "summary_and_implications": F.concat(fact, F.lit(" "), implication, F.lit("\n\n"), outlook),
        }
    )


def report_date(selected: DataFrame, everything: DataFrame, date: str, order: list[str], fallback: Column) -> DataFrame:
    """One row: date of the first selected article that has one, else of the first article, else the fallback."""

    def first(df: DataFrame) -> Column:
        dated = df.where(T.text(date) != "")
        return dated.agg(F.min_by(date, F.struct(*order)).alias("d")).scalar()

    chosen = F.coalesce(first(selected), first(everything), fallback)
    one = everything.sparkSession.range(1)
    return one.select(D.display_date(chosen).alias("report_date"))


def headline(c: Column | str, index: Column) -> Column:
    """First clause of 4 to 24 characters, else the first 22 characters."""
    cleaned = T.strip(T.squeeze(T.text(c)))

    def pick(t: Column) -> Column:
        heads = []
        for sep in K.HEADLINE_SEPARATORS:
            head = T.strip(F.substring_index(t, sep, 1))
            heads.append(F.when(F.contains(t, F.lit(sep)) & F.length(head).between(4, 24), head))
        clipped = F.concat(F.left(t, F.lit(22)), F.when(F.length(t) > 22, F.lit("...")).otherwise(F.lit("")))
        return F.coalesce(*heads, clipped)

    return F.when(cleaned == "", F.concat(F.lit(K.HEADLINE_PREFIX), index.cast("string"))).otherwise(T.let(cleaned, pick))


def fingerprint(selected: DataFrame, order: list[str], fields: list[str], run_date: Column) -> DataFrame:
    """SHA-256 over the run's date and its selected rows in order; changes when the report would."""
    row = F.struct(*order, *[T.text(f).alias(f"f_{f}") for f in fields])
    packed = selected.agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    lines = F.transform("_rows", lambda r: F.concat_ws("\x1f", *[r[f"f_{f}"] for f in fields]))
    return packed.select(F.sha2(F.concat(run_date, F.lit("\x1e"), F.array_join(lines, "\x1e")), 256).alias("fingerprint"))


def tree_fingerprint(rows: DataFrame, order: list[str], fields: list[str], run_date: Column, fan_out: int = 1024, levels: int = 3) -> DataFrame:
    """SHA-256 over the run's date and rows of any number in ``order``, which must be total.

    Each row's fields are hashed, then ``levels`` times the hashes of ``fan_out`` neighbours together, so a group holds
    ``fan_out`` hashes and the last step one for each ``fan_out ** levels`` rows. The shape depends on the places alone:
    runs with equal rows have equal fingerprints however they are partitioned. No rows: the hash of the date.
    """
    line = F.concat_ws("\x1f", *[T.text(f) for f in fields])
    hashed = with_position(rows.select(*[c for c in order if c not in fields], *fields).select(*order, F.sha2(line, 256).alias("_hash")), order)
    level = hashed.select("position", "_hash")
    together = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "_hash"))), lambda h: h["_hash"]), "\x1e"), 256)
    for _ in range(levels):
        level = level.groupBy(F.floor(F.col("position") / fan_out).alias("_up")).agg(together.alias("_hash")).select(F.col("_up").alias("position"), "_hash")
    top = level.agg(F.array_sort(F.collect_list(F.struct("position", "_hash"))).alias("_rows"))
    return top.select(F.sha2(F.concat_ws("\x1e", run_date, F.transform("_rows", lambda h: h["_hash"])), 256).alias("fingerprint"))
