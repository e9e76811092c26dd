"""Removing repeats. "First" always means lowest order column, never file order."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import text as T
from gleaner.functions import urls as U
from gleaner.operators.ranking import keep_first
from gleaner.session import cut_lineage


def by_url_and_title(df: DataFrame, medium: str, title: str, link: str, order: list[Column | str]) -> DataFrame:
    """First row of each (medium, URL key and title key)."""
    keyed = df.withColumn("_key", U.dedupe_key(title, link))
    return keep_first(keyed, [medium, "_key"], order).drop("_key")


def by_title(df: DataFrame, medium: str, title: str, order: list[Column | str]) -> DataFrame:
    """First row of each (medium, title key); rows without a usable title are dropped."""
    keyed = df.withColumn("_key", T.normalize_title(T.text(title))).where(F.col("_key") != "")
    return keep_first(keyed, [medium, "_key"], order).drop("_key")


def candidates(df: DataFrame, page: list[str], url: str, title: str, order: list[Column | str]) -> DataFrame:
    """First link of each comparable URL on a page, then those without a title are dropped.

    An untitled first link therefore hides later titled ones.
    """
    keyed = df.withColumn("_key", U.normalize_url(url))
    return keep_first(keyed, [*page, "_key"], order).where(T.text(title) != "").drop("_key")


def accepted(df: DataFrame, site: str, url: str, is_accepted: Column, order: list[Column | str]) -> DataFrame:
    """First accepted row of each comparable URL in a site; rejected rows do not block later ones."""
    keyed = df.where(is_accepted).withColumn("_key", U.normalize_url(url))
    return keep_first(keyed, [site, "_key"], order).drop("_key")


def best_body(df: DataFrame, url: str, body: str, source: str, order: str, existing: str, id_param: str = "ng") -> DataFrame:
    """One row for each article: new text beats saved text beats none; ``first_seen`` keeps the id's first place."""
    aid = U.article_id(url, id_param)
    has_body = T.strip(T.text(body)) != ""
    rank = F.when(has_body & (T.text(source) != existing), 2).when(has_body, 1).otherwise(0)
    keyed = df.withColumns(
        {"article_id": aid, "_key": F.when(aid != "", aid).otherwise(F.col(url)), "_rank": rank}
    )
    best = keep_first(keyed, ["_key"], [F.col("_rank").desc(), F.col(order)])
    firsts = keyed.groupBy("_key").agg(F.min(order).alias("first_seen"))
    return best.join(firsts, "_key").drop("_key", "_rank")


#: Open rows that one task settles in order; with more, rounds over all of them come first.
FOLD_ROWS = 1_000_000


def greedy_by_either_key(df: DataFrame, first_key: str, second_key: str, order: str, fold_rows: int = FOLD_ROWS) -> DataFrame:
    """Keep a row unless one of its keys belongs to a row kept earlier; dropped rows block nothing.

    Only the keys and the order travel. Repeats of a key pair go in a map-side aggregate first, since only the first of a pair can be
    kept. While more than ``fold_rows`` rows are open, rounds keep the rows that come first under both their keys, then drop the
    open rows that share a key with a kept one; the least order of each key is staged before it is joined, so that the rows of a hot key
    meet one row of a plain table and can be split. What is left, at most ``fold_rows`` slim rows however long their chain of
    conflicts, is settled by one task in order.
    """
    a, b, o = first_key, second_key, order
    open_rows = cut_lineage(df.groupBy(a, b).agg(F.min(o).alias(o)))
    kept: list[DataFrame] = []
    while (left := open_rows.count()) > fold_rows:
        by_a = cut_lineage(open_rows.groupBy(a).agg(F.min(o).alias("_a")))
        by_b = cut_lineage(open_rows.groupBy(b).agg(F.min(o).alias("_b")))
        judged = open_rows.join(by_a, a).join(by_b, b)
        won = cut_lineage(judged.where((F.col(o) == F.col("_a")) & (F.col(o) == F.col("_b"))).select(a, b, o))
        kept.append(won.select(o))
        open_rows = cut_lineage(
            open_rows.join(won.select(a), a, "left_anti").join(won.select(b), b, "left_anti").select(a, b, o)
        )
    if left:
        kept.append(_in_order(open_rows, a, b, o))
    if not kept:
        return df
    return df.join(reduce(DataFrame.union, kept), o, "left_semi")


def _in_order(rows: DataFrame, a: str, b: str, o: str) -> DataFrame:
    """The order values of the rows that a walk in order keeps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used: tuple[set, set] = (set(), set())
        for batch in batches:
            at = []
            for i, pair in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if pair[0] not in used[0] and pair[1] not in used[1]:
                    at.append(i)
                    for keys, key in zip(used, pair, strict=True):
                        keys.add(key)
            yield batch.select([0]).take(pa.array(at, pa.int64()))

    slim = rows.select(o, a, b).repartition(1).sortWithinPartitions(o)
    return slim.mapInArrow(run, slim.select(o).schema)


def repeated_share(total: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: rows seen, kept and removed."""
    seen = total.agg(F.count("*").alias("seen"))
    left = kept.agg(F.count("*").alias("kept")).scalar()
    return seen.withColumn("kept", left).withColumn("removed", F.col("seen") - F.col("kept"))
