"""Positions in a total order, without passing all rows through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.session import cut_lineage

_ROW_BITS = 33


def with_position(df: DataFrame, order: list[Column | str], out: str = "position") -> DataFrame:
    """Add the 0-based position of each row in ``order``, which must be total.

    Rows are range-partitioned and sorted once and kept in the checkpoint folder, so the second pass sees the
    same partitions. Only one count for each partition is added up; that table is broadcast, its size being the
    number of partitions.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fixed = cut_lineage(df.repartitionByRange(parts, *order).sortWithinPartitions(*order))
    row_id = F.monotonically_increasing_id()
    placed = fixed.withColumn("_pos_row", row_id)
    placed = placed.withColumns(
        {"_pos_part": F.shiftright("_pos_row", _ROW_BITS), "_pos_at": F.col("_pos_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}
    )
    sizes = placed.groupBy("_pos_part").agg(F.count("*").alias("_pos_n"))
    running = Window.orderBy("_pos_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_pos_part", F.coalesce(F.sum("_pos_n").over(running), F.lit(0)).alias("_pos_start"))
    return (
        placed.join(F.broadcast(starts), "_pos_part")
        .withColumn(out, F.col("_pos_start") + F.col("_pos_at"))
        .drop("_pos_part", "_pos_row", "_pos_at", "_pos_start")
    )


def with_batch(df: DataFrame, key: str, order: str, size: int, out: str = "batch") -> DataFrame:
    """One row for each distinct key in first-seen order, numbered in batches of ``size``."""
    firsts = df.groupBy(key).agg(F.min(order).alias("first_seen"))
    placed = with_position(firsts, ["first_seen", key], "_position")
    return placed.select(key, "first_seen", F.floor(F.col("_position") / size).cast("bigint").alias(out))
