"""Connected components of an edge table, as alternating star steps on grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node next to it."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them. Edges have ``u > v``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v of one orderable type) to ``(u, root)`` for each node but the smallest of its component.

    Each round is two map-side combined minima and two joins against tables with one row a node, so a node
    with very many neighbours is a skewed join side that adaptive execution splits. Every round ends in a table
    in the shared folder. It stops when a round changes nothing; rounds grow with the logarithm of the
    component size.
    """
    state = lambda df: df.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(pmod(xxhash64(v, u), 1000003) as decimal(38, 0)))")).first()
    now = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    seen = state(now)
    while seen[0]:
        now = staged(_small_star(_large_star(now)), "edges")
        if (after := state(now)) == seen:
            break
        seen = after
    return now.select("u", F.col("v").alias("root"))
