"""First-n, top-k, ties and budgets.

Nothing here needs a whole group in one task: a constant ``n`` lets Spark cut every map task's output to ``n``
rows for each key before the shuffle; a per-group ``n`` is applied in two stages, first over salted parts of
each group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions import dates as D
from gleaner.session import cut_lineage

SALTS = 32
# Spark cuts map output for a rank filter up to this bound; larger or per-row limits use two stages.
MAP_SIDE_LIMIT = 1000


def _order(order: list[Column | str]) -> list[Column]:
    return [F.col(c).asc() if isinstance(c, str) else c for c in order]


def first_n(
    df: DataFrame, keys: list[str], order: list[Column | str], n: int | str, rank_column: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each key; ``n`` is a number or a column that is constant within a key.

    ``order`` must be total within a key.
    """
    by = _order(order)
    limit = F.lit(n) if isinstance(n, int) else F.col(n)
    if not isinstance(n, int) or n > MAP_SIDE_LIMIT:
        hashable = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[f"`{c}`" for c in hashable]), F.lit(SALTS)))
        part = Window.partitionBy(*keys, "_salt").orderBy(*by)
        df = salted.withColumn("_rank", F.row_number().over(part)).where(F.col("_rank") <= limit).drop("_rank", "_salt")
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by)))
    kept = ranked.where(F.col("_rank") <= limit)
    return kept.withColumnRenamed("_rank", rank_column) if rank_column else kept.drop("_rank")


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    return first_n(df, keys, order, 1)


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """A later row replaces an earlier one with the same key."""
    return first_n(df, keys, [F.col(order).desc()], 1)


def top_per_medium(
    df: DataFrame, medium: str = "medium", score: str = "score", published: str = "published", ord: str = "ord",
    n: int = K.TOP_PER_MEDIUM,
) -> DataFrame:
    """Scored articles first, then the rest; each part newest first by the minute, ties in feed order."""
    minute = D.minute_text(published)
    return first_n(df, [medium], [F.when(F.col(score) >= 1, 0).otherwise(1), minute.desc(), F.col(ord)], n)


def kth_value(df: DataFrame, value: str, k: int) -> Column:
    """The ``k``-th largest value as a scalar; the smallest when there are fewer rows."""
    top = df.select(F.col(value).alias("_v")).orderBy(F.col("_v").desc()).limit(k)
    return top.agg(F.min("_v").alias("_v")).scalar()


def with_ties(df: DataFrame, value: str, k: int, keys: list[str] | None = None) -> DataFrame:
    """Every row at least as large as the ``k``-th largest, overall or within each key.

    Ties may be many, so rows are compared with a cutoff instead of being ranked together. The rows are evaluated
    once and kept in the checkpoint folder: pass slim ones and join the rest to what is left.
    """
    df = cut_lineage(df)
    if not keys:
        return df.where(F.col(value) >= kth_value(df, value, k))
    slim = df.select(*keys, F.col(value).alias("_v"), F.monotonically_increasing_id().alias("_tie"))
    top = first_n(slim, keys, [F.col("_v").desc(), F.col("_tie")], k)
    cutoff = top.groupBy(*keys).agg(F.min("_v").alias("_cutoff"))
    return df.join(cutoff, keys).where(F.col(value) >= F.col("_cutoff")).drop("_cutoff")


def budget_across_groups(
    df: DataFrame, group: str, group_order: list[str], item_order: list[Column | str], budget: int | Column
) -> DataFrame:
    """Fill one overall budget group by group; later groups take what is left.

    Only the table of group sizes is ordered as a whole, and it has one row for each medium or site. The rows, which
    per-group limits have bounded, are evaluated once and kept in the checkpoint folder.
    """
    limit = F.lit(budget) if isinstance(budget, int) else budget
    df = cut_lineage(df)
    sizes = df.groupBy(group, *group_order).agg(F.count("*").alias("_n"))
    before = F.coalesce(
        F.sum("_n").over(Window.orderBy(*group_order, group).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    allowed = sizes.withColumn("_allowed", F.greatest(F.lit(0), F.least(F.col("_n"), limit - before)))
    allowed = allowed.where(F.col("_allowed") > 0).select(group, "_allowed")
    return first_n(df.join(allowed, group), [group], item_order, "_allowed").drop("_allowed")


def attempt_budget(
    df: DataFrame, run: str, order: list[Column | str], succeeded: str, max_successes: int, max_attempts: int = 0
) -> DataFrame:
    """Attempts a run makes before it stops: after ``max_attempts`` tries or ``max_successes`` successes."""
    if max_successes > 0 and max_attempts == 0:
        max_attempts = max(20, 5 * max_successes)
    if max_attempts == 0:
        return df
    tried = first_n(df, [run], order, max_attempts)
    if max_successes == 0:
        return tried
    earlier = Window.partitionBy(run).orderBy(*_order(order)).rowsBetween(Window.unboundedPreceding, -1)
    wins = F.coalesce(F.sum(F.col(succeeded).cast("int")).over(earlier), F.lit(0))
    return tried.withColumn("_wins", wins).where(F.col("_wins") < max_successes).drop("_wins")
