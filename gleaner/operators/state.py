"""Memory of processed keys between runs, as a table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleaner.operators.ranking import keep_first
from gleaner.sources.folders import delete, finished


def unseen(rows: DataFrame, state: DataFrame | None, key: str, order: str, force_refresh: bool = False) -> DataFrame:
    """First row of each key that no earlier run processed; a forced run looks at every key again."""
    firsts = keep_first(rows, [key], [order])
    if state is None or force_refresh:
        return firsts
    return firsts.join(state.select(key).distinct(), key, "left_anti")


def remember(state: DataFrame | None, rows: DataFrame, key: str, order: str) -> DataFrame:
    """State after a run: known keys keep their payload, new keys take that of their first row."""
    added = keep_first(rows, [key], [order])
    if state is None:
        return added
    return state.unionByName(added.join(state.select(key), key, "left_anti"), allowMissingColumns=True)


@dataclass(frozen=True)
class SeenKeys:
    """A growing set of keys in ``folder``: one base and a segment for each batch since.

    ``schema`` is that of the key column. After ``every`` segments they and the base become a new base.
    """

    spark: SparkSession
    folder: str
    schema: StructType
    every: int = 16

    def known(self, at: int) -> DataFrame:
        """Keys of the batches up to ``at``."""
        base = max((b for b in finished(self.spark, f"{self.folder}/base") if b <= at), default=None)
        paths = [] if base is None else [f"{self.folder}/base/at={base}"]
        paths += [f"{self.folder}/new/at={b}" for b in self._since(base, at)]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def unseen(self, rows: DataFrame, at: int) -> DataFrame:
        """Rows whose key no batch up to ``at`` had; null is a key like any other.

        The memory is cut to the keys of ``rows`` before the rows themselves are compared, so a small batch moves
        little of it.
        """
        key = self.schema.names[0]
        asked, known = rows.select(F.col(key).alias("_asked")).distinct(), self.known(at).withColumnRenamed(key, "_known")
        met = known.join(asked, F.col("_known").eqNullSafe(F.col("_asked")), "left_semi")
        return rows.join(met, F.col(key).eqNullSafe(F.col("_known")), "left_anti")

    def add(self, rows: DataFrame, at: int) -> None:
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.folder}/new/at={at}")

    def compact(self, upto: int) -> bool:
        """Join segments to the base once there are ``every``; what the base before covered is removed."""
        bases = finished(self.spark, f"{self.folder}/base")
        former = max((b for b in bases if b <= upto), default=None)
        if len(self._since(former, upto)) < self.every:
            return False
        self.known(upto).hint("rebalance").write.mode("overwrite").parquet(f"{self.folder}/base/at={upto}")
        if former is not None:
            delete(self.spark, *[f"{self.folder}/base/at={b}" for b in bases if b < former])
            delete(self.spark, *[f"{self.folder}/new/at={b}" for b in finished(self.spark, f"{self.folder}/new") if b <= former])
        return True

    def _since(self, base: int | None, at: int) -> list[int]:
        return sorted(b for b in finished(self.spark, f"{self.folder}/new") if b <= at and (base is None or b > base))
