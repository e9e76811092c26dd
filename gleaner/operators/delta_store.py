"""The saved-article store as a base and the changes since: a batch writes only what it changed.

::

    folder/base/at=<batch>/month=<yyyy-MM>/      whole rows of a month, up to and with that batch
    folder/changes/at=<batch>/month=<yyyy-MM>/   rows the batch created, and new values of rows it updated
    folder/outcome/at=<batch>/                   what became of each of its rows

Changes are merged when the store is read; a month with many of them gets a new base, other months stay as they
are. A write counts once its ``_SUCCESS`` file is there, so a lost driver leaves nothing half done, and a repeated
batch replaces its own folders and sees only what earlier batches wrote.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleaner.functions import dates as D
from gleaner.functions.text import text
from gleaner.operators import store as S
from gleaner.operators.ranking import keep_last
from gleaner.sources.folders import delete, finished

UNDATED = "undated"
SEED = -1


@dataclass(frozen=True)
class DeltaStore:
    """A store in ``folder`` with the columns of ``schema``: ``page_id``, ``url``, ``ord`` and more.

    ``fields`` are what updates may change. ``date`` names the column a page is filed by; it is set once, when the
    page is made. Without it all rows are undated. A month gets a new base after ``every`` batches with changes.
    """

    spark: SparkSession
    folder: str
    schema: StructType
    fields: list[str]
    date: str | None = None
    id_param: str = "ng"
    every: int = 16

    def __post_init__(self):
        if self.date in self.fields:
            raise ValueError(f"{self.date} files a page and cannot be updated")

    # ---- reading ----

    def rows(self, low: str | None = None, high: str | None = None, at: int | None = None) -> DataFrame:
        """The store after batch ``at`` (the newest by default), of the months from ``low`` to ``high`` and undated pages.

        Updates are few against the base and are folded first: of each field the last value that is not null.
        Pages are joined with them within their month.
        """
        return self._merged(self._wanted(low, high), at).select(*self.schema.names)

    def pages(self, low: str | None = None, high: str | None = None, at: int | None = None) -> DataFrame:
        """``page_id``, ``url``, ``ord`` and ``month`` alone: updates never change them, so nothing is merged."""
        base, changes = self._read(self._wanted(low, high), at)
        made = changes.where(F.col("kind") == "created")
        slim = ["page_id", "url", "ord", "month"]
        return base.select(*slim).unionByName(made.select(*slim))

    def outcomes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/outcome")

    # ---- writing ----

    def seed(self, rows: DataFrame) -> None:
        """Start from a whole table, unless the store has begun."""
        if not self._finished("base"):
            self._write(rows.select(*self.schema.names, self._month().alias("month")), "base", SEED)

    def apply(self, batch: DataFrame, key: str, at: int, order: Column | None = None) -> None:
        """Write what a batch changes, as ``store.upsert`` would; ``key`` is unique within the batch.

        Pages are looked up in the months of the batch's own dates, a day wider on both sides; in all months when a
        row has no date or names its page itself. Updates of unknown pages change nothing.
        """
        self.compact(at - 1)
        known = self.pages(*self._range(batch), at=at - 1)
        judged = S.judge(known.select("page_id", "url", "ord"), batch, key, self.id_param)
        slim = judged.select(key, "url", "page_id", "action", (F.col("action") != "failed").alias("ok"), text("error").alias("error"))
        path = f"{self.folder}/outcome/at={at}"
        slim.write.mode("overwrite").parquet(path)
        told = self.spark.read.schema(slim.schema).parquet(path).select(key, "page_id", "action")

        acted = batch.drop("page_id").join(told, key)
        kept = [c for c in dict.fromkeys(["url", *self.fields, *([self.date] if self.date else [])])]
        made = acted.where(F.col("action") == "created").select(
            "page_id", *kept, *([] if order is None else [order.cast("bigint").alias("ord")]),
            self._month().alias("month"), F.col("action").alias("kind"),
        )
        homes = known.select("page_id", "month").distinct()
        last = keep_last(acted.where(F.col("action") == "updated"), ["page_id"], key)
        updated = last.select("page_id", *self.fields, F.col("action").alias("kind")).join(homes, "page_id")
        changes = made.unionByName(updated, allowMissingColumns=True)
        missing = [f for f in self.schema if f.name not in changes.columns]
        self._write(changes.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}), "changes", at)

    def compact(self, upto: int) -> list[str]:
        """Give months with ``every`` or more changes a new base as of batch ``upto``; returns these months.

        What the base before covered is removed. What it did not cover stays until the next time, for readers that
        have begun.
        """
        bases, segments = self._newest(upto), self._finished("changes")
        waiting: dict[str, int] = {}
        for at, months in segments.items():
            for m in months:
                if bases.get(m, SEED - 1) < at <= upto:
                    waiting[m] = waiting.get(m, 0) + 1
        due = sorted(m for m, n in waiting.items() if n >= self.every)
        if due:
            self._write(self._merged(due, upto), "base", upto)
            for m in due:
                former = bases.get(m, SEED - 1)
                self._remove([("base", at, m) for at, months in self._finished("base").items() if at < former and m in months])
                self._remove([("changes", at, m) for at, months in segments.items() if at <= former and m in months])
        return due

    # ---- folders ----

    def _month(self) -> Column:
        if self.date is None:
            return F.lit(UNDATED)
        day = D.normalize_issue_date(self.date).try_cast("date")
        return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(UNDATED))

    def _range(self, batch: DataFrame) -> tuple[str | None, str | None]:
        if self.date is None:
            return None, None
        day = D.normalize_issue_date(self.date).try_cast("date")
        row = batch.agg(
            F.date_format(F.date_sub(F.min(day), 1), "yyyy-MM").alias("low"),
            F.date_format(F.date_add(F.max(day), 1), "yyyy-MM").alias("high"),
            F.count_if(day.isNull() | (text("page_id") != "")).alias("open"),
        ).first()
        return (None, None) if row["open"] else (row["low"], row["high"])

    def _wanted(self, low: str | None, high: str | None) -> list[str]:
        months = {m for kind in ("base", "changes") for found in self._finished(kind).values() for m in found}
        return sorted(m for m in months if m == UNDATED or ((low is None or m >= low) and (high is None or m <= high)))

    def _newest(self, at: int | None) -> dict[str, int]:
        """Batch of the newest base of each month."""
        newest: dict[str, int] = {}
        for batch, months in self._finished("base").items():
            if at is None or batch <= at:
                newest |= {m: max(batch, newest.get(m, batch)) for m in months}
        return newest

    def _read(self, months: Iterable[str], at: int | None) -> tuple[DataFrame, DataFrame]:
        """(base rows, changes after them) of some months: only their folders are opened."""
        months, bases = list(months), self._newest(at)
        base = [(bases[m], m) for m in months if m in bases]
        changes = [
            (batch, m) for batch, found in self._finished("changes").items() for m in months
            if m in found and batch > bases.get(m, SEED - 1) and (at is None or batch <= at)
        ]
        return self._load("base", base), self._load("changes", changes)

    def _load(self, kind: str, parts: list[tuple[int, str]]) -> DataFrame:
        columns = StructType(list(self.schema)).add("month", "string").add("at", "long")
        if kind == "changes":
            columns = columns.add("kind", "string")
        if not parts:
            return self.spark.createDataFrame([], columns)
        root = f"{self.folder}/{kind}"
        return self.spark.read.schema(columns).option("basePath", root).parquet(*[f"{root}/at={at}/month={m}" for at, m in parts])

    def _merged(self, months: list[str], at: int | None) -> DataFrame:
        base, changes = self._read(months, at)
        names = [*self.schema.names, "month"]
        saved = base.select(*names).unionByName(changes.where(F.col("kind") == "created").select(*names))
        if not self.fields:
            return saved
        last = [F.max_by(f, F.when(F.col(f).isNotNull(), F.col("at"))).alias(f"_{f}") for f in self.fields]
        updates = changes.where(F.col("kind") == "updated").groupBy("month", "page_id").agg(*last)
        joined = saved.join(updates, ["month", "page_id"], "left")
        return joined.select(*[F.coalesce(f"_{c}", c).alias(c) if c in self.fields else F.col(c) for c in names])

    def _write(self, rows: DataFrame, kind: str, at: int) -> None:
        spread = rows.hint("rebalance", F.col("month"))  # few files for a month, a large month in several
        spread.write.mode("overwrite").partitionBy("month").parquet(f"{self.folder}/{kind}/at={at}")

    def _finished(self, kind: str) -> dict[int, set[str]]:
        """Months of each finished write."""
        found = finished(self.spark, f"{self.folder}/{kind}")
        return {at: {n[6:] for n in names if n.startswith("month=")} for at, names in found.items()}

    def _remove(self, parts: list[tuple[str, int, str]]) -> None:
        for kind, at, month in parts:
            delete(self.spark, f"{self.folder}/{kind}/at={at}/month={month}")
            if not self._finished(kind).get(at):
                delete(self.spark, f"{self.folder}/{kind}/at={at}")
