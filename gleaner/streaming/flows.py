"""The jobs as streams: captures arrive as files, and each behaviour of a scheduled run becomes a flow.

State is bounded by the look-back: a watermark drops what is older, as a run would. Without a look-back nothing is
dropped, and state has a row for each key; ``seen_sink`` keeps such a memory as a table instead.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.utils import AnalysisException

from gleaner.functions import text as T
from gleaner.functions import urls as U
from gleaner.operators import rules, windows
from gleaner.operators.delta_store import DeltaStore
from gleaner.operators.ranking import keep_first
from gleaner.operators.state import SeenKeys


def ingest(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """New capture files of a table, be it a folder or one file, with an explicit schema. A missing table is an error."""
    spark.read.schema(schema).parquet(path)
    either = f"{path[:-1]}[{path[-1]}]"  # as a pattern, a path may name a file as well as a folder
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(either)


def first_sightings(rows: DataFrame, key: str, event_time: str, lookback: str | None = "24 hours", force_refresh: bool = False) -> DataFrame:
    """Each key once within the look-back, or once ever without one; a forced run lets everything through."""
    if force_refresh:
        return rows
    if lookback is None:
        return rows.dropDuplicates([key])
    return rows.withWatermark(event_time, lookback).dropDuplicatesWithinWatermark([key])


def daily_counts(rows: DataFrame, event_time: str, keys: list[str], lateness: str | None = "1 day", slide: str | None = None) -> DataFrame:
    """Counts by day (or by a sliding day); a day is final once the watermark passes it, or never without ``lateness``."""
    span = F.window(event_time, "1 day", slide) if slide else F.window(event_time, "1 day")
    timed = rows if lateness is None else rows.withWatermark(event_time, lateness)
    counted = timed.groupBy(span.alias("w"), *keys).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def _version_processor(keep_ms: int) -> StatefulProcessor:
    """Made in a function, so that it travels by value and executors need not have this package."""

    class Versions(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.best = handle.getValueState("best", "rank int, ord long, source string, first_seen long, until long")

        def handleInputRows(self, key, rows, timerValues):
            before = self.best.get() if self.best.exists() else None
            rank, ord, source, first, until = before or (-1, 0, None, None, 0)
            better = None
            for row in rows:
                if (row.rank, -row.ord) > (rank, -ord):
                    rank, ord, source, better = row.rank, row.ord, row.source, row
                first = row.ord if first is None else min(first, row.ord)
                until = max(until, (row.at_ms or 0) + keep_ms)
            self.best.update((rank, ord, source, first, until))
            if before is None or until != before[4]:
                if before is not None:
                    self.handle.deleteTimer(before[4])
                self.handle.registerTimer(until)
            if better is not None or first != before[3]:
                yield Row(article_id=key[0], first_seen=first, rank=rank, text=better and better.text, source=source, ord=ord)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.best.clear()
            return iter([])

        def close(self):
            pass

    return Versions()


def best_versions(
    rows: DataFrame, url: str, body: str, source: str, event_time: str, existing: str,
    retention: timedelta = timedelta(days=30), lateness: str = "1 day",
) -> DataFrame:
    """Best body of each article as versions arrive: new text beats saved text beats none, then the earliest.

    An article remembers the rank, place and source of its best version, not the body, until ``retention`` after its
    last version; versions on both sides of any date meet. A row comes out when the best changes, or with null text
    when an earlier place turns up alone. Rows behind the watermark are dropped. Use update mode, and ``run_batches``
    with ``timers``.
    """
    aid = U.article_id(url)
    has_body = T.strip(T.text(body)) != ""
    rank = F.when(has_body & (T.text(source) != existing), 2).when(has_body, 1).otherwise(0)
    keyed = rows.withWatermark(event_time, lateness).select(
        F.coalesce(F.nullif(aid, F.lit("")), F.col(url), F.lit("")).alias("article_id"), rank.alias("rank"),
        F.col("ord").cast("bigint").alias("ord"), F.col(body).alias("text"), F.col(source).alias("source"),
        F.unix_millis(F.col(event_time)).alias("at_ms"), F.col(event_time),
    )
    return keyed.groupBy("article_id").transformWithState(
        _version_processor(int(retention.total_seconds() * 1000)),
        "article_id string, first_seen bigint, rank int, text string, source string, ord bigint", "Update", "EventTime",
    )


# ---- micro-batch sinks: each writes a folder named by the batch, so a repeated batch replaces its own output ----


def _batch_dir(folder: str, batch_id: int) -> str:
    return f"{folder.rstrip('/')}/batch={batch_id}"


def split_late(batch: DataFrame, batch_id: int, folder: str, event_time: str, lateness: str) -> tuple[DataFrame, DataFrame]:
    """(rows in time, late rows with a ``reason``): late is older than the newest time of earlier batches less ``lateness``.

    Unlike a watermark nothing is dropped. Each batch leaves its newest time in ``folder``, one row, so a repeated
    batch is split as it was; rows without a time are in time.
    """
    spark, clock = batch.sparkSession, f"{folder.rstrip('/')}/clock"
    newest = batch.agg(F.max(event_time).alias("newest"))
    newest.write.mode("overwrite").parquet(_batch_dir(clock, batch_id))
    earlier = spark.read.schema(newest.schema.add("batch", "long")).parquet(clock).where(F.col("batch") < batch_id)
    limit = earlier.agg(F.max("newest") - F.expr(f"INTERVAL {lateness}")).scalar()
    late = F.coalesce(F.col(event_time) < limit, F.lit(False))
    reason = F.concat(F.lit("before "), limit.cast("string"))
    return batch.where(~late), batch.where(late).withColumn("reason", reason)


def gate_sink(
    folder: str, as_of: Column, event_time: str = "published_utc", lateness: str | None = None, late_folder: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Label every row by the window rule at the run's time; accepted and rejected rows are both kept, by decision.

    With ``lateness`` late rows go to ``late_folder`` with their reason instead.
    """
    if (lateness is None) != (late_folder is None):
        raise ValueError("lateness and late_folder go together")

    def write(batch: DataFrame, batch_id: int) -> None:
        if lateness is not None:
            batch, late = split_late(batch, batch_id, f"{late_folder}/times", event_time, lateness)
            late.write.mode("overwrite").parquet(_batch_dir(f"{late_folder}/rows", batch_id))
        decided = windows.decide(batch, as_of)
        decided.write.mode("overwrite").partitionBy("decision").parquet(_batch_dir(folder, batch_id))

    return write


def seen_sink(
    folder: str, key: str, event_time: str, order: str, lateness: str = "1 day", every: int = 16
) -> Callable[[DataFrame, int], None]:
    """Each key once over all batches, in whatever order rows arrive, without streaming state.

    ``folder/first`` has the first row of each new key of a batch by ``order``, ``folder/late`` the late rows with
    their reason; a late row whose key is new is in both. ``folder/keys`` is the memory.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        memory = SeenKeys(batch.sparkSession, f"{folder}/keys", batch.select(key).schema, every)
        memory.compact(batch_id - 1)
        late = split_late(batch, batch_id, f"{folder}/times", event_time, lateness)[1]
        late.write.mode("overwrite").parquet(_batch_dir(f"{folder}/late", batch_id))
        firsts = memory.unseen(keep_first(batch, [key], [order]), batch_id - 1)
        firsts.write.mode("overwrite").parquet(_batch_dir(f"{folder}/first", batch_id))
        memory.add(batch.sparkSession.read.schema(firsts.schema).parquet(_batch_dir(f"{folder}/first", batch_id)), batch_id)

    return write


def upsert_sink(
    folder: str, first: DataFrame, key: str, fields: list[str], date: str | None = None, every: int = 16
) -> Callable[[DataFrame, int], None]:
    """Keep a store that begins with ``first`` as a base and changes; ``open_store`` reads it.

    Saved rows keep their ``ord``; the rows of a batch come after all earlier ones, by ``key``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        later = F.lit((batch_id + 1) << 40) + F.pmod(F.col(key).try_cast("long"), F.lit(1 << 40))
        store = DeltaStore(batch.sparkSession, folder, first.schema, fields, date, every=every)
        store.seed(first)
        store.apply(batch, key, batch_id, later)

    return write


def open_store(folder: str, first: DataFrame, fields: list[str], date: str | None = None) -> DeltaStore:
    """The store that ``upsert_sink`` keeps."""
    return DeltaStore(first.sparkSession, folder, first.schema, fields, date)


def score_sink(folder: str, load_rules: Callable[[SparkSession], DataFrame], key: str) -> Callable[[DataFrame, int], None]:
    """Score each batch against the rules as they are at that moment."""

    def write(batch: DataFrame, batch_id: int) -> None:
        scored = rules.score_articles(batch, load_rules(batch.sparkSession), key)
        scored.write.mode("overwrite").parquet(_batch_dir(folder, batch_id))

    return write


def run_to_files(rows: DataFrame, folder: str, mode: str = "append") -> StreamingQuery:
    """Process what is there and stop; output and progress live in the shared folder."""
    return (
        rows.writeStream.outputMode(mode).format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    )


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_batches(
    rows: DataFrame, sink: Callable[[DataFrame, int], None], folder: str, mode: str = "append", timers: bool = False
) -> StreamingQuery:
    """Process what is there, batch by batch. With ``timers`` state is kept on disk, as Spark asks of flows that use them."""
    conf = rows.sparkSession.conf
    before = conf.get(PROVIDER, None)
    if timers:
        conf.set(PROVIDER, ON_DISK)
    try:
        return (
            rows.writeStream.outputMode(mode).foreachBatch(sink)
            .option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
        )
    finally:
        if timers:  # a query keeps the settings it was started with
            conf.unset(PROVIDER) if before is None else conf.set(PROVIDER, before)


def latest_sink(folder: str) -> Callable[[DataFrame, int], None]:
    """Keep the rows that each batch changed; ``read_latest`` takes the last of each key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_dir(folder, batch_id))

    return write


def read_latest(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    rows = spark.read.parquet(folder)
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_last")).select(*keys, "_last.*")


def read_output(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """What a file sink wrote; an empty table when no row came out."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
