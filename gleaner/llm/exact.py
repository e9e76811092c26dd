"""Exact deduplication against a persistent index of text digests, bucketed and sorted by digest."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import as_text, staged
from gleaner.session import shared_dir

#: Columns that ``exact_duplicates`` adds, in place of any that ``docs`` has by these names.
ADDED = ["keep_id", "group_size", "kept", "text_sha256"]
#: Texts are equal when they are after each of these runs became one space.
BLANKS = r"[\x20\x09-\x0D]+"
#: A bucket of the index is meant to hold at most so many digests.
BUCKET_ROWS = 4_000_000


def normalised(text: str = "text") -> Column:
    """The text with each run of blanks as one space; null is empty."""
    return F.regexp_replace(as_text(text), BLANKS, " ")


@dataclass
class DigestIndex:
    """Digests of all texts that were ever kept, each with the id and place of the row that stays.

    The index is a folder of Parquet files: one file for each bucket and append, dealt by the hash of ``digest`` and sorted by
    it. The catalog entry holds no data, so any later session opens the same folder again with the same ``buckets``.
    """

    spark: SparkSession
    path: str
    buckets: int
    name: str = ""

    SCHEMA = "digest BINARY, keep_id BIGINT, keep_row STRING"

    def __post_init__(self) -> None:
        self.name = self.name or f"gleaner_digests_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({self.SCHEMA}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def read(self) -> DataFrame:
        """The index by bucket: a join or aggregate by ``digest`` needs no shuffle of it."""
        return self.spark.table(self.name)

    def files(self) -> DataFrame:
        """The same rows as plain files, for joins whose other side has hot digests: both sides are then shuffled and can be split."""
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def unseen(self, firsts: DataFrame) -> DataFrame:
        """Rows of ``firsts`` (one a digest) whose digest is not in the index: a sort-merge anti-join, bucket by bucket."""
        return firsts.hint("merge").join(self.read().hint("merge"), "digest", "left_anti")

    def add(self, rows: DataFrame) -> None:
        """Append the first row (``digest, keep_id, keep_row``) of each new digest; known ones change nothing, so a batch may be replayed."""
        order = F.struct(F.col("keep_id").isNull().alias("no_id"), F.col("keep_id"), F.col("keep_row"))
        firsts = rows.groupBy("digest").agg(F.min(order).alias("first")).select("digest", "first.keep_id", "first.keep_row")
        # dealt as the buckets are: a task writes one file, whole and in order
        dealt = self.unseen(firsts).repartition(self.buckets, "digest").sortWithinPartitions("digest")
        dealt.write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").mode("append").option("path", self.path).saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

    def compacted(self, path: str) -> DigestIndex:
        """The index written anew to ``path`` with one file a bucket, for when many appends have left many."""
        new = DigestIndex(self.spark, path, self.buckets)
        dealt = self.files().repartition(self.buckets, "digest").sortWithinPartitions("digest")
        dealt.write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").mode("append").option("path", path).saveAsTable(new.name)
        self.spark.catalog.refreshTable(new.name)
        return new


def new_index(spark: SparkSession, rows: int, path: str | None = None) -> DigestIndex:
    """An empty index for about ``rows`` digests; without ``path`` in a folder that goes with the driver's session."""
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))
    if path is None:
        path = f"{shared_dir(spark).rstrip('/')}/gleaner-digests-{uuid.uuid4().hex}"
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return DigestIndex(spark, path, buckets)


def exact_duplicates(docs: DataFrame, index: DigestIndex | None = None, parts: int = 4, keep_text: bool = False) -> DataFrame:
    """The columns of ``docs`` (``text`` only with ``keep_text``) with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Of rows with equal normalised texts the one with the smallest ``doc_id`` is ``kept``; ``keep_id`` is its id and
    ``group_size`` the number of these rows in ``docs``. With an ``index`` of earlier data, a text it knows keeps the row it
    was first seen with and no row here; all new texts are appended to it. Without one a fresh index is filled, in ``parts``
    batches of rising ids, each checked against the batches before.

    Null texts are empty texts, and equal to them. Null ids come after all others. Of rows that repeat in text and id one
    stays. An empty table gives an empty table. Columns of the added names in ``docs`` are replaced.

    Texts are read once; what is shuffled is a digest, an id and a place. A text with very many copies is one row a task
    after the map-side minimum, and its rows can be split in the last join, both sides of which are read from files.
    """
    spark = docs.sparkSession
    docs = docs.drop(*ADDED)
    own = {c: f"_own_{c}" for c in docs.columns if c != "doc_id" and (c != "text" or keep_text)}
    slim = staged(
        docs.select(
            F.col("doc_id").cast("long").alias("keep_id"),
            F.unhex(F.sha2(normalised(), 256)).alias("digest"),
            # the place of a row, kept in the file: the tie of rows that agree in text and id
            F.format_string("%016x", F.monotonically_increasing_id()).alias("keep_row"),
            *[F.col(f"`{c}`").alias(n) for c, n in own.items()],
        ),
        "digests",
    )
    places = slim.select("digest", "keep_id", "keep_row")
    session = uuid.uuid4().hex[:8]  # places are told apart from those of other runs in the same index
    places = places.withColumn("keep_row", F.concat(F.lit(session), F.col("keep_row")))
    if index is None:
        bounds = sorted({b for b in slim.approxQuantile("keep_id", [i / parts for i in range(1, parts)], 0.01)}) if parts > 1 else []
        index = new_index(spark, slim.count())
        for batch in _batches(places, [int(b) for b in bounds]):
            index.add(batch)
    else:
        index.add(places)
    sizes = places.groupBy("digest").agg(F.count("*").alias("group_size"))
    groups = staged(sizes.join(index.read().withColumnRenamed("keep_row", "first_row"), "digest"), "groups")
    found = slim.withColumnRenamed("keep_id", "doc_id").join(groups, "digest")
    return found.select(
        "doc_id",
        *[F.col(n).alias(c) for c, n in own.items()],
        "keep_id",
        "group_size",
        (F.col("first_row") == F.concat(F.lit(session), F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _batches(places: DataFrame, bounds: list[int]) -> list[DataFrame]:
    """Rows by rising id, null ids last: the smallest id of a text is in the first batch that has the text."""
    if not bounds:
        return [places]
    inner = [places.where(f"keep_id >= {low} AND keep_id < {high}") for low, high in zip(bounds, bounds[1:], strict=False)]
    return [places.where(f"keep_id < {bounds[0]}"), *inner, places.where(f"keep_id >= {bounds[-1]} OR keep_id IS NULL")]


def unique_documents(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """``docs`` without the rows whose text an earlier row has, by ``exact_duplicates``."""
    return exact_duplicates(docs, index, keep_text=True).where("kept").select(docs.columns)
