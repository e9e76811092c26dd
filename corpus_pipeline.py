"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import decontaminate, langid, mixing, secrets, simhash
from gleaner.llm.common import as_text, staged, table, text_key

#: Names for a moment, unlike any column of a document.
KEY, ID, SPANS = "gleaner_text_key", "gleaner_kept_id", "gleaner_spans"


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: those that the models reject go."""
    own = {c: f"gleaner_own_{c}" for c in docs.columns if c in langid.ADDED}
    found = langid.identify(docs.withColumnsRenamed(own)).where(~F.col("rejected"))
    return found.select([F.col(own.get(c, c)).alias(c) for c in docs.columns])


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    kept = simhash.near_duplicates(docs).where("kept").select(F.col("doc_id").alias(ID), F.col("text_key").alias(KEY)).distinct()
    keyed = docs.withColumn(KEY, text_key())
    one = keyed.join(kept, (keyed[KEY] == kept[KEY]) & keyed["doc_id"].eqNullSafe(kept[ID]), "left_semi")
    return one.dropDuplicates(["doc_id", KEY]).select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without too large a share of benchmark words."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    dirty = found.where("contaminated").select(F.col("text_key").alias(KEY)).distinct()
    return docs.withColumn(KEY, text_key()).join(dirty, KEY, "left_anti").select(docs.columns)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; ``n_chars`` follows the text."""
    found = secrets.secret_spans(docs).where(F.size("all_spans") > 0)
    spans = found.groupBy(F.col("text_key").alias(KEY)).agg(F.any_value("all_spans").alias(SPANS))
    joined = docs.withColumn(KEY, text_key()).join(spans, KEY, "left")
    text = F.when(F.col(SPANS).isNull(), F.col("text")).otherwise(secrets.redacted(as_text("text"), F.col(SPANS)))
    n_chars = F.when(F.col(SPANS).isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return joined.withColumn("text", text).withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def weighted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their domain posteriors and rates in place of columns of these names; those whose rate is zero go."""
    found = mixing.mixed(docs, table(spark, sf_dir, "labels")).where("rate > 0")
    added = ["n_tokens", *[f"p_{d}" for d in mixing.DOMAINS], "rate"]
    # posteriors and rates go by the text alone
    rates = staged(found.groupBy(F.col("text_key").alias(KEY)).agg(*[F.any_value(c).alias(c) for c in added]), "rates")
    return docs.drop(*added).withColumn(KEY, text_key()).join(rates, KEY).drop(KEY)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language ID", identified),
    ("SimHash near-dedup", deduplicated),
    ("benchmark decontamination", decontaminated),
    ("secret scans", redacted),
    ("mixing to target weights", weighted),
]
#: Language models cannot be put in SQL; the tests compare with a plain version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
