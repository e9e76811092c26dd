"""The dealt queries: each applies its operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import decontaminate, dialogs, exact, langid, licenses, mixing, secrets, simhash, spots, sql_twins, suffixes, tokens, urlpaths, whitening
from gleaner.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_secret_scans", sql_twins.secrets_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    counts = [secrets.of_kind(F.col("base_spans"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(secrets.written(F.col("base_spans")), 256).alias("base_sha256"), secrets.written(F.col("all_spans")).alias("spans"))


@query("op2_license_scans", sql_twins.licenses_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_places(table(spark, sf_dir, "documents"))
    spans, starts = F.col("spans"), licenses.exact_starts(F.col("spans"))
    return found.select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        licenses.labels_of(spans, base=True).alias("base_labels"), licenses.labels_of(spans).alias("labels"),
        F.coalesce(F.array_max(F.transform(spans, lambda s: s["coverage"])), F.lit(0.0)).alias("score"),
    )


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    counted = tokens.token_prefixes(docs, public_tokenizers.path("word_bpe_49k.json"), limit=2048)
    prefix = F.col("prefix_tokens")
    n_tokens = tokens.tokens_of_prefix(prefix, F.size(prefix))
    kept = tokens.words_in_budget(prefix, 2048)
    return counted.select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > 2048).alias("over_limit"), tokens.tokens_of_prefix(prefix, kept).alias("tokens_kept"))


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), keep_text=False)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query("op6_document_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spots.spot_fingerprints(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query("op7_url_filters", sql_twins.urls_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urlpaths.judge_urls(table(spark, sf_dir, "pages"))
    return found.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


@query("op8_suffix_array_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"))


@query("op9_mixing_to_target_weights")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_tokens", *[f"p_{d}" for d in mixing.DOMAINS], "rate", *[f"error_{d}" for d in mixing.DOMAINS])


@query("op10_benchmark_decontamination", sql_twins.DECONTAMINATION)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated",
    )


@query("op11_exact_dedup", sql_twins.EXACT)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op12_conversation_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return dialogs.repaired_all(conversations, dialogs.damaged(conversations))


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
