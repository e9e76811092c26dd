"""The pipeline's stages on awkward rows and on the smallest tables."""

import cases
import corpus_pipeline as P
from gleaner.llm import decontaminate, langid, secrets, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(name):
    return dict(P.STAGES)[name]


def test_stages_keep_the_columns_of_their_documents(spark, sf_dir):
    docs = cases.documents(spark)
    for name, run in P.STAGES[:-1]:
        found = run(spark, docs, sf_dir)
        assert found.columns == docs.columns and found.count() > 0
    assert stage("mixing to target weights")(spark, docs, sf_dir).count() > 0


def test_language_stage_drops_only_texts_without_letters(spark, sf_dir):
    kept = stage("language ID")(spark, cases.documents(spark), sf_dir)
    want = [(i, t) for i, t in cases.texts() if any(c.isalpha() for c in t or "")]
    assert cases.counted(kept.select("doc_id", "text").collect()) == cases.counted(want)
    assert kept.where("`key` IS NULL OR lang_pred IS NULL OR rejected IS NULL").count() == 0


def test_one_document_of_each_group_stays(spark, sf_dir):
    docs = cases.documents(spark)
    kept = [r.doc_id for r in stage("SimHash near-dedup")(spark, docs, sf_dir).collect()]
    groups = simhash.near_duplicates(docs).select("component_id").distinct().collect()
    assert sorted(map(str, kept)) == sorted(str(r.component_id) for r in groups)


def test_secrets_are_gone_and_everything_else_is_kept(spark, sf_dir):
    docs = cases.documents(spark)
    kept = stage("secret scans")(spark, docs, sf_dir)
    assert kept.count() == docs.count() and kept.where("n_chars <> length(text)").count() == 0
    assert secrets.secret_spans(kept).where("size(base_spans) > 0").count() == 0


def test_run_follows_the_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = langid.identify(docs).where("NOT rejected").select(docs.columns)
    single = simhash.near_duplicates(known).where("kept").select("doc_id")
    clean = decontaminate.contamination(known.join(single, "doc_id"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("NOT contaminated")
    got = P.run(spark, sf_dir)
    want = {r.doc_id for r in clean.collect()}
    assert {r.doc_id for r in got.where("rate > 0").collect()} <= want
    assert got.count() >= 0.9 * len(want)
