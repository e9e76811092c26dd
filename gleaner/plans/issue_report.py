"""Newspaper issue: links, pre-filter, store split, body gate, scoring, selection and the report's input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import text as T
from gleaner.functions import urls as U
from gleaner.operators import dedupe, digest, filters, quality, ranking, rules, selection
from gleaner.operators import store as S
from gleaner.session import cut_lineage


def issue_links(links: DataFrame, domain: str, article_path: str, id_param: str = "ng") -> tuple[DataFrame, DataFrame]:
    """(articles to fetch, links left out with a reason): first link of each id, before the title filter."""
    rows = links.where(U.is_issue_article("url", domain, article_path, id_param))
    firsts = ranking.keep_first(rows.withColumn("_id", U.query_param("url", id_param)), ["_id"], ["ord"]).drop("_id")
    judged = firsts.withColumn("exclude_reason", filters.pre_exclude_reason(F.col("title")))
    return judged.where("exclude_reason = ''").drop("exclude_reason"), judged.where("exclude_reason <> ''")


def gate(targets: DataFrame, captures: DataFrame) -> DataFrame:
    """Outcome of every fetched article: its body judged against its title and page."""
    joined = targets.join(captures.select("url", "page_title", "text", "selector"), "url", "left")
    checked = quality.validate_body(joined, "text", "title", "page_title", "url")
    excluded = filters.exclude_by_body_reason(F.col("title"), F.col("clean_text"))
    outcome = quality.accept_body(
        F.col("clean_text"), F.lit(""), F.col("title"), T.text("selector"), F.col("rejection_reason"), excluded
    )
    return checked.withColumn("outcome", outcome)


def scoring_inputs(fetched: DataFrame, existing: DataFrame, id_param: str = "ng") -> DataFrame:
    """Fetched and saved articles together, one row for each article with its best body."""
    both = fetched.unionByName(existing, allowMissingColumns=True)
    return dedupe.best_body(both, "url", "text", "source", "ord", existing="store_existing", id_param=id_param)


def articles(
    links: DataFrame, store: DataFrame, captures: DataFrame, domain: str, article_path: str, id_param: str = "ng"
) -> tuple[DataFrame, DataFrame]:
    """(articles to score, audit), from an issue's links, the saved pages and the captured ones.

    Links already saved with a text are taken from the store, all others from their capture if its body passes the gate. The
    audit has one row for each article link that came first with its id: ``ord, url, action`` (``left_out``, ``new``,
    ``backfill``, ``skipped``) and ``outcome``. ``links`` is ``ord, url, title`` and, where known, ``issue_date`` and ``edition``; texts are joined to
    link rows only where needed.
    """
    dated = [c for c in ("issue_date", "edition") if c in links.columns]
    wanted, left = issue_links(links.select("ord", "url", "title", *dated), domain, article_path, id_param)
    targets = cut_lineage(split_targets(wanted, store).withColumnRenamed("outcome", "action"))  # link rows without texts
    judged = gate(targets.where("action <> 'skipped'").drop("page_id"), captures)
    fetched = judged.where(F.col("outcome").startswith("success")).select(
        "ord", "url", *dated, F.col("title").alias("source_title"), "page_title", F.col("clean_text").alias("text"), F.lit("fetched").alias("source")
    )
    saved = store.select("page_id", F.struct("page_id", "url", "title", "issue_date", "edition", "text").alias("existing"))
    skipped = targets.where("action = 'skipped'")
    inventory = skipped.drop(*dated).join(saved, "page_id").withColumn("status", F.lit("existing_in_store"))
    existing, _ = S.inventory_to_scoring(inventory, fetched)
    audit = (
        left.select("ord", "url", F.lit("left_out").alias("action"), F.col("exclude_reason").alias("outcome"))
        .unionByName(skipped.select("ord", "url", "action", F.lit("").alias("outcome")))
        .unionByName(judged.select("ord", "url", "action", "outcome"))
    )
    return scoring_inputs(fetched, existing, id_param), audit


def score_and_select(articles: DataFrame, rule_table: DataFrame, key: str, top_rank: int = 5) -> tuple[DataFrame, DataFrame]:
    """(all articles with scores and the selection flag, without their texts; the rows of the final report, with them).

    Articles are scored once, into a table that holds no texts; the few rows of the report get theirs at the end.
    ``key`` must be unique.
    """
    scored = rules.score_articles(articles, rule_table, key).withColumn("text_length", F.length(T.text("text")))
    named = scored.withColumns({"title": T.first_present("source_title", "page_title"), "published_at": T.text("issue_date")})
    held = cut_lineage(named.drop("text", "clean_body"))  # read several times below
    marked = selection.mark_selected(held, selection.select_report(held, top_rank=top_rank))
    final = selection.select_from_pool(held, top_rank=top_rank, include_ties=False)
    texts = articles.select(key, "text")
    return marked.drop("published_at"), final.join(texts, key, "left").withColumn("clean_body", T.clean_body("text"))


def report_input(final: DataFrame, order: list[Column] | None = None, chars: int = 1800) -> DataFrame:
    return digest.report_input(final, order or selection.pool_order(), ["clean_body", "text"], chars)


def split_targets(incoming: DataFrame, store: DataFrame) -> DataFrame:
    return S.split_existing(incoming, store)
