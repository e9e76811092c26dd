"""Mixing to target weights: soft domain memberships, and document rates that meet domain totals."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import as_text, staged, text_key

#: Domains of the labelled table.
DOMAINS = ["plain", "low", "toxic"]
#: Target shares of the tokens.
TARGETS = {"plain": 0.8, "low": 0.15, "toxic": 0.05}
#: Labelled documents that the classifier is fitted on at most, those with the smallest id hashes.
LABELLED = 20_000
#: A classifier of at most so many terms is broadcast; a larger one is joined by a shuffle of the documents' terms.
BROADCAST_TERMS = 400_000
#: How many standard deviations a term's count must be from chance.
CHANCE = 5.0
#: Divides log-odds, so that memberships stay soft.
TEMPERATURE = 1.5
#: Words of letters, and runs of marks.
TERM = r"[\p{L}]+|[^\p{L}\p{N}\s]+"


def domain() -> Column:
    """The domain that a row of the labelled table names; null where it names none."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "plain").when(F.col("quality") == 0, "low")


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def fit_terms(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> tuple[DataFrame, list[float]]:
    """``(term, weights)`` and the log-odds without any term, by domain: naive Bayes over each document's set of terms.

    Fitted on at most ``limit`` labelled ids. Terms are chosen by their share of all distinct terms of a domain's
    documents, so that long documents favour no domain: all those ``CHANCE`` standard deviations from chance in some
    domain. A term weighs by how many documents have it; to have none of them weighs too. An id with several labels counts for the first by name. Without labels nothing is.
    """
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), domain().alias("domain")).where("doc_id IS NOT NULL AND domain IS NOT NULL")
    sample = named.groupBy("doc_id").agg(F.min("domain").alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_text("text").alias("text"))
    known = texts.join(F.broadcast(sample), "doc_id").select("domain", F.explode(F.concat(F.array(F.lit("")), F.array_distinct(terms_of(F.col("text"))))).alias("term"))
    # the empty term stands in every document once and counts them
    counted = staged(known.groupBy("term").agg(*[F.count_if(F.col("domain") == d).alias(d) for d in DOMAINS]), "terms")
    documents, sizes = counted.agg(*[F.sum(F.when(F.col("term") == "", F.col(d))) for d in DOMAINS]).first(), counted.agg(*[F.sum(d) for d in DOMAINS]).first()
    documents, sizes = [n or 0 for n in documents], [n or 0 for n in sizes]
    prior = [float(np.log((n + 1) / (sum(documents) + len(DOMAINS)))) for n in documents]
    seen = sum(F.col(d) for d in DOMAINS)
    p = (seen + 0.5) / (sum(sizes) + 1.0)
    far = F.greatest(*[F.abs(F.col(d) - n * p) / F.sqrt(n * p + 1) for d, n in zip(DOMAINS, sizes, strict=True)])
    best = staged(counted.where((F.col("term") != "") & (far >= CHANCE)), "weights")
    held = (seen + 0.5) / (sum(documents) + 1.0)
    shares = [(F.col(d) + held) / (n + 1.0) for d, n in zip(DOMAINS, documents, strict=True)]
    present, absent = [F.log(s / held) / TEMPERATURE for s in shares], [F.log((1 - s) / (1 - held)) / TEMPERATURE for s in shares]
    base = best.agg(*[F.sum(a) for a in absent]).first()
    weights = F.array(*[a - b for a, b in zip(present, absent, strict=True)])
    return best.select("term", weights.alias("weights")), [a + (b or 0.0) for a, b in zip(prior, base, strict=True)]


def memberships(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, text_key, n_tokens, p_<domain> …)`` for each document: the posterior of each domain."""
    weights, base = fit_terms(docs, labels)
    text = as_text("text")
    n_tokens = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")).cast("long")
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), text_key().alias("text_key"), n_tokens.alias("n_tokens"), F.array_distinct(terms_of(text)).alias("terms"))
    small = weights.count() <= BROADCAST_TERMS
    found = read.select("row", "doc_id", "text_key", "n_tokens", F.explode_outer("terms").alias("term")).join(F.broadcast(weights) if small else weights, "term", "left")
    odds = found.groupBy("row", "doc_id", "text_key", "n_tokens").agg(*[F.coalesce(F.sum(F.get("weights", F.lit(i))), F.lit(0.0)).alias(f"w{i}") for i in range(len(DOMAINS))])
    logits = [F.col(f"w{i}") + b for i, b in enumerate(base)]
    top = F.greatest(*logits)
    shares = [F.exp(x - top) for x in logits]
    return odds.select("doc_id", "text_key", "n_tokens", *[(s / sum(shares)).alias(f"p_{d}") for s, d in zip(shares, DOMAINS, strict=True)])


def fitted_rates(members: DataFrame, targets: dict[str, float], budget: float = 1.0, steps: int = 30, close: float = 1e-7) -> tuple[DataFrame, list[float]]:
    """``members`` with ``rate``, and the relative error of each domain's expected total.

    Least squares on the relative errors of the domain totals by projected gradient: every step is one aggregate over
    all documents; the gradient is scaled by the Gram matrix of the documents with a positive rate while that lowers
    the loss, else taken as it is, and rates below zero are set to zero. All start at rate ``budget``. What comes to the driver is one row of sums.
    """
    size = len(DOMAINS)
    posteriors = [F.col(f"p_{d}") for d in DOMAINS]
    tokens = F.col("n_tokens").cast("double")
    whole = members.agg(F.sum("n_tokens")).first()[0] or 0
    goals = np.array([targets[d] * budget * whole for d in DOMAINS])
    scale = np.maximum(goals, 0.001 * budget * max(whole, 1))
    rate: Column = F.lit(float(budget))
    least, best, plain, step = np.inf, (rate, np.zeros(size)), False, 1.0
    scaled = steep = np.zeros(size)
    for _ in range(steps if whole else 0):
        active = F.when(rate > 0, tokens).otherwise(0.0)
        sums = members.agg(
            *[F.sum(rate * tokens * p) for p in posteriors],
            *[F.sum(active * posteriors[i] * posteriors[j]) for i in range(size) for j in range(i, size)],
        ).first()
        error = (np.array(sums[:size]) - goals) / scale
        if (loss := float(error @ error)) < least:
            done = loss > 0 and least - loss < 1e-9 * loss
            least, best, plain, step = loss, (rate, error), False, 1.0
            gram = np.zeros((size, size))
            gram[np.triu_indices(size)] = sums[size:]
            gram = (gram + np.triu(gram, 1).T) / np.outer(scale, scale)
            steep = error / scale / (np.trace(gram) + 1e-300)
            scaled = np.linalg.solve(gram + np.eye(size) * (1e-9 * np.trace(gram) + 1e-300), error) / scale
            if done or np.abs(error).max() <= close:
                break
        elif not plain:  # the scaled step leaves the feasible side too far: take the plain gradient from the best point
            plain = True
        elif (step := step / 4) < 1e-3:
            break
        moved = steep * step if plain else scaled
        rate = F.greatest(F.lit(0.0), best[0] - sum(p * float(m) for p, m in zip(posteriors, moved, strict=True)))
    rate, error = best
    return members.withColumn("rate", rate), error.tolist()


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, budget: float = 1.0, tolerance: float | None = None) -> DataFrame:
    """``(doc_id, text_key, n_tokens, p_<domain> …, rate, error_<domain> …)`` for each document.

    A classifier fitted on a bounded sample of the labelled table gives each document's domain posteriors; rates are the
    nonnegative numbers of copies whose expected tokens of each domain are its target share of ``budget`` times all
    tokens, which are words between blanks here. ``error_<domain>``, the same in all rows, is how far the domain's expected total is from its
    target, as a share of it; one beyond ``tolerance`` raises ``ValueError``, so a target that no rates meet does not pass unseen.
    A null or empty text has no tokens, the posterior of a text without terms and a rate that no total feels.
    Repeated rows come out repeated with the same rate; without labels memberships are even; other columns are ignored.
    """
    found, errors = fitted_rates(staged(memberships(docs, labels), "memberships"), targets, budget)
    if tolerance is not None and max(map(abs, errors)) > tolerance:
        raise ValueError(f"domain totals miss their targets by {dict(zip(DOMAINS, errors, strict=True))}")
    return found.withColumns({f"error_{d}": F.lit(float(e)) for d, e in zip(DOMAINS, errors, strict=True)})
