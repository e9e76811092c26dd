"""Document fingerprints from spot signatures: content words that follow common words."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import Batches, map_batches, staged

#: Content words in a chain.
CHAIN = 3
#: Common words of each language, by the number of its documents that hold them.
ANCHORS = 64
#: Where so many words in a row hold no anchor, each word after them is taken for one, up to the next anchor.
GAP = 16
#: Distinct words that a task counts before it passes its counts on.
COUNTED = 1 << 18
#: Letters with their case folded and digits; every other ASCII character parts words.
KEPT = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isdigit() or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(KEPT).split()


def common_words(docs: DataFrame, count: int = ANCHORS) -> list[bytes]:
    """The anchors: for each ``lang`` the words that most of its documents hold, of equal ones the smaller, all together.

    Counts cover every document. Documents without a language, or all if there is no such column, are a group of their own.
    """
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")

    def run(batches: Batches) -> Batches:
        def flush() -> pa.RecordBatch:
            rows = [(lang, word, n) for lang, words in counts.items() for word, n in words.items()]
            columns = zip(*rows, strict=True) if rows else [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.binary(), pa.int64()), strict=True)], names=["lang", "word", "n"])

        counts: dict[str | None, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts.setdefault(lang, Counter()).update(set(words_of(text.as_py() or "")))
                if sum(map(len, counts.values())) > COUNTED:
                    yield flush()
                    counts.clear()
        yield flush()

    counted = map_batches(docs.select(lang.alias("lang"), F.col("text").cast("string")), run, "lang string, word binary, n long")
    first = lambda rows, *keys: rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "word"))).where(F.col("rank") <= count)
    totals = counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(16)))
    top = first(first(totals, "lang", "salt"), "lang").select("word").distinct()
    return sorted(bytes(r.word) for r in top.collect())  # so many words a language


def signatures(text: str, anchors: frozenset[bytes]) -> np.ndarray:
    """The sorted set of a text's signatures as 64-bit numbers.

    A signature is an anchor with the next CHAIN content words after it, anchors skipped. Where GAP words in a row hold no
    anchor, the words after them take the place of anchors up to the next one, so no long part of a text is left out. A
    text in which nothing is followed by a content word takes the chains at every word instead, so that every text with
    words has some.
    """
    words = words_of(text)
    if not words:
        return np.array([], np.uint64)
    digest, out = xxhash.xxh64_intdigest, set()
    content = [i for i, w in enumerate(words) if w not in anchors]
    common = np.array([i for i, w in enumerate(words) if w in anchors], np.int64)
    bounds = np.r_[-1, common, len(words)]
    gaps = [np.arange(bounds[j] + 1 + GAP, bounds[j + 1]) for j in np.flatnonzero(np.diff(bounds) > GAP + 1)]
    spots = np.concatenate([common, *gaps])
    for i, at in zip(spots.tolist(), np.searchsorted(content, spots, side="right").tolist(), strict=True):
        if at < len(content):
            out.add(digest(b" ".join([words[i], *(words[j] for j in content[at : at + CHAIN])])))
    if not out:
        out = {digest(b" ".join(words[i : i + CHAIN])) for i in range(max(1, len(words) - CHAIN + 1))}
    return np.sort(np.fromiter(out, np.uint64, len(out)))


def digest_of(found: np.ndarray) -> str:
    return hashlib.sha256(found.tobytes()).hexdigest()[:32]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets. Sets that cannot meet, by their ranges or sizes, are told apart at once."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if a[-1] < b[0] or b[-1] < a[0]:
        return 0.0
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    shared = int((large[at] == small).sum())
    return shared / (len(a) + len(b) - shared)


# ---- each document beside the next ---------------------------------------------------------------


def beside_next(docs: DataFrame) -> DataFrame:
    """``(bucket, doc_id, text, after, tie, own)``: each bucket has a run of documents by descending id and the next one.

    Bounds come from approximate quantiles of the ids, so a bucket has a bounded share of the documents; only
    the first document of each bucket (all with its id) is sent twice, ``own`` false, to stand behind the bucket
    before it. Order is by ``after``, then ``tie``.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shares = [i / buckets for i in range(1, buckets)]
    bounds = slim.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 100 * buckets)).first()[0] or []
    cuts = sorted(set(bounds), reverse=True)
    bucket = F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<long>"), lambda c: c >= F.col("doc_id"))))
    placed = slim.withColumn("bucket", bucket.cast("int")).withColumn("after", F.coalesce(F.bitwise_not("doc_id"), F.lit((1 << 63) - 1)))
    heads = sorted((r.bucket, r.head) for r in placed.groupBy("bucket").agg(F.min("after").alias("head")).collect())  # a row a bucket
    before = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    also = F.lit(None).cast("int")
    if before:
        also = F.try_element_at(F.map_from_arrays(F.lit([h for h, _ in before]), F.lit([b for _, b in before])), F.col("after"))
    copies = F.array(F.struct(F.col("bucket"), F.lit(True).alias("own")), F.struct(also.cast("int").alias("bucket"), F.lit(False).alias("own")))
    dealt = placed.withColumn("c", F.explode(F.filter(copies, lambda c: c["bucket"].isNotNull())))
    return dealt.select("c.bucket", "doc_id", "text", "after", F.xxhash64("text").alias("tie"), "c.own")


def spot_fingerprints(docs: DataFrame, anchors: int = ANCHORS) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_signatures)``.

    Documents stand in order of descending ``doc_id``, nulls last, equal ids by a hash of their text; after the last comes
    the first. Whole texts move once, into buckets of neighbouring ids. A null text is empty; texts without words have
    the empty set of signatures, which is like only itself. Repeated rows come out repeated, each beside the other;
    other columns are ignored.
    """
    common = common_words(docs, anchors)
    placed = beside_next(docs)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the last bucket's extra row is the first document of all; it sorts behind all of that bucket's own
    ordered = placed.repartition(n, "bucket").sortWithinPartitions("bucket", F.desc("own"), "after", "tie")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_signatures long"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]

    def run(batches: Batches) -> Batches:
        known = frozenset(common)

        def judged(doc: tuple, following: tuple) -> tuple:
            (_, doc_id, text, _, found), (_, _, text2, _, found2) = doc, following
            half = len(text) // 2
            edited = text[: len(text) - half] + text2[:half]
            changed = signatures(edited, known)
            return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), digest_of(found), digest_of(changed), likeness(found, changed), likeness(found, found2), len(found))

        held = None
        for batch in batches:
            rows = []
            columns = [batch.column(c) for c in ("bucket", "doc_id", "text", "own")]
            for bucket, doc_id, text, own in zip(*columns, strict=True):
                now = (bucket.as_py(), doc_id.as_py(), text.as_py(), own.as_py())
                now = (*now, signatures(now[2], known))
                if held and held[0] == now[0] and held[3]:
                    rows.append(judged(held, now))
                held = now
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in schema.split(", ")])

    return map_batches(ordered.select("bucket", "doc_id", "text", "own"), run, schema)


# ---- all documents beside each other -------------------------------------------------------------


def signature_sets(docs: DataFrame, anchors: int = ANCHORS) -> DataFrame:
    """``(doc_id, fingerprint, signatures)`` for each document; signatures are sorted as unsigned numbers."""
    common = common_words(docs, anchors)
    schema = "doc_id long, fingerprint string, signatures array<long>"

    def run(batches: Batches) -> Batches:
        known = frozenset(common)
        for batch in batches:
            found = [signatures(text or "", known) for text in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), pa.array([digest_of(f) for f in found], pa.string()), pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fingerprint", "signatures"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, schema)


def similar_sets(docs: DataFrame, threshold: float = 0.8, anchors: int = ANCHORS) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): ``(doc_id, fingerprint, n_links)`` for each document, and ``(one, other, likeness)`` once for each two
    different fingerprints whose sets have a Jaccard similarity of ``threshold`` (between 0 and 1, both excluded) or more.

    Sets stand in partitions by the logarithm of their length, so wide that similar ones are in the same or the next. Within
    a partition they meet at their rarest signatures: two similar sets share one among the first ``n - ceil(threshold * n) + 1``.
    A pair that meets there goes on only if its lengths, and what is left in both after that signature, allow the threshold;
    whole sets are compared last. Results are exact for the signatures. ``n_links`` counts other fingerprints.

    Null and empty texts have the empty set, which is like no other fingerprint. Equal sets are one fingerprint; repeated rows
    come out repeated; null ids stay; other columns are ignored.
    """
    found = staged(signature_sets(docs, anchors), "signatures")
    sets = found.dropDuplicates(["fingerprint"]).select("fingerprint", "signatures", F.size("signatures").alias("n")).where("n > 0")
    each = staged(sets.select("fingerprint", "n", F.explode("signatures").alias("s")), "signature-rows")
    held_by = staged(each.groupBy("s").agg(F.count("*").alias("holders")), "signature-counts")  # a plain table, so that a hot signature can be split
    ranked = each.join(held_by, "s").groupBy("fingerprint", "n").agg(F.array_sort(F.collect_list(F.struct("holders", "s"))).alias("rarest"))
    needed = F.ceil(F.col("n") * threshold - 1e-9)
    first = F.slice("rarest", F.lit(1), (F.col("n") - needed + 1).cast("int"))
    part = F.floor(F.log(F.col("n")) / (math.log(1 / threshold) * (1 + 1e-9)))
    seen = staged(ranked.select("fingerprint", "n", part.alias("part"), F.posexplode(first).alias("at", "r")).select("fingerprint", "n", "part", "at", F.col("r.s").alias("s")), "rarest")
    side = lambda name: [F.col("fingerprint").alias(name), F.col("n").alias(f"n_{name}"), F.col("at").alias(f"at_{name}"), "s"]
    one = seen.select(*side("one"), F.explode(F.array("part", F.col("part") + 1)).alias("part"))  # also beside the longer sets of the next partition
    other = seen.select(*side("other"), "part")
    shorter = (F.col("n_one") < F.col("n_other")) | ((F.col("n_one") == F.col("n_other")) & (F.col("one") < F.col("other")))
    left = F.least(F.col("n_one") - F.col("at_one"), F.col("n_other") - F.col("at_other"))  # shared from here on, at most
    before = F.least("at_one", "at_other")
    most = left + before
    fits = most >= (F.col("n_one") + F.col("n_other")) * (threshold / (1 + threshold)) - 1e-9
    met = one.join(other, ["part", "s"]).where(shorter & (F.col("n_one") >= F.col("n_other") * threshold - 1e-9) & fits).select("one", "other").distinct()
    whole = lambda name: sets.select(F.col("fingerprint").alias(name), F.col("signatures").alias(f"set_{name}"))
    beside = met.join(whole("one"), "one").join(whole("other"), "other")
    shared = F.size(F.array_intersect("set_one", "set_other"))
    like = beside.select("one", "other", (shared / (F.size("set_one") + F.size("set_other") - shared)).alias("likeness"))
    pairs = staged(like.where(F.col("likeness") >= threshold), "similar-sets")
    links = pairs.select(F.explode(F.array("one", "other")).alias("fingerprint")).groupBy("fingerprint").agg(F.count("*").alias("n_links"))
    members = found.select("doc_id", "fingerprint").join(links, "fingerprint", "left")
    return members.select("doc_id", "fingerprint", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), pairs
