"""Token counts, fingerprints, languages, passages and rates on awkward rows, against plain versions."""

import hashlib
import itertools
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import cases
from gleaner.llm import graph, langid, mixing, queries, simhash, spots, suffixes, tokens

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


# ---- token counts


def test_tokens_are_those_of_the_library(spark):
    library = Tokenizer.from_file(VOCABULARY)
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in cases.texts()]
    found = tokens.token_prefixes(cases.documents(spark), VOCABULARY)
    assert cases.counted(found.select("doc_id", "n_bytes", "n_tokens").collect()) == cases.counted(want)
    rows = found.where("n_bytes > 5000").collect()
    assert rows and all(r.prefix_tokens[r.words_within - 1] == r.within <= 2048 < r.prefix_tokens[r.words_within] for r in rows)


def test_stored_prefixes_answer_budgets_as_the_operator_does(spark):
    prefix = F.col("prefix_tokens")
    for limit in (1, 7, 2048):
        found = tokens.token_prefixes(cases.documents(spark), VOCABULARY, limit=limit)
        asked = found.withColumn("kept", tokens.words_in_budget(prefix, limit)).select(
            "n_tokens", "within", "words_within", "kept", tokens.tokens_of_prefix(prefix, F.col("kept")).alias("spent"), tokens.tokens_of_prefix(prefix, F.size(prefix)).alias("all")
        )
        rows = asked.collect()
        assert rows and all((r.words_within, r.within, r.n_tokens) == (r.kept, r.spent, r.all) for r in rows)


def test_every_prefix_has_its_exact_count():
    library, table = Tokenizer.from_file(VOCABULARY), tokens.word_counts(VOCABULARY)
    letters = "abcinthere'sſΣéİ 日본½²\x1c\x85​👍.,!<|endoftext|>"
    rng = random.Random(3)
    for text in ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(400)]:
        counts = table.counts(text)
        assert (int(counts[-1]) if len(counts) else 0) == len(library.encode(text, add_special_tokens=False).ids), text
    for word in ("extraordinary", "zzzxq", "antidisestablishment"):
        assert table.every_prefix(word) == [len(library.encode(word[:i]).ids) for i in range(1, len(word) + 1)]


def test_long_runs_take_memory_by_their_length():
    library, table = Tokenizer.from_file(VOCABULARY), tokens.WordCounts(VOCABULARY)
    rng = random.Random(9)
    runs = ["".join(rng.choice("etaoinshr") for _ in range(6_000)), "=" * 5_000, "é日" * 2_000, "".join(rng.choice("=-_*#") for _ in range(5_000))]
    for run in [*runs, *(runs[0][:n] for n in range(60, 70))]:
        assert table.counts(run).tolist() == [len(library.encode(run, add_special_tokens=False).ids)]
    for kept in (table, table.closed_words, table.prefix):
        assert sum(map(len, kept)) < 100_000
    library_counts = [len(library.encode(runs[0][:i], add_special_tokens=False).ids) for i in range(1, 200)]
    assert table.every_prefix(runs[0][:199]) == library_counts


def test_budgets_from_stored_prefixes(spark):
    df = spark.createDataFrame([([1, 3, 6],), ([],)], "p array<int>")
    got = df.select(tokens.words_in_budget(F.col("p"), 5), tokens.tokens_of_prefix(F.col("p"), 2), tokens.tokens_of_prefix(F.col("p"), 9)).collect()
    assert [tuple(r) for r in got] == [(2, 3, 6), (0, 0, 0)]


# ---- near duplicates


def plain_fingerprint(text):
    words = cases.lowered(text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_near_duplicates_by_brute_force(spark):
    rows = cases.texts()
    prints = [plain_fingerprint(t) for _, t in rows]
    least = defaultdict(list)
    for (i, _), root in zip(rows, plain_components(prints), strict=True):
        least[root] += [] if i is None else [i]
    want = [(i, f"{p:016x}", min(least[r], default=None)) for (i, _), p, r in zip(rows, prints, plain_components(prints), strict=True)]
    found = simhash.near_duplicates(cases.documents(spark))
    assert cases.counted(found.select("doc_id", simhash.hex_digits(F.col("fp")), "component_id").collect()) == cases.counted(want)
    assert found.where("kept").select("component_id").distinct().count() == len({w[2] for w in want})


@pytest.mark.parametrize("chunk", [1 << 14, 40])
def test_links_connect_dense_groups_chains_and_strangers(spark, chunk):
    rng = np.random.default_rng(5)
    flips = lambda x, n: x ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    prints = {int(x) for x in rng.integers(0, 2**64, 150, dtype=np.uint64)}
    centre, link = np.uint64(0xFFFF0000AAAA5555), np.uint64(0x123456789ABCDEF0)
    prints |= {int(flips(centre, 3)) for _ in range(200)}
    for _ in range(30):
        prints.add(int(link := flips(link, 4)))
    prints = sorted(prints)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    roots = {r.u: r.root for r in graph.component_roots(simhash.near_links(df, chunk=chunk)).collect()}
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    group = defaultdict(set)
    for p, r in zip(signed, plain_components(prints), strict=True):
        group[r].add(p)
    assert all(len({roots.get(p, p) for p in g}) == 1 for g in group.values())
    assert len({roots.get(p, p) for p in signed}) == len(group)


# ---- languages


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = queries.QUERIES["op5_language_id"](spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert right[0] >= 0.95 and right[1] > 20


def test_languages_of_awkward_texts(spark):
    got = langid.identify(cases.documents(spark)).select("doc_id", "text", "lang_pred", "score", "rejected", "held_out", "key").collect()
    assert len(got) == len(cases.texts())
    assert all((r.lang_pred, r.score, r.rejected) == ("und", 0.0, True) for r in got if not any(c.isalpha() for c in r.text or ""))
    assert all(0 <= r.score <= 1 for r in got)
    unlabelled = cases.documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def planted(spark):
    """120 texts of two languages, 20 of them of a rare one, then 20 unlabelled ones of letters that none of them has."""
    rng = random.Random(4)
    words = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 6))) for _ in range(30))
    rows = [(i, words("abcde"), "aa") for i in range(100)] + [(i, words("mnopq"), "mm") for i in range(100, 120)]
    return spark.createDataFrame([*rows, *((i, words("αβγδεζηθικλ"), None) for i in range(120, 140))], "doc_id long, text string, lang string")


def test_small_tables_reject_an_unlearned_language(spark):
    got = langid.identify(planted(spark)).collect()
    assert {r.rejected for r in got if r.lang is None} == {True}
    assert {(r.lang, r.rejected) for r in got if r.lang} == {("aa", False), ("mm", False)}


def test_limits_of_thin_bins_are_pooled():
    counts = {("en", 0): (99, 3.0), ("en", 1): (100, 2.0), ("en", None): (199, 2.5), ("fr", 1): (4, 1.0), ("fr", None): (4, 1.0), (None, None): (203, 2.4)}
    assert [langid.limit_of(counts, *key) for key in (("en", 0), ("en", 1), ("en", 2), ("fr", 0), ("de", 0))] == [3.0, 2.0, 2.5, 2.4, 2.4]
    assert langid.limit_of({}, "en", 0) is None


def test_a_gram_that_was_not_learned_is_not_found(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5))
    learned = sorted({word() for _ in range(8_000)})
    docs = spark.createDataFrame([("en", " ".join(learned[::2])), ("fr", " ".join(learned[1::2]))], "lang string, text string")
    model, others = langid.fit(docs), sorted({word() for _ in range(30_000)} - set(learned))
    hashes = lambda words: langid.run_hashes(langid._codes("".join(words)), 5)[4::5]
    assert np.isnan(model.look(model.probabilities[4], hashes(others))).all()
    found = ~np.isnan(model.look(model.probabilities[4], hashes(learned)))
    assert (found == np.array([[i % 2 == 0, i % 2 == 1] for i in range(len(learned))])).all()


def test_a_model_too_large_to_broadcast_gives_the_same(spark, monkeypatch):
    rows = [(r.doc_id, r.text, r.lang) for r in planted(spark).collect()] + [(200, None, "aa"), (201, "12 !", None), (None, "abc İß x", None), (None, "abc İß x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    order = lambda rows: sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id))
    want = order(langid.identify(docs).collect())
    monkeypatch.setattr(langid, "BROADCAST_BYTES", 0)
    assert isinstance(langid.fit(docs), langid.Tables)
    got = order(langid.identify(docs).collect())
    same = lambda r: (r.doc_id, r.text, r.lang, r.held_out, r.lang_pred, r.rejected)
    assert list(map(same, got)) == list(map(same, want))
    assert [(r.score, r.entropy or 0) for r in got] == [pytest.approx((r.score, r.entropy or 0), rel=1e-4) for r in want]


def test_probabilities_after_a_context_sum_to_one(spark):
    docs = spark.createDataFrame([("en", "the then there than that this those"), ("fr", "le la les")], "lang string, text string")
    for k, table in enumerate(langid.kneser_ney(langid.gram_counts(docs)), 1):
        left = F.first("gamma") if k == 1 else F.lit(0.0)
        sums = table.groupBy("lang", "context").agg((F.sum("p") + left * 0).alias("p")).collect()
        assert all(0 < r.p <= 1 + 1e-9 for r in sums)


# ---- fingerprints beside the next document


def test_edits_and_likeness_by_brute_force(spark):
    rows = [(i, t) for i, t in cases.texts() if i is not None and i != 6]
    ordered = sorted(rows, reverse=True)
    docs = cases.documents(spark, rows)
    anchors = frozenset(spots.common_words(docs))
    got = {r.doc_id: r for r in spots.spot_fingerprints(docs).collect()}
    for (i, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, changed, after = (set(spots.signatures(t, anchors).tolist()) for t in (text, edited, following))
        like = lambda a, b: len(a & b) / len(a | b) if a and b else float(len(a) == len(b))
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.near_edited, r.near_next) == pytest.approx((like(own, changed), like(own, after)))
    assert len(got) == len(rows)


def test_repeated_rows_and_null_ids_stand_beside_each_other(spark):
    found = spots.spot_fingerprints(cases.documents(spark)).collect()
    assert len(found) == len(cases.texts())
    prints = defaultdict(set)
    for r in found:
        prints[r.doc_id].add(r.fingerprint)
    assert prints[4] == prints[6] and len(prints[6]) == 1 and prints[4] <= prints[None]


def test_signatures_follow_common_words():
    anchors = frozenset({b"the", b"of"})
    digest = lambda *words: xxhash.xxh64_intdigest(" ".join(words).encode())
    got = set(spots.signatures("The cat of the hat sat down", anchors).tolist())
    assert got == {digest("the", "cat", "hat", "sat"), digest("of", "hat", "sat", "down"), digest("the", "hat", "sat", "down")}
    assert len(spots.signatures("no anchor here", anchors)) == 1 and not len(spots.signatures("", anchors))


def test_a_minority_language_has_its_own_anchors(spark):
    rows = [(i, " ".join(f"en{k}" for k in range(80)) + f" only{i}", "en") for i in range(20)]
    rows += [(i, f"y de y la y que cosa{i} otra{i} mas{i}", "es") for i in range(20, 23)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {b"y", b"de", b"la", b"que", b"en0"} <= set(spots.common_words(docs))
    assert len(spots.common_words(docs.drop("lang"))) == spots.ANCHORS


def test_text_without_anchors_is_not_left_out():
    anchors, line = frozenset({b"the", b"of"}), "under the terms of licence"
    one, two = (f"{line} " + " ".join(f"{kind}{i}" for i in range(200)) for kind in ("palabra", "mot"))
    found = [spots.signatures(t, anchors) for t in (one, two, f"{one} fin")]
    assert len(found[0]) > 150 and spots.digest_of(found[0]) != spots.digest_of(found[1])
    assert spots.likeness(found[0], found[1]) < 0.1 and spots.likeness(found[0], found[2]) > 0.9


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_similar_sets_by_brute_force(spark, threshold):
    rng = random.Random(5)
    base = [[rng.choice(["the", "of", "and", *(f"w{k}" for k in range(400))]) for _ in range(rng.randrange(3, 300))] for _ in range(12)]
    texts = [(i, t) for i, t in cases.texts() if len(t or "") < 50_000]
    for words in base:
        for cut in (0, 1, 2, 5, 20):
            kept = words[: len(words) - cut] + [f"new{rng.randrange(9)}" for _ in range(cut // 2)]
            texts.append((len(texts) + 1000, "the shared line of all documents here " + " ".join(kept)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    members, pairs = spots.similar_sets(docs, threshold)
    anchors = frozenset(spots.common_words(docs))
    sets = {spots.digest_of(f): f for f in (spots.signatures(t or "", anchors) for _, t in texts)}
    want = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        like = spots.likeness(sets[a], sets[b]) if len(sets[a]) and len(sets[b]) else 0.0
        if like >= threshold:
            want[a, b] = like
    got = {tuple(sorted((r.one, r.other))): r.likeness for r in pairs.collect()}
    assert got == pytest.approx(want) and len(want) > 20 and pairs.count() == len(want)
    links = defaultdict(int)
    for pair in want:
        for f in pair:
            links[f] += 1
    rows = [(i, spots.digest_of(spots.signatures(t or "", anchors))) for i, t in texts]
    assert cases.counted(members.select("doc_id", "fingerprint", "n_links").collect()) == cases.counted([(i, f, links[f]) for i, f in rows])
    nothing = spots.similar_sets(docs.where("false"))
    assert [df.count() for df in nothing] == [0, 0]


# ---- passages


@pytest.mark.parametrize("length", [50, 30])
def test_passages_by_brute_force(spark, length):
    rows = cases.texts()
    split = [tuple(cases.lowered(t).encode().translate(suffixes.KEPT).split()) for _, t in rows]
    holders = defaultdict(set)
    for row, words in zip(rows, split, strict=True):
        for i in range(len(words) - length + 1):
            holders[words[i : i + length]].add(row)
    want = set()
    for row, words in zip(rows, split, strict=True):
        last = None
        for i in range(len(words) - length + 1):
            if len(holders[words[i : i + length]]) > 1:
                if last and i <= last[2]:
                    last = (row[0], last[1], i + length)
                else:
                    want |= {last} if last else set()
                    last = (row[0], i, i + length)
        want |= {last} if last else set()
    got = suffixes.repeated_passages(cases.documents(spark), length).collect()
    assert cases.counted(got) == cases.counted(want)


# ---- rates


def test_rates_meet_the_targets(spark, sf_dir):
    tables = sf_dir.replace("sf0.001", "sf0.01")  # enough labels for targets that can be met
    docs, labels = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "labels"))
    found = mixing.mixed(docs, labels)
    assert found.count() == docs.count() and found.where("rate < 0 OR rate IS NULL").count() == 0
    tokens_all = found.agg(F.sum("n_tokens")).first()[0]
    totals = found.agg(*[F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")) for d in mixing.DOMAINS]).first()
    assert [t / tokens_all for t in totals] == pytest.approx([mixing.TARGETS[d] for d in mixing.DOMAINS], abs=1e-3)


def test_rates_are_least_squares_under_the_bound(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3, 0.3, 0.3], 60)
    n = rng.integers(1, 50, 60)
    df = spark.createDataFrame([(int(t), *map(float, q)) for t, q in zip(n, p, strict=True)], "n_tokens long, " + ", ".join(f"p_{d} double" for d in mixing.DOMAINS))
    for goal in ([0.8, 0.15, 0.05], [0.98, 0.01, 0.01]):
        rates, _ = mixing.fitted_rates(df, dict(zip(mixing.DOMAINS, goal, strict=True)))
        got = np.array([r.rate for r in rates.collect()])
        goals = np.array(goal) * n.sum()
        loss = lambda r: float((((r * n) @ p / goals - 1) ** 2).sum())
        r = np.ones(60)
        for _ in range(200_000 if goal[0] > 0.9 else 20_000):
            r = np.maximum(0, r - 20 * p @ (((r * n) @ p / goals - 1) / goals))
        assert (got >= 0).all() and loss(got) <= loss(r) + 1e-3


def test_rates_of_awkward_rows(spark):
    labels = spark.createDataFrame([(4, 1, 0), (13, 0, 0), (16, 1, 1), (16, 1, 0), (None, 1, 0), (9, None, None)], "doc_id long, quality int, toxic int")
    got = mixing.mixed(cases.documents(spark), labels).collect()
    assert len(got) == len(cases.texts()) and all(r.rate >= 0 for r in got)
    assert all(r.n_tokens == len((dict(cases.texts())[r.doc_id] or "").split()) for r in got if r.doc_id not in (None, 17))
    even = mixing.mixed(cases.documents(spark), labels.where("false")).collect()
    assert all(r.p_plain == pytest.approx(1 / 3) for r in even)


def test_empty_tables(spark):
    docs = cases.documents(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for found in (
        tokens.token_prefixes(docs, VOCABULARY), simhash.near_duplicates(docs), langid.identify(docs), spots.spot_fingerprints(docs),
        suffixes.repeated_passages(docs), mixing.mixed(docs, labels),
    ):
        assert found.count() == 0
