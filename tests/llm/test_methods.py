"""Methods against plain versions: dense secrets, path trees, Kneser-Ney models, targets that cannot be met."""

from __future__ import annotations

import math
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleaner.llm import common, langid, mixing, secrets, simhash, urlpaths

# ---- secrets in dense texts -----------------------------------------------------------------------


def plain_redacted(text, spans, mark="[SECRET]"):
    out, at = [], 0
    for k, (start, _, stop) in enumerate(spans):
        if k == 0 or start > at:
            out += [text[at:start], mark]
        at = max(at, stop)
    return "".join(out) + text[at:]


def test_a_text_of_many_secrets_takes_seconds(spark):
    keys = 200_000
    text = " ".join(f"{i:032x}" for i in range(keys))
    docs = cases.documents(spark, [(1, text), (2, "short 0123456789abcdef0123456789abcdef")])
    start = time.time()
    found = {r.doc_id: r for r in secrets.secret_spans(docs).select("doc_id", F.size("base_spans").alias("n"), F.element_at("base_spans", -1).alias("last")).collect()}
    assert (found[1].n, found[1].last.start, found[1].last.stop) == (keys, 33 * (keys - 1), 33 * keys - 1) and found[2].n == 1
    spans = F.transform(F.sequence(F.lit(0), F.lit(keys - 1)), lambda i: F.struct((i * 33).alias("start"), F.lit(2).alias("kind"), (i * 33 + 32).alias("stop")))
    redacted = docs.where("doc_id = 1").select(secrets.redacted(F.col("text"), spans).alias("t")).select(F.length("t").alias("n"), F.left("t", F.lit(17)).alias("head")).first()
    assert (redacted.n, redacted.head) == (9 * keys - 1, "[SECRET] [SECRET]")
    assert time.time() - start < 400


def test_many_parts_beside_strong_spans(spark):
    line = 'password = abcdefgh12 pwd: hunter2 user=bob\n'
    found = secrets.secret_spans(cases.documents(spark, [(1, line * 20_000)])).select(*[secrets.of_kind(F.col("all_spans"), k).alias(k) for k in ("assign", "weak_secret", "identifier")]).first()
    assert tuple(found) == (20_000, 20_000, 20_000)


def test_redaction_equals_a_plain_version(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(60):
        text = "".join(rng.choice("abc dé日👍") for _ in range(rng.randrange(0, 400)))
        spans = sorted((a := rng.randrange(0, len(text)), rng.randrange(3), min(len(text), a + rng.randrange(1, 9))) for _ in range(rng.randrange(0, 60)) if text)
        rows.append((text, spans))
    docs = spark.createDataFrame(rows, f"text string, spans {secrets.SPAN}")
    got = docs.select("text", "spans", secrets.redacted(F.col("text"), F.col("spans")).alias("r")).collect()
    assert all(r.r == plain_redacted(r.text, [tuple(s) for s in r.spans]) for r in got)


@pytest.mark.parametrize("size", [0, 1, 15, 16, 17, 300])
def test_folds_of_earlier_elements(spark, size):
    values = [random.Random(size).randrange(100) for _ in range(size)]
    row = spark.createDataFrame([(values,)], "v array<int>").select(secrets.before(F.col("v"), lambda a, b: a + b), secrets.before(F.col("v"), lambda a, b: F.greatest(a, b))).first()
    assert row[0] == [sum(values[:i]) for i in range(size)] and row[1] == [max(values[:i], default=0) for i in range(size)]


# ---- path templates -------------------------------------------------------------------------------


def plain_templates(paths, least):
    """Template and parent of each (host, path), by a walk down each host's tree."""

    def kind(segment):
        ending = re.search(r"(\.[A-Za-z0-9]{1,5})$", segment)
        ending = ending[1] if ending else ""
        stem = segment[: len(segment) - len(ending)]
        return ("{n}" if re.fullmatch("[0-9]+", stem) else "" if segment == "" else "{s}") + ending

    out, open_ = {}, {(h, p): (p[1:].split("/"), "", "") for h, p in paths}
    level = 0
    while open_:
        pages = Counter()
        for (h, p), (rest, _, template) in open_.items():
            if level < len(rest):
                pages[h, template, rest[level]] += paths[h, p]
        for (h, p), (rest, parent, template) in list(open_.items()):
            if level == len(rest):
                out[h, p] = (parent, template)
                del open_[h, p]
            else:
                name = rest[level] if pages[h, template, rest[level]] >= least else kind(rest[level])
                open_[h, p] = (rest, template, f"{template}/{name}")
        level += 1
    return out


def test_templates_equal_a_plain_walk(spark):
    rng = random.Random(9)
    paths = Counter()
    for i in range(600):
        segments = [rng.choice(["a", "b", "", f"{i}", f"x{i}.html", "c.html", "7"]) for _ in range(rng.randrange(0, 9))]
        paths[f"h{rng.randrange(3)}", "/" + "/".join(segments) if rng.random() < 0.95 else ""] += rng.randrange(1, 4)
    rows = [(h, p, n, 0, 0) for (h, p), n in paths.items()]
    tree = urlpaths.path_templates(spark.createDataFrame(rows, "host string, path string, n long, blocked long, allowed long"), least=8)
    assert {(r.host, r.path): (r.parent, r.template) for r in tree.collect()} == plain_templates(paths, 8)


def test_sections_are_judged_apart_however_many_there_are(spark):
    url = lambda s, i: f"http://big.org/{'es' if s == 7 else f'sec{s}'}/a/b/c/d/e/item{i}"  # noqa: E731  eight segments and more
    rows = [(s * 100 + i, url(s, i)) for s in range(30) for i in range(12)] + [(5000 + i, f"http://big.org/sec1/u{i}/{i}") for i in range(40)]
    got = {r.page_id: r for r in urlpaths.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert len(got) == len(rows)
    assert {(r.verdict, r.template) for r in got.values() if r.rule == "org/es/"} == {("block", "/es/a/b/c/d/e/{s}")}
    assert {r.verdict for r in got.values() if r.rule is None} == {"allow"}
    assert {r.template for i, r in got.items() if i >= 5000} == {"/sec1/{s}/{n}"}


def test_a_section_with_a_small_share_blocks_no_other(spark):
    rows = [(i, f"http://x.org/es/p{i}/q") for i in range(20)] + [(100 + i, f"http://x.org/s{i % 40}/p{i}/q") for i in range(400)]
    got = urlpaths.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert {r.verdict for r in got if r.page_id >= 100} == {"allow"}


# ---- language models ------------------------------------------------------------------------------


def plain_models(docs):
    """Interpolated Kneser-Ney by dictionaries: probability of a character after a context, for each language."""
    counts = defaultdict(Counter)
    for lang, text in docs:
        for word in langid.words_of(text):
            padded = langid.START * (langid.ORDER - 1) + word + langid.STOP
            for i in range(len(padded) - langid.ORDER + 1):
                counts[lang][padded[i : i + langid.ORDER]] += 1
    models = {}
    for lang, top in counts.items():
        orders = {langid.ORDER: top}
        for k in range(langid.ORDER - 1, 0, -1):
            orders[k] = Counter(g[1:] for g in orders[k + 1])
        tables = {}
        for k, grams in orders.items():
            ones, twos = (sum(c == n for c in grams.values()) for n in (1, 2))
            discount = min(0.95, max(0.1, ones / (ones + 2 * twos) if ones + 2 * twos else 0.5))
            total, kinds = Counter(), Counter()
            for g, c in grams.items():
                total[g[:-1]] += c
                kinds[g[:-1]] += 1
            tables[k] = (grams, discount, total, kinds)
        models[lang] = tables
    return models


def plain_log(tables, gram, k=langid.ORDER):
    """The log-probability of a gram's last character: seen grams as learned, others by what contexts leave to lower orders."""
    if k == 0:
        return langid.UNKNOWN
    gram = gram[-k:]
    grams, discount, total, kinds = tables[k]
    context = gram[:-1]
    if gram in grams:
        return math.log(plain_probability(tables, gram, k))
    return (math.log(discount * kinds[context] / total[context]) if context in total else 0.0) + plain_log(tables, gram, k - 1)


def plain_probability(tables, gram, k):
    grams, discount, total, kinds = tables[k]
    context = gram[:-1]
    lower = 1 / (kinds[""] + 1) if k == 1 else plain_probability(tables, gram[1:], k - 1)
    return max(grams[gram] - discount, 0) / total[context] + discount * kinds[context] / total[context] * lower


def plain_identify(rows, quantile=0.999, slack=1.25):
    """(lang_pred, entropy, rejected) of each (doc_id, text, lang)."""
    fold = lambda i: 0 if i is None else zlib.crc32(str(i).encode()) % 4
    models = plain_models([(lang, t) for i, t, lang in rows if lang is not None and t is not None and fold(i) < 2])
    judged = []
    for _, text, _ in rows:
        words = langid.words_of(text or "")
        padded = [langid.START * (langid.ORDER - 1) + w + langid.STOP for w in words]
        places = [p[i : i + langid.ORDER] for p in padded for i in range(len(p) - langid.ORDER + 1)]
        if not places or not models or not any(c.isalpha() for c in text):
            judged.append(("und", None, len(places)))
            continue
        sums = {lang: sum(plain_log(t, g) for g in places) for lang, t in models.items()}
        best = max(sorted(sums), key=sums.get)
        judged.append((best, -sums[best] / len(places), len(places)))
    bins = lambda n: sum(n >= b for b in langid.LENGTH_BINS)
    pools = defaultdict(list)
    for (i, text, lang), (pred, entropy, n) in zip(rows, judged, strict=True):
        if lang is not None and text is not None and fold(i) == 3 and pred != "und":
            for key in ((pred, bins(n)), (pred, None), (None, None)):
                pools[key].append(entropy)
    counts = {key: (len(v), sorted(v)[math.ceil(quantile * len(v)) - 1] * slack) for key, v in pools.items()}
    out = []
    for pred, entropy, n in judged:
        limit = langid.limit_of(counts, pred, bins(n))
        out.append((pred, entropy, pred == "und" or limit is not None and entropy > limit))
    return out


def awkward_rows():
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randrange(1, 7)))
    rows = [(i, " ".join(word("abcde") for _ in range(rng.randrange(1, 40))), "aa") for i in range(60)]
    rows += [(i, " ".join(word("cdefg") for _ in range(rng.randrange(1, 40))), "cc") for i in range(60, 110)]
    rows += [(200 + k, t, None) for k, (_, t) in enumerate(cases.texts())] + [(None, "abc", "aa"), (None, None, "cc"), (300, "", "aa")]
    return rows


@pytest.mark.parametrize("budget", [langid.BROADCAST_BYTES, 0])
def test_languages_equal_plain_kneser_ney(spark, monkeypatch, budget):
    monkeypatch.setattr(langid, "BROADCAST_BYTES", budget)
    rows = awkward_rows()
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, lang string, k int").repartition(3)
    got = {r.k: r for r in langid.identify(docs, keep_text=False).collect()}
    want = plain_identify(rows)
    assert len(got) == len(rows)
    for k, (pred, entropy, rejected) in enumerate(want):
        assert (got[k].lang_pred, got[k].rejected) == (pred, rejected), rows[k]
        assert got[k].entropy == (None if entropy is None else pytest.approx(entropy, rel=1e-5))


# ---- targets --------------------------------------------------------------------------------------


def test_a_target_that_cannot_be_met_is_told(spark):
    docs = spark.createDataFrame([(i, "good plain words here") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    far = {"plain": 0.0, "low": 0.0, "toxic": 1.0}
    row = mixing.mixed(docs, labels, far).first()
    assert abs(row.error_toxic) > 0.1
    with pytest.raises(ValueError, match="miss their targets"):
        mixing.mixed(docs, labels, far, tolerance=0.01)


def test_every_telling_term_of_the_sample_counts(spark):
    """More terms than any fixed table: each tells its domain, and texts of terms seen in few documents are told apart."""
    rows = [(i, " ".join(f"{'ab'[i % 2]}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(k % 4, 600, 4)), i % 2) for i, k in ((i, i // 2) for i in range(640))]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int")
    weights, _ = mixing.fit_terms(docs, labels)
    assert weights.count() == 1200


# ---- memory of a batch of fingerprints ------------------------------------------------------------


def test_fingerprints_make_no_copy_of_a_whole_batch():
    texts = [f"Word{i} and {i % 7} more\twords " * 100 for i in range(500)] + [None, "", " \n"]
    column = pa.array(texts)
    tracemalloc.start()
    got = simhash.column_fingerprints(column, 4, 42).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [simhash.fingerprint(t and t.encode(), 4, 42) for t in texts] and got[-3:] == [0, 0, 0]
    assert peak < column.nbytes / 4


# ---- memory of workers between operators ------------------------------------------------------------


def test_workers_keep_word_scores_for_language_id_only(spark):
    def sizes_kept(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(common._KEPT)] * batch.num_rows, pa.int64())], names=["n"])

    docs = spark.createDataFrame([(i, ["the cat sat", "le chat noir"][i % 2], ["en", "fr"][i % 2]) for i in range(40)], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    tasks = spark.range(0, 64, 1, 32)
    scored = langid.predict(tasks.select(F.col("id").alias("doc_id"), F.lit("the cat").alias("text")), model)
    assert scored.where("lang_pred = 'en'").count() == 64
    own = common.map_batches(tasks, sizes_kept, "n long", keeps=model.key)
    assert own.agg(F.max("n")).first()[0] == 1
    assert common.map_batches(tasks, sizes_kept, "n long").agg(F.max("n")).first()[0] == 0


def test_words_are_scored_in_blocks():
    rng, langs = np.random.default_rng(1), ["a", "b", "c"]
    words = ["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(1, 12, 60_000)] + ["x" * (langid.BLOCK + 5), "end"]

    def table(k):
        codes = langid._codes("".join(w.rjust(5, langid.START)[-k:] for w in words[::3])) if k else np.zeros(1, np.uint64)
        keys = np.unique(langid.run_hashes(codes, k)[k - 1 :: k] if k else langid.run_hashes(codes, 0))
        return keys, -rng.random((len(keys), len(langs)), dtype=np.float32)

    model = langid.Model(langs, [table(k) for k in range(1, 6)], [table(k) for k in range(5)])
    tracemalloc.start()
    got = model.word_scores(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.shape == (len(words), len(langs))
    some = [0, 1, 17, 9_361, 9_362, 30_000, 59_999, 60_000, 60_001]
    assert (got[some] == np.concatenate([model.word_scores([words[i]]) for i in some])).all()
    assert peak < 20 * 8 * langid.BLOCK * (2 + len(langs))


def test_remembered_words_keep_their_scores_as_more_come():
    model = langid.Scored(["a", "b"], {f"{chr(97 + i % 26)}{'x' * (i // 26)}": [float(-i), float(-2 * i)] for i in range(260)})
    words, kept = list(model.rows), langid._Scores(model)
    for at in range(0, 260, 13):
        texts = [words[: at + 13], [], [words[at], "9", words[0]]]
        want = [[sum(model.rows[w][i] for w in t if w in model.rows) for i in (0, 1)] + [sum(len(w) + 1 for w in t if w in model.rows)] for t in texts]
        assert kept.totals(texts).tolist() == want


def test_a_word_is_looked_up_once_for_all_its_places():
    class Counted(langid._Scores):
        asked = 0

        def __contains__(self, word):
            self.asked += 1
            return super().__contains__(word)

        def __getitem__(self, word):
            self.asked += 1
            return super().__getitem__(word)

    kept = Counted(langid.Scored(["a", "b"], {w: [-1.0, -2.0] for w in ("the", "cat", "sat")}))
    assert kept.totals([["the", "cat", "sat"] * 1000, ["cat"] * 500]).tolist() == [[-3000.0, -6000.0, 12000.0], [-500.0, -1000.0, 2000.0]]
    assert kept.asked <= 6


def test_hashes_are_found_from_their_highest_bits():
    rng, top = np.random.default_rng(2), 2**64 - 1
    some = rng.integers(0, top, 5_000, np.uint64, endpoint=True)
    crowded = np.arange(2_000, dtype=np.uint64) + np.uint64(1 << 63)
    for keys in (np.unique(np.r_[some, crowded, np.uint64(0), np.uint64(top)]), np.unique(some), np.array([7], np.uint64), np.array([], np.uint64)):
        rows = rng.random((len(keys), 2), dtype=np.float32)
        rows[::3, 0] = np.nan
        model = langid.Model(["a", "b"], [(keys, rows)], [(keys, rows)])
        asked = np.r_[keys, keys + np.uint64(1), keys - np.uint64(1), np.array([0, 1, top - 1, top], np.uint64)]
        known = {int(k): r for k, r in zip(keys, rows, strict=True)}
        want = np.array([known.get(int(h), [np.nan] * 2) for h in asked], np.float32)
        assert np.array_equal(model.look(model.probabilities[0], asked), want, equal_nan=True)
        assert np.array_equal(model.look(model.shares[0], asked), np.nan_to_num(want))


def test_words_between_other_blanks_and_marks_are_told_apart():
    texts = ["ΑΣ\u2003ΣΑΣ ΑΣ,ΑΣΑ", "İß\x1fx\x85y\u00a0z\n\nİß", " a1b_c\td\r\n", "", "12 !", "ΑΣ"]
    words = sorted({w for t in texts for w in langid.words_of(t)})
    model = langid.Scored(["a", "b"], {w: [-1.0 - i, -0.5 * i] for i, w in enumerate(words)})
    want = []
    for text in texts:
        found = langid.words_of(text)
        sums = [sum(model.rows[w][i] for w in found) for i in (0, 1)]
        letters = sum(len(w) + 1 for w in found)
        want.append(("ab"[sums.index(max(sums))], -max(sums) / letters, letters) if letters else ("und", None, 0))
    got = langid._judged(langid._Scores(model), texts)
    assert [(lang, entropy, letters) for lang, _, entropy, letters in got] == want
