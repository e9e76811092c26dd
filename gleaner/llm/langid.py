"""Language identification by interpolated Kneser-Ney character models, one for each language."""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import Batches, kept, map_batches, staged

ORDER = 5
#: Marks before and after each word; a word's letters are scored with the marks as their context.
START, STOP = "\x02", "\x03"
LETTERS = re.compile(r"[^\W\d_]+")
#: Words and line ends: what stands in one line of many is told apart by these.
LINES = re.compile(r"[^\W\d_]+|\n")
#: A model of at most so many bytes is broadcast; a larger one stays in tables and is joined to the words' grams.
BROADCAST_BYTES = 1 << 27
#: Log-probability of a letter that no order knows.
UNKNOWN = math.log(1e-4)
#: Distinct words between blanks that a worker counts or remembers before it starts anew, and words of texts judged at once.
REMEMBERED, PIECE = 1 << 20, 1 << 18
#: Letters and word ends that a model scores at once.
BLOCK = 1 << 16
#: Texts with fewer letters than a bin's bound fall in it; a bin with fewer calibration documents is pooled.
LENGTH_BINS, LEAST_CALIBRATION = [60, 250, 1000], 100
#: Columns that ``identify`` adds, in place of any that ``docs`` has by these names.
ADDED = ["held_out", "lang_pred", "score", "entropy", "letters", "rejected", "_text"]
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def held_out() -> Column:
    """The fold that nothing is learned from: crc32 of the id's digits leaves 2 modulo 4. A null id is not in it."""
    return _fold() == 2


def _fold() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % 4


def words_of(chunk: str) -> list[str]:
    return LETTERS.findall(chunk.lower())


# ---- learning -----------------------------------------------------------------------------------


def gram_counts(docs: DataFrame) -> DataFrame:
    """``(lang, gram, n)``: counts of all character n-grams of the highest order, over every given document."""

    def run(batches: Batches) -> Batches:
        def flush(counts: dict[str, Counter]) -> pa.RecordBatch:
            rows = []
            for lang, chunks in counts.items():
                grams: Counter = Counter()
                for chunk, n in chunks.items():
                    for word in words_of(chunk):
                        padded = START * (ORDER - 1) + word + STOP
                        for i in range(len(padded) - ORDER + 1):
                            grams[padded[i : i + ORDER]] += n
                rows += [(lang, gram, n) for gram, n in grams.items()]
            columns = zip(*rows, strict=True) if rows else [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], names=["lang", "gram", "n"])

        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts.setdefault(lang, Counter()).update(text.as_py().split())
                if sum(map(len, counts.values())) > REMEMBERED // 2:
                    yield flush(counts)
                    counts = {}
        yield flush(counts)

    counted = map_batches(docs.select("lang", "text"), run, "lang string, gram string, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(grams: DataFrame) -> list[DataFrame]:
    """For each order 1 to ORDER, ``(lang, gram, p, context, gamma)``.

    ``p`` is the interpolated probability of the gram's last character after the others; ``gamma`` the share that
    its context leaves to the next lower order. Lower orders count distinct left neighbours.
    """
    counts = {ORDER: grams.select("lang", "gram", F.col("n").alias("c"))}
    for k in range(ORDER - 1, 0, -1):
        counts[k] = counts[k + 1].groupBy("lang", F.expr(f"substring(gram, 2, {k})").alias("gram")).agg(F.count("*").alias("c"))
    out: list[DataFrame] = []
    for k in range(1, ORDER + 1):
        own = counts[k].withColumn("context", F.expr(f"substring(gram, 1, {k - 1})"))
        ones, twos = F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)
        discount = own.groupBy("lang").agg(F.greatest(F.lit(0.1), F.least(F.lit(0.95), F.coalesce(F.try_divide(ones, ones + 2 * twos), F.lit(0.5)))).alias("d"))
        contexts = own.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.count("*").alias("kinds"))
        seen = own.join(contexts, ["lang", "context"]).join(discount, "lang").withColumn("gamma", F.col("d") * F.col("kinds") / F.col("total"))
        if k == 1:
            lower, seen = 1 / (F.col("kinds") + 1), seen
        else:
            seen = seen.withColumn("suffix", F.expr(f"substring(gram, 2, {k - 1})")).join(out[-1].select("lang", F.col("gram").alias("suffix"), F.col("p").alias("q")), ["lang", "suffix"])
            lower = F.col("q")
        p = F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col("gamma") * lower
        out.append(staged(seen.select("lang", "gram", p.alias("p"), "context", "gamma"), f"lm{k}"))
    return out


def run_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` characters that end at each place; places with fewer before them get any value."""
    out = np.zeros(len(codes), np.uint64)
    for i in range(size - 1, -1, -1):
        out = out * BASE + (np.r_[np.zeros(i, np.uint64), codes[: len(codes) - i]] + np.uint64(1))
    out ^= out >> np.uint64(32)
    out *= MIX
    return out ^ (out >> np.uint64(29))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


class Grams(NamedTuple):
    """Sorted hashes with a last one above all, a row for each, and the place where each run of equal highest bits begins."""

    keys: np.ndarray
    rows: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, rows: np.ndarray, missing: float) -> Grams:
        """``missing`` is in place of NaN, and a whole row of it is last: the row of a hash that is not there."""
        bits = max(1, len(keys).bit_length())
        first = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int32)
        filled = np.vstack([np.where(np.isnan(rows), np.float32(missing), rows), np.full((1, rows.shape[1]), missing)]).astype(np.float32)
        return cls(np.r_[keys, np.uint64(2**64 - 1)], filled, first)


@dataclass
class Model:
    """Sorted 64-bit hashes of the grams of each order, with one row of logarithms for each: a column for each language."""

    langs: list[str]
    probabilities: list[tuple[np.ndarray, np.ndarray]]
    shares: list[tuple[np.ndarray, np.ndarray]]
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def __post_init__(self) -> None:
        self.probabilities = [Grams.of(*table, np.nan) for table in self.probabilities]
        self.shares = [Grams.of(*table, 0.0) for table in self.shares]

    def look(self, table: Grams, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash. Hashes are spread evenly, so few steps lead from where its highest bits begin to its place."""
        keys, rows, first = table
        at = first.take((hashes >> np.uint64(65 - len(first).bit_length())).view(np.int64)).astype(np.intp)
        late = np.flatnonzero(keys.take(at) < hashes)
        while len(late):
            at[late] += 1
            late = late[keys.take(at[late]) < hashes[late]]
        at[keys.take(at) != hashes] = len(rows) - 1
        return rows.take(at, axis=0)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """The log-probability of each word, its end included: a row for each word. Words go in blocks, each with its own hashes."""
        block = np.cumsum([len(w) + 1 for w in words]) // BLOCK
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(words)]
        return np.concatenate([self._block_scores(words[a:b]) for a, b in pairwise(cuts)])

    def _block_scores(self, words: list[str]) -> np.ndarray:
        pad = START * (ORDER - 1)
        codes = _codes("".join(pad + w + STOP for w in words))
        lengths = np.array([len(w) + 1 for w in words])
        ends = np.cumsum(lengths + ORDER - 1)
        scored = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(ends - lengths, lengths)
        score = np.full((len(scored), len(self.langs)), UNKNOWN)
        below = run_hashes(codes, 0)
        for k in range(1, ORDER + 1):
            score += self.look(self.shares[k - 1], below[scored - 1])
            below = run_hashes(codes, k)
            found = self.look(self.probabilities[k - 1], below[scored])
            np.copyto(score, found, where=~np.isnan(found))
        return np.add.reduceat(score, np.cumsum(lengths) - lengths, axis=0)


@dataclass
class Tables:
    """A model too large to broadcast: what ``kneser_ney`` returns, and the languages in order."""

    langs: list[str]
    orders: list[DataFrame]


def fit(docs: DataFrame) -> Model | Tables:
    """Models of all languages from all given labelled documents.

    Counts are distributed. Every gram keeps its own probability: a model of at most BROADCAST_BYTES comes to the driver
    by 64-bit hashes of the grams, a larger one stays in tables. Both give the same scores.
    """
    grams = staged(gram_counts(docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string"), F.col("text").cast("string"))), "grams")
    langs = sorted(r[0] for r in grams.select("lang").distinct().collect())  # one short row for each language
    orders = kneser_ney(grams)
    if 2 * sum(table.count() for table in orders) * (8 + 4 * len(langs)) > BROADCAST_BYTES:
        return Tables(langs, orders)
    probabilities, shares = [], []
    for k, table in enumerate(orders, 1):

        def hashed(source: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
            def run(batches: Batches) -> Batches:
                for batch in batches:
                    texts = batch.column("g").to_pylist()
                    codes = _codes("".join(texts)) if size else np.array([], np.uint64)
                    ends = np.arange(1, len(texts) + 1) * size - 1
                    hashes = run_hashes(codes, size)[ends] if size and texts else run_hashes(np.zeros(len(texts), np.uint64), 0)
                    yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(hashes.view(np.int64)), batch.column("v")], names=["lang", "hash", "v"])

            got = map_batches(source, run, "lang string, hash long, v double").toArrow()
            hashes, lang = got.column("hash").to_numpy().view(np.uint64), np.searchsorted(langs, got.column("lang").to_pylist()) if got.num_rows else np.array([], int)
            keys, at = np.unique(hashes, return_inverse=True)
            rows = np.full((len(keys), len(langs)), np.nan, np.float32)
            rows[at, lang] = np.log(got.column("v").to_numpy())
            return keys, rows

        probabilities.append(hashed(table.select("lang", F.col("gram").alias("g"), F.col("p").alias("v")), k))
        shares.append(hashed(table.groupBy("lang", F.col("context").alias("g")).agg(F.max("gamma").alias("v")), k - 1))
    return Model(langs, probabilities, shares)


# ---- predicting ---------------------------------------------------------------------------------


@dataclass
class Scored:
    """Words whose scores are known, in the place of a model."""

    langs: list[str]
    rows: dict[str, list[float]]

    def word_scores(self, words: list[str]) -> np.ndarray:
        return np.array([self.rows[w] for w in words]).reshape(len(words), len(self.langs))


class _Scores(dict):
    """Rows of word scores by words between blanks; the last column counts letters and word ends."""

    def __init__(self, model: Model | Scored) -> None:
        super().__init__()
        self.model, self.rows = model, np.zeros((0, len(model.langs) + 1))

    def totals(self, texts: pa.Array | list[list[str]]) -> np.ndarray:
        """For each text, given as words between blanks, summed log-probabilities and its number of letters.

        Each distinct word between blanks is looked up once, however often the texts have it.
        """
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.list_(pa.string()))
        chunks = texts.flatten().dictionary_encode()
        distinct = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [c for c in distinct if c not in self]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            self.rows = self.rows[:0]
            new = distinct
        first, last = len(self), len(self) + len(new)
        if last > len(self.rows):
            grown = np.empty((max(last, 2 * first), self.rows.shape[1]))
            grown[:first] = self.rows[:first]
            self.rows = grown
        self.rows[first:last] = self.chunk_rows(new)
        self.update(zip(new, range(first, last), strict=True))
        lengths = pc.list_value_length(texts).to_numpy()
        out, filled = np.zeros((len(texts), self.rows.shape[1])), lengths > 0
        if filled.any():
            starts, at = (np.cumsum(lengths) - lengths)[filled], chunks.indices.to_numpy()
            rows = self.rows[np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))]
            for i in range(rows.shape[1]):
                out[filled, i] = np.add.reduceat(rows[:, i].copy().take(at), starts)
        return out

    def chunk_rows(self, chunks: list[str]) -> np.ndarray:
        """A row for each word between blanks: the sums over the words of letters in it, each of which is scored once."""
        rows = np.zeros((len(chunks), self.rows.shape[1]))
        found = LINES.findall("\n".join(chunks).lower())
        ends = np.fromiter((w == "\n" for w in found), bool, len(found))
        number: dict[str, int] = {}
        at = [number.setdefault(w, len(number)) for w in found if w != "\n"]
        if at:
            words, owner = list(number), np.cumsum(ends)[~ends]
            scores = np.column_stack([self.model.word_scores(words), [len(w) + 1 for w in words]])
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            rows[owner[starts]] = np.add.reduceat(scores[at], starts, axis=0)
        return rows


def _judged(scores: _Scores, texts: list[str]) -> list[tuple]:
    langs, rows = scores.model.langs, []
    totals = scores.totals(pc.ascii_split_whitespace(pa.array(texts, pa.large_string())))
    for text, (*sums, letters) in zip(texts, totals.tolist(), strict=True):
        if not letters or not sums or not any(c.isalpha() for c in text):
            rows.append(("und", 0.0, None, int(letters)))
            continue
        best = max(sums)
        rows.append((langs[sums.index(best)], 1 / sum(math.exp(max(s - best, -700)) for s in sums), -best / letters, int(letters)))
    return rows


def _pieces(texts: pa.Array | pa.ChunkedArray) -> Iterator[list[str]]:
    """The texts of a batch, null as empty, in pieces of bounded size."""
    held, size = [], 0
    for text in texts:
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size > PIECE * 6:
            yield held
            held, size = [], 0
    yield held


def _with_judgements(batch: pa.RecordBatch | pa.Table, rows: list[tuple], left_out: tuple[str, ...]) -> tuple[list, list[str]]:
    columns = zip(*rows, strict=True) if rows else [()] * 4
    arrays = [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.float64(), pa.float64(), pa.int64()), strict=True)]
    kept = [(n, batch.column(n)) for n in batch.schema.names if n not in left_out]
    return [*(c for _, c in kept), *arrays], [*(n for n, _ in kept), "lang_pred", "score", "entropy", "letters"]


def predict(docs: DataFrame, model: Model | Tables, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, ``entropy`` (nats a letter) and ``letters``; map-only if the model is broadcast."""
    source = docs.drop(*ADDED).withColumn("_text", F.col("text").cast("string"))
    source = source if keep_text else source.drop("text")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "_text"), "lang_pred string, score double, entropy double, letters long"])
    if isinstance(model, Tables):
        return _predict_joined(source, model, schema)
    shared, key = docs.sparkSession.sparkContext.broadcast(model), model.key

    def run(batches: Batches) -> Batches:
        scores = kept(key, lambda: _Scores(shared.value))
        for batch in batches:
            rows = [row for piece in _pieces(batch.column("_text")) for row in _judged(scores, piece)]
            arrays, names = _with_judgements(batch, rows, ("_text",))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return map_batches(source, run, schema, keeps=key)


def _predict_joined(source: DataFrame, model: Tables, schema: str) -> DataFrame:
    """Documents in parts of bounded size, each with the scores of its distinct words: no word's rows are as many as its documents."""
    langs = model.langs
    placed = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in source.schema)}, _part string"

    def parted(batches: Batches) -> Batches:
        for batch in batches:
            parts = [part for piece in _pieces(batch.column("_text")) for part in [uuid.uuid4().hex] * len(piece)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, pa.string())], names=[*batch.schema.names, "_part"])

    def worded(batches: Batches) -> Batches:
        for batch in batches:
            found = sorted({(p, w) for p, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for w in words_of(t or "")})
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in (0, 1)], names=["part", "word"])

    parts = staged(map_batches(source, parted, placed), "parts")
    words = staged(map_batches(parts.select("_part", "_text"), worded, "part string, word string").distinct(), "words")
    scored = words.join(word_scores(words.select("word").distinct(), model), "word")

    def run(_: tuple, texts: pa.Table, found: pa.Table) -> pa.Table:
        rows = dict(zip(found.column("word").to_pylist(), found.column("scores").to_pylist(), strict=True))
        scores = _Scores(Scored(langs, rows))
        judged = [row for piece in _pieces(texts.column("_text")) for row in _judged(scores, piece)]
        arrays, names = _with_judgements(texts, judged, ("_text", "_part"))
        return pa.table(arrays, names=names)

    return parts.groupBy("_part").cogroup(scored.groupBy("part")).applyInArrow(run, schema)


def word_scores(words: DataFrame, model: Tables) -> DataFrame:
    """``(word, scores)``: what ``Model.word_scores`` gives, by joins of the words' distinct grams with the model's tables."""
    padded = F.concat(F.lit(START * (ORDER - 1)), F.col("word"), F.lit(STOP))
    places = F.explode(F.sequence(F.lit(1), F.length("word") + 1))
    split = words.select("word", padded.alias("padded"), places.alias("at")).select("word", F.substring("padded", F.col("at"), F.lit(ORDER)).alias("gram"))
    number = F.array_position(F.lit(model.langs).cast("array<string>"), F.col("lang")).cast("int")

    def by_lang(table: DataFrame, key: str, value: Column, name: str) -> DataFrame:
        each = table.groupBy(F.col(key), "lang").agg(F.max(value).alias("v")).select(key, F.struct(number.alias("lang"), F.log("v").cast("float").alias("v")).alias("pair"))
        return each.groupBy(key).agg(F.map_from_entries(F.collect_list("pair")).alias(name))  # a pair a language

    grams = {ORDER: split.select("gram").distinct()}
    for k in range(ORDER - 1, 0, -1):
        grams[k] = grams[k + 1].select(F.substring("gram", 2, k).alias("gram")).distinct()
    below = None
    for k, table in enumerate(model.orders, 1):
        own = grams[k].withColumn("context", F.substring("gram", 1, k - 1)).join(by_lang(table, "gram", F.col("p"), "found"), "gram", "left")
        shares = by_lang(table, "context", F.col("gamma"), "share")
        # all grams of order 1 have the one empty context, so it is not a key to join by
        own = own.join(shares, "context", "left") if k > 1 else own.crossJoin(F.broadcast(shares.select("share")))
        if below is not None:
            own = own.withColumn("suffix", F.substring("gram", 2, k - 1)).join(below, "suffix")
        score = F.expr(
            f"transform(sequence(1, {len(model.langs)}), l -> coalesce(try_element_at(found, l), coalesce(try_element_at(share, l), 0) + "
            + ("get(lower, l - 1)" if below is not None else f"{UNKNOWN!r}") + "))"
        ).cast("array<double>")
        done = staged(own.select("gram", score.alias("score")), f"scores{k}")
        below = done.select(F.col("gram").alias("suffix"), F.col("score").alias("lower"))
    sums = [F.sum(F.get("score", F.lit(i))) for i in range(len(model.langs))]
    return split.join(done, "gram").groupBy("word").agg(F.array(*sums).alias("scores"))


def _bin(letters: Column) -> Column:
    return sum((letters >= bound).cast("int") for bound in LENGTH_BINS)


def identify(docs: DataFrame, quantile: float = 0.999, slack: float = 1.25, keep_text: bool = True) -> DataFrame:
    """All columns of ``docs`` (``text`` only with ``keep_text``) with ``held_out``, ``lang_pred``, ``score``, ``entropy`` and ``rejected``.

    One model for each language is learned from the labelled documents of two folds, over all their text; the third
    fold calibrates how high the entropy of a text of some length may be: the ``quantile`` of its documents, times
    ``slack``. Above that a text is ``rejected`` as no learned language. The fourth fold is held out. A bin of lengths
    with few calibration documents goes by all lengths of its language too, then by all languages. With no calibration
    document at all there is no limit. Every text is scored once, into a table that both the limits and the verdicts are read from.

    A null text, or one with no letter, is ``und`` with score 0 and rejected; with nothing to learn from every text
    is. ``lang``, ``source`` and ``doc_id`` are no input of a prediction. ``score`` is the best language's posterior.
    Null labels teach nothing; repeated rows come out repeated; ties go to the first language by name; columns of
    these names in ``docs`` are replaced.
    """
    docs = docs.drop(*ADDED)
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    model = fit(labelled.where(_fold() < 2))
    scored = staged(predict(docs, model, keep_text), "scored")
    tried = scored.where(F.col("lang").isNotNull() & (_fold() == 3) & (F.col("lang_pred") != "und"))
    highest = [F.count("*").alias("n"), F.percentile_approx("entropy", quantile, 10_000).alias("limit")]
    pooled = tried.withColumn("bin", _bin(F.col("letters"))).rollup("lang_pred", "bin").agg(*highest).collect()  # a row a language and bin
    counts = {(r.lang_pred, r.bin): (r.n, r.limit * slack) for r in pooled if r.limit is not None}
    limit = F.lit(limit_of(counts, None, None)).cast("double")
    for lang in sorted({lang for lang, _ in counts if lang is not None}):
        for number in range(len(LENGTH_BINS) + 1):
            limit = F.when((F.col("lang_pred") == lang) & (_bin(F.col("letters")) == number), F.lit(limit_of(counts, lang, number))).otherwise(limit)
    found = scored.withColumn("rejected", F.coalesce(F.col("entropy") > limit, F.col("lang_pred") == "und"))
    return found.withColumn("held_out", held_out()).drop("letters")


def limit_of(counts: dict[tuple, tuple[int, float]], lang: str | None, number: int | None) -> float | None:
    """The entropy limit of a language's bin, from ``(documents, limit)`` by language and bin, None for all of them.

    A bin with too few documents takes the limit of the language, and a language with too few that of all languages,
    but none lower than its own documents ask for.
    """
    limits = []
    for key in ((lang, number), (lang, None), (None, None)):
        n, limit = counts.get(key, (0, None))
        limits += [] if limit is None else [float(limit)]
        if n >= LEAST_CALIBRATION:
            break
    return max(limits, default=None)
