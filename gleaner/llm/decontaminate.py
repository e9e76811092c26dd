"""Benchmark decontamination: test n-grams against every window of the training words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import Batches, map_batches, staged, text_key

#: ASCII letters in lower case, digits and all bytes of other characters stay; every other byte parts words.
KEPT = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isdigit() or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
#: log2 of the number of slots in the broadcast hash set: two megabytes, whatever the benchmark's size.
SLOT_BITS = 24
#: Words scanned at once, and distinct words a worker remembers.
PIECE, REMEMBERED = 1 << 19, 1 << 19
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(KEPT).split()


def window_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` words."""
    n = len(ids) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(width if n > 0 else 0):
        out = out * BASE + ids[i : i + n]
    out ^= out >> np.uint64(32)
    out *= MIX
    return out ^ (out >> np.uint64(29))


def slots(hashes: np.ndarray) -> np.ndarray:
    """Two places in the hash set for each window."""
    low = np.uint64((1 << SLOT_BITS) - 1)
    return np.stack([hashes & low, (hashes >> np.uint64(SLOT_BITS)) & low])


def item_windows(items: DataFrame, width: int) -> DataFrame:
    """``(item_id, window, size, slot_a, slot_b)``: each run of ``width`` words, or all words of a shorter item."""

    def run(batches: Batches) -> Batches:
        known = _Hashes()
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = words_of(text)
                if not words:
                    continue
                size = min(width, len(words))
                hashed = slots(window_hashes(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), size)).tolist()
                rows += [(item, b" ".join(words[i : i + size]), size, hashed[0][i], hashed[1][i]) for i in range(len(words) - size + 1)]
            kinds = [pa.string(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]
            columns = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["item_id", "window", "size", "slot_a", "slot_b"])

    source = items.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    return map_batches(source, run, "item_id string, window binary, size int, slot_a int, slot_b int").distinct()


def _scan(docs: DataFrame, sizes: list[int], taken: np.ndarray) -> DataFrame:
    """One row for each document (``pos`` null), and one for each window that the hash set holds."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(taken))

    def run(batches: Batches) -> Batches:
        full, known = np.unpackbits(shared.value).view(bool), _Hashes()
        row = TaskContext.get().partitionId() << 33
        names = ["row", "doc_id", "text_key", "n_words", "pos", "size", "window"]

        def found(group: list[list[bytes]], first: int) -> Batches:
            """Candidates among the windows of some documents, whose rows start at ``first``."""
            words = [w for g in group for w in g]
            ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            starts = np.cumsum([0, *map(len, group)])
            for size in sizes:
                hashes = window_hashes(ids, size)
                a, b = slots(hashes)
                hits = np.flatnonzero(full[a] & full[b])
                owner = np.searchsorted(starts, hits, side="right") - 1
                inside = hits + size <= starts[owner + 1]
                hits, owner = hits[inside], owner[inside]
                for at in range(0, len(hits), 10_000):
                    h, o = hits[at : at + 10_000], owner[at : at + 10_000]
                    windows = [b" ".join(words[i : i + size]) for i in h.tolist()]
                    none = pa.nulls(len(h), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(o + first, pa.int64()), none, pa.nulls(len(h), pa.string()), none, pa.array(h - starts[o], pa.int32()), pa.array(np.full(len(h), size), pa.int32()), pa.array(windows, pa.binary())], names=names)

        for batch in batches:
            lengths, group, held, first = [], [], 0, row
            for text in batch.column("text").cast(pa.binary()):
                group.append(words := words_of(text.as_py()))
                lengths.append(len(words))
                held += len(words)
                if held >= PIECE:
                    yield from found(group, first)
                    first, group, held = first + len(group), [], 0
            yield from found(group, first)
            n = len(lengths)
            hits = (pa.nulls(n, k) for k in (pa.int32(), pa.int32(), pa.binary()))
            columns = [pa.array(np.arange(row, row + n)), batch.column("doc_id"), batch.column("text_key"), pa.array(lengths, pa.int64()), *hits]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            row += n

    source = docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), F.col("text").cast("string"))
    return map_batches(source, run, "row long, doc_id long, text_key string, n_words long, pos int, size int, window binary")


def covered(spans: Column) -> Column:
    """How many positions lie in any of the spans ``(pos, size)``."""
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["pos"] + s["size"] - F.greatest(acc["end"], s["pos"]))).cast("long").alias("n"),
        F.greatest(acc["end"], s["pos"] + s["size"]).cast("int").alias("end"),
    )
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("int").alias("end"))
    return F.aggregate(F.array_sort(spans), start, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, width: int = 13, share: int = 20) -> DataFrame:
    """``(doc_id, text_key, n_words, n_hit, item_ids, spans, contaminated)`` for each document.

    Test windows are hashed into a broadcast set of fixed size, so its memory does not grow with the benchmark.
    Training windows found in it are joined to the test windows word for word: a false hit of the set costs a
    row, never a wrong answer. A document is contaminated if hit words are at least one in ``share``.

    A null or empty text has no words and no hits. An item without words has no window; a null ``item_id`` marks words
    as hit but names no item. Repeated items and windows count once; repeated documents come out repeated; other
    columns are ignored; with an empty benchmark nothing is hit.
    """
    windows = staged(item_windows(items, width), "benchmark")
    sizes = sorted(r[0] for r in windows.select("size").distinct().toLocalIterator())  # at most ``width`` values
    taken = np.zeros(1 << SLOT_BITS, bool)
    for slot in ("slot_a", "slot_b"):
        taken[windows.select(slot).distinct().toArrow().column(0).to_numpy()] = True  # at most 2^SLOT_BITS numbers
    scanned = staged(_scan(docs, sizes, taken), "windows")
    texts = windows.select("window").distinct()
    hits = scanned.where("pos IS NOT NULL").select("row", "pos", "size", "window").join(texts, "window")
    spans = hits.groupBy("row").agg(F.collect_set(F.struct("pos", "size")).alias("spans"))
    names = hits.select("row", "window").distinct().join(windows.where("item_id IS NOT NULL").select("window", "item_id"), "window")
    named = names.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    whole = scanned.where("pos IS NULL").select("row", "doc_id", "text_key", "n_words").join(spans, "row", "left").join(named, "row", "left")
    n_hit = F.coalesce(covered(F.col("spans")), F.lit(0).cast("long"))
    return whole.select(
        "doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.array_sort(F.coalesce("spans", F.array().cast("array<struct<pos:int,size:int>>"))).alias("spans"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
