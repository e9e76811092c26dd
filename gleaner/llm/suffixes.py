"""Repeated passages: hashes of fixed runs at minimiser positions, sorted and compared with neighbours, then all runs near them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import Batches, map_batches, staged

#: ASCII letters in lower case, digits and all bytes of other characters stay; every other byte parts words.
KEPT = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isdigit() or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
#: Words of the runs whose least hash selects a position, and how many neighbouring runs compete.
SEED, SPREAD = 8, 20
#: Distinct words a worker remembers, words worked on at once, and rows in a batch that a task passes on.
REMEMBERED, PIECE, ROWS = 1 << 19, 1 << 19, 1 << 16
#: Bits of the fixed-size set that keeps most documents without a match from being read again.
SET_BITS = 24
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, text: bytes) -> np.ndarray:
        words = text.translate(KEPT).split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def run_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` words, from the hashes of runs of powers of two."""
    n = len(ids) - width + 1
    if n < 1:
        return np.array([], np.uint64)
    out, done, power, size, base = np.zeros(n, np.uint64), 0, ids, 1, BASE
    with np.errstate(over="ignore"):
        while True:
            if width & size:
                out = out * base + power[done : done + n]
                done += size
            if done == width:
                break
            power = power[: len(power) - size] * base + power[size:]
            base, size = base * base, size * 2
        out ^= out >> np.uint64(32)
        out *= MIX
    return out ^ (out >> np.uint64(29))


def minimisers(ids: np.ndarray, length: int) -> np.ndarray:
    """Positions such that every run of ``length`` words has one among its first SPREAD, chosen by the words there alone."""
    seeds = run_hashes(ids, SEED)
    starts = len(ids) - length + 1
    if starts < 1:
        return np.array([], np.int64)
    place = np.uint64((1 << 32) - 1)
    least = (seeds & ~place) | np.arange(len(seeds), dtype=np.uint64)
    reach = 1
    while reach < SPREAD:
        step = min(reach, SPREAD - reach)
        least = np.minimum(least[: len(least) - step], least[step:])
        reach += step
    return np.unique((least[:starts] & place).astype(np.int64))


def _suffixes(docs: DataFrame, length: int) -> DataFrame:
    """One row for each document (``pos`` null) and one for each selected position, with the hash of its suffix."""

    def run(batches: Batches) -> Batches:
        known = _Hashes()
        for batch in batches:
            counts, parts = [], []
            for doc, text in zip(batch.column("doc").to_numpy(), batch.column("text").cast(pa.binary()), strict=True):
                ids = known.of(text.as_py())
                counts.append(len(ids))
                at = minimisers(ids, length)
                if len(at):
                    parts.append((np.full(len(at), doc), at, run_hashes(ids, length - SPREAD + 1)[at].view(np.int64)))
                if sum(len(p[1]) for p in parts[-1:]) > ROWS or len(parts) > 1000:
                    yield rows(parts)
                    parts = []
            if parts:
                yield rows(parts)
            n = len(counts)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("doc_id"), batch.column("same"), pa.array(counts, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())], names=names)

    def rows(parts: list[tuple]) -> pa.RecordBatch:
        doc, at, key = (np.concatenate(c) for c in zip(*parts, strict=True))
        none = pa.nulls(len(doc), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(doc), none, none, none, pa.array(at, pa.int32()), pa.array(key)], names=names)

    names = ["doc", "doc_id", "same", "n_words", "pos", "key"]
    return map_batches(docs, run, "doc long, doc_id long, same long, n_words long, pos int, key long")


SHARED, ALONE, OPEN, EDGE = range(4)


def beside_neighbours(rows: DataFrame, keep: int) -> DataFrame:
    """Of ``(key, doc, pos)``, the rows whose key several documents have (``keep`` SHARED), or only theirs (ALONE).

    Rows are range-partitioned and sorted by key, document and position, so a key that very many documents share is
    spread over partitions, and each row needs only its neighbours. What the first and last key of a partition
    cannot tell is left open and settled from two rows a partition edge.
    """
    schema = "key long, doc long, pos int, state byte"

    def run(batches: Batches) -> Batches:
        def out(key: np.ndarray, doc: np.ndarray, pos: np.ndarray, state: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(doc, pa.int64()), pa.array(pos, pa.int32()), pa.array(np.full(len(key), state, np.int8))], names=["key", "doc", "pos", "state"])

        held = [np.array([], t) for t in (np.int64, np.int64, np.int32)]
        told, first = False, True  # told: the held row stands for a key known to be shared, and is out already
        edge: list[tuple[int, int]] = []
        for batch in batches:
            if not len(batch):
                continue
            key, doc, pos = (np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("key", "doc", "pos"), strict=True))
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            stop = np.r_[start[1:], len(key)]
            shared = doc[start] != doc[stop - 1]
            shared[0] |= told
            state = np.where(shared, SHARED, ALONE).astype(np.int8)
            if first:
                edge += [(key[0], doc[0]), (key[0], doc[stop[0] - 1])]
                if len(start) > 1 and not shared[0]:
                    state[0] = OPEN
                first = len(start) == 1
            each = np.repeat(state, stop - start)
            closed = np.ones(len(key), bool)
            closed[0] = not told
            if not shared[-1]:
                closed[start[-1] :] = False  # its rows, all of one document, wait for the next batch
            for kind in (keep, OPEN):
                pick = closed & (each == kind)
                if pick.any():
                    yield out(key[pick], doc[pick], pos[pick], kind)
            told = bool(shared[-1])
            rest = slice(len(key) - 1, None) if told else slice(start[-1], None)
            held = [key[rest], doc[rest], pos[rest]]
        if len(held[0]):
            edge += [(held[0][0], held[1][0]), (held[0][0], held[1][-1])]
            if not told:
                yield out(*held, OPEN)
            yield out(np.array([e[0] for e in edge]), np.array([e[1] for e in edge]), np.zeros(len(edge), np.int32), EDGE)

    order = ["key", "doc", "pos"]
    sorted_rows = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    judged = staged(map_batches(sorted_rows, run, schema), "neighbours")
    across = judged.where(F.col("state") == EDGE).groupBy("key").agg((F.min("doc") < F.max("doc")).alias("across")).where("across").select("key")
    settled = judged.where(F.col("state") == OPEN).join(across, "key", "left_semi" if keep == SHARED else "left_anti")
    return judged.where(F.col("state") == keep).unionByName(settled).select(*order)


def _windows(docs: DataFrame, length: int) -> DataFrame:
    """For documents with ``places`` of matching suffixes, every run of ``length`` words that has one near its start.

    Rows with a ``key`` are runs; the others tell for each document which starts were taken, as ``pos`` to ``last``.
    """
    names = ["doc", "pos", "last", "key"]

    def run(batches: Batches) -> Batches:
        known = _Hashes()
        for batch in batches:
            for doc, text, places in zip(batch.column("doc").to_numpy(), batch.column("text").cast(pa.binary()), batch.column("places"), strict=True):
                ids = known.of(text.as_py())
                at = np.unique(np.array(places.as_py(), np.int64))
                mark = np.zeros(len(ids) + 1, np.int32)
                np.add.at(mark, np.maximum(at - SPREAD + 1, 0), 1)
                np.add.at(mark, np.minimum(at + 1, len(ids)), -1)
                taken = np.flatnonzero(np.cumsum(mark)[: max(len(ids) - length + 1, 0)] > 0)
                if not len(taken):
                    continue
                cut = np.flatnonzero(np.diff(taken) > 1)
                low, high = taken[np.r_[0, cut + 1]], taken[np.r_[cut, len(taken) - 1]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(low), doc)), pa.array(low, pa.int32()), pa.array(high, pa.int32()), pa.nulls(len(low), pa.int64())], names=names)
                keys = run_hashes(ids, length).view(np.int64)
                for i in range(0, len(taken), ROWS):
                    t = taken[i : i + ROWS]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(t), doc)), pa.array(t, pa.int32()), pa.nulls(len(t), pa.int32()), pa.array(keys[t])], names=names)

    return map_batches(docs.select("doc", "text", "places"), run, "doc long, pos int, last int, key long")


def _held(docs: DataFrame, some: DataFrame) -> DataFrame:
    """The documents whose hash falls in the same slot as one of ``some``: all of those and few others."""
    slot = lambda c: F.shiftrightunsigned(c, 64 - SET_BITS)
    taken = np.zeros(1 << SET_BITS, bool)
    taken[some.select(slot("doc").alias("s")).distinct().toArrow().column(0).to_numpy()] = True  # at most 2^SET_BITS numbers
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(taken))

    def run(batches: Batches) -> Batches:
        full = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            slots = batch.column("doc").to_numpy().view(np.uint64) >> np.uint64(64 - SET_BITS)
            yield batch.filter(pa.array(full[slots.astype(np.int64)]))

    return map_batches(docs, run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema))


def _spans(found: DataFrame, length: int) -> DataFrame:
    """``(doc_id, start_word, end_word)`` from the starts taken and the starts that failed."""
    names = ["doc_id", "start_word", "end_word"]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for doc_id, ranges, failed in zip(batch.column("doc_id"), batch.column("ranges"), batch.column("failed"), strict=True):
                starts = np.concatenate([np.arange(r["pos"], r["last"] + 1) for r in ranges.as_py()])
                starts = np.setdiff1d(starts, np.array(failed.as_py() or [], np.int64))
                if not len(starts):
                    continue
                cut = np.flatnonzero(np.diff(starts) > length)
                low, high = starts[np.r_[0, cut + 1]], starts[np.r_[cut, len(starts) - 1]] + length
                yield pa.RecordBatch.from_arrays([pa.array([doc_id.as_py()] * len(low), pa.int64()), pa.array(low), pa.array(high)], names=names)

    return map_batches(found, run, "doc_id long, start_word long, end_word long")


def repeated_passages(docs: DataFrame, length: int = 50) -> DataFrame:
    """``(doc_id, start_word, end_word)``: all maximal stretches of words covered by runs of ``length`` or more words that
    stand in another document too.

    Words are lower-cased runs of letters and digits. A run shared by two documents has the same minimiser near its
    start in both, so its suffix from there, less than SPREAD words shorter, is in the sparse array of both. Suffixes
    that match a neighbour's are extended left and right: the runs around them are compared in the same way. A text
    that several documents have whole is taken once for this and reported whole for each. Results are exact but for
    64-bit hashes.

    A null or empty text has no passage. Rows equal in id and text are one document; a passage repeated within one
    document only is none; null ids stay null; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long"), text.alias("text")).select(F.xxhash64("doc_id", "text").alias("doc"), "doc_id", F.xxhash64("text", F.length("text")).alias("same"), "text")
    sparse = staged(_suffixes(keyed, length), "suffixes")
    known = sparse.where("pos IS NULL").groupBy("doc").agg(F.first("doc_id").alias("doc_id"), F.first("same").alias("same"), F.first("n_words").alias("n_words"))
    groups = known.groupBy("same").agg(F.min("doc").alias("doc"), F.count("*").alias("copies"))
    whole = known.join(groups.where("copies > 1").select("same"), "same", "left_semi").where(F.col("n_words") >= length)
    matching = beside_neighbours(sparse.where("pos IS NOT NULL"), SHARED)
    places = matching.groupBy("doc").agg(F.collect_list("pos").alias("places")).join(groups.select("doc"), "doc", "left_semi")
    places = staged(places, "places")
    again = _held(keyed.select("doc", "text"), places).join(places, "doc").dropDuplicates(["doc"])
    windows = staged(_windows(again, length), "passages")
    failed = beside_neighbours(windows.where("key IS NOT NULL"), ALONE).groupBy("doc").agg(F.collect_list("pos").alias("failed"))
    ranges = windows.where("key IS NULL").groupBy("doc").agg(F.collect_list(F.struct("pos", "last")).alias("ranges"))
    once = known.join(whole.select("doc"), "doc", "left_anti").select("doc", "doc_id").join(ranges, "doc").join(failed, "doc", "left")
    entire = whole.select("doc_id", F.lit(0).cast("long").alias("start_word"), F.col("n_words").alias("end_word"))
    return entire.unionByName(_spans(once.select("doc_id", "ranges", "failed"), length))
