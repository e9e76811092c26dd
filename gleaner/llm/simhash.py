"""Near-duplicates by SimHash fingerprints and a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import Batches, map_batches, staged, text_key
from gleaner.llm.graph import component_roots

BITS = 64
#: Shingles whose bits are counted at once, so that a very long text needs bounded memory.
PIECE = 1 << 15
#: Fingerprints of one bucket that one cell of the grid takes from each side.
CHUNK = 1 << 14
FANOUT = 8
#: Node pairs expanded at once.
STEP = 1 << 14


def fingerprint(text: bytes | None, shingle: int, seed: int) -> int:
    """The fingerprint of one text as a signed 64-bit number; zero where there are no words."""
    words = (text or b"").lower().split()  # bytes: only A-Z change, and blanks are \\x20 and \\x09-\\x0D
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    stops = ends[width - 1 :]
    starts = np.concatenate(([0], ends[: len(stops) - 1] + 1))
    ones, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(stops), PIECE):
        pairs = zip(starts[at : at + PIECE].tolist(), stops[at : at + PIECE].tolist(), strict=True)
        hashes = np.array([digest(line[a:b], seed) for a, b in pairs], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(stops)).view(">i8")[0])


def column_fingerprints(texts: pa.Array, shingle: int, seed: int) -> pa.Array:
    """The fingerprint of each text; one text at a time leaves the column, so that there is no second copy of all of them."""
    held = (t.as_buffer() for t in texts)
    return pa.array([fingerprint(t.to_pybytes() if t else None, shingle, seed) for t in held], pa.int64())


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """``(doc_id, text_key, fp)`` for each document: map-only, one pass over whole texts."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            fps = column_fingerprints(batch.column("text"), shingle, seed)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), fps], names=["doc_id", "text_key", "fp"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), F.col("text").cast("string")), run, "doc_id long, text_key string, fp long")


# ---- Gray order and the index -------------------------------------------------------------------


def block_layouts(distance: int, blocks: int) -> list[list[tuple[int, int]]]:
    """Bit ranges ``(shift, width)``, key blocks first, one layout for each choice of blocks that may be equal.

    With ``blocks`` blocks, two fingerprints at most ``distance`` bits apart agree on ``blocks - distance`` of
    them, so they meet in at least one layout.
    """
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    ranges = [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
    keep = blocks - distance
    return [[ranges[i] for i in c] + [r for i, r in enumerate(ranges) if i not in c] for c in combinations(range(blocks), keep)]


def arranged(fps: np.ndarray, layout: list[tuple[int, int]]) -> np.ndarray:
    """The fingerprints with the layout's ranges in order from the top bit."""
    out = np.zeros_like(fps)
    for shift, width in layout:
        out = (out << np.uint64(width)) | ((fps >> np.uint64(shift)) & np.uint64((1 << width) - 1))
    return out


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The rank of each code in Gray order: neighbours in rank differ in few bits."""
    out = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


def _levels(group: np.ndarray, codes: np.ndarray) -> list[dict[str, np.ndarray]]:
    """The index, leaves first: each node has the bits all of its members set (``ones``) or may set (``some``)."""
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    place = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
    levels = [{"ones": codes, "some": codes, "from": np.arange(len(codes)), "group": group, "place": place}]
    while (levels[-1]["place"] > 0).any():
        low = levels[-1]
        start = np.flatnonzero(low["place"] % FANOUT == 0)
        levels.append({
            "ones": np.bitwise_and.reduceat(low["ones"], start), "some": np.bitwise_or.reduceat(low["some"], start), "child": start,
            "from": low["from"][start], "group": low["group"][start], "place": low["place"][start] // FANOUT,
        })
    for low, high in zip(levels, levels[1:], strict=False):
        high["children"] = np.diff(np.r_[high["child"], len(low["group"])])
    return levels


def _find(parent: np.ndarray) -> np.ndarray:
    while (up := parent[parent]).tobytes() != parent.tobytes():
        parent = up
    return parent


def linked(group: np.ndarray, codes: np.ndarray, distance: int) -> np.ndarray:
    """For rows sorted by group and Gray rank, the first row of each row's component within its group.

    Neighbours in Gray order are linked first. Then pairs of index nodes are walked from the roots down; a pair
    is dropped with all below it when the shared bits of both sides already differ in more than ``distance``
    places, or when all its members are known to be one component.
    """
    n, label = len(codes), np.arange(len(codes))
    near = (group[1:] == group[:-1]) & (np.bitwise_count(codes[1:] ^ codes[:-1]) <= distance)
    label = np.maximum.accumulate(np.where(np.r_[False, near], 0, label))
    levels = _levels(group, codes)

    def spans() -> list[tuple[np.ndarray, np.ndarray]]:
        return [(np.minimum.reduceat(label, x["from"]), np.maximum.reduceat(label, x["from"])) for x in levels]

    known = spans()
    roots = np.flatnonzero(np.r_[levels[-1]["children"] > 0]) if len(levels) > 1 else np.array([], int)
    stack = [(len(levels) - 1, roots, roots)]
    while stack:
        at, a, b = stack.pop()
        if len(a) > STEP:
            stack.append((at, a[STEP:], b[STEP:]))
            a, b = a[:STEP], b[:STEP]
        low, high = known[at]
        open_ = ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))
        a, b = a[open_], b[open_]
        if not len(a):
            continue
        if at == 0:
            pairs = np.unique(np.stack([label[a], label[b]], 1), axis=0)
            parent = np.arange(n)
            for x, y in pairs.tolist():
                while parent[x] != x:
                    x = parent[x]
                while parent[y] != y:
                    y = parent[y]
                parent[max(x, y)] = min(x, y)
            label = _find(parent)[label]
            known = spans()
            continue
        x, down = levels[at], levels[at - 1]
        ka, kb = x["children"][a], x["children"][b]
        each = ka * kb
        pair = np.repeat(np.arange(len(a)), each)
        nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        ca, cb = x["child"][a][pair] + nth // kb[pair], x["child"][b][pair] + nth % kb[pair]
        keep = (ca < cb) | ((ca == cb) & (at > 1))
        ca, cb = ca[keep], cb[keep]
        apart = (down["ones"][ca] & ~down["some"][cb]) | (down["ones"][cb] & ~down["some"][ca])
        keep = np.bitwise_count(apart) <= distance
        if keep.any():
            order = np.argsort(cb[keep] - ca[keep], kind="stable")
            stack.append((at - 1, ca[keep][order], cb[keep][order]))
    return label


def _star_edges(table: pa.Table, layouts: list, distance: int) -> pa.RecordBatch:
    """Links of whole cells, each component as a star around its first fingerprint."""
    cell, layout = table.column("cell").to_numpy(), table.column("layout").to_numpy()
    fps = table.column("fp").to_numpy().view(np.uint64)
    codes = np.empty_like(fps)
    for i in np.unique(layout):
        codes[layout == i] = arranged(fps[layout == i], layouts[i])
    order = np.lexsort((gray_rank(codes), cell))
    cell, codes, fps = cell[order], codes[order], fps[order]
    alone = np.r_[True, cell[1:] != cell[:-1]] & np.r_[cell[1:] != cell[:-1], True] if len(cell) else np.array([], bool)
    cell, codes, fps = cell[~alone], codes[~alone], fps[~alone]
    if not len(cell):
        u = v = np.array([], np.int64)
    else:
        label = linked(cell, codes, distance)
        far = np.flatnonzero(label != np.arange(len(label)))
        u, v = fps[far].view(np.int64), fps[label[far]].view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _whole_cells(batches: Batches, rows: int = 1 << 17) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that never part a cell; the input is sorted by cell."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= rows:
            whole = pa.Table.from_batches(held)
            cells = whole.column("cell").to_numpy()
            cut = int(np.searchsorted(cells, cells[-1]))
            held = whole.slice(cut).to_batches()
            if cut:
                yield whole.slice(0, cut)
    if held:
        yield pa.Table.from_batches(held)


def near_links(fps: DataFrame, distance: int = 4, blocks: int = 6, chunk: int = CHUNK) -> DataFrame:
    """Edges ``(u, v)`` that connect all distinct fingerprints at most ``distance`` bits apart.

    ``fps`` has one row for each distinct ``fp``. Each goes to one bucket for each block layout; a bucket is
    sorted by Gray rank and searched through its hierarchical index. A bucket of over ``chunk`` rows is dealt
    as a grid of cells, each with two of its parts, so that no task takes a whole hot bucket. Links come out as
    stars, never as all pairs.
    """
    layouts = block_layouts(distance, blocks)
    key_bits = [sum(w for _, w in lay[: blocks - distance]) for lay in layouts]

    def deal(batches: Batches) -> Batches:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for i, (lay, bits) in enumerate(zip(layouts, key_bits, strict=True)):
                bucket = (arranged(values, lay) >> np.uint64(BITS - bits)).astype(np.int64) + (i << 32)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.full(len(values), i, np.int16)), batch.column(0)], names=["bucket", "layout", "fp"])

    dealt = map_batches(fps.select("fp"), deal, "bucket long, layout short, fp long")
    large = dealt.groupBy("bucket").count().where(F.col("count") > chunk).select("bucket", F.ceil(F.col("count") / chunk).cast("int").alias("parts"))
    part: Column = F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int")
    others = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    cells = dealt.join(large, "bucket", "left").select(
        "layout", "fp", "bucket", part.alias("part"), F.explode(others).alias("other")
    ).select("layout", "fp", F.xxhash64("bucket", F.least("part", "other"), F.greatest("part", "other")).alias("cell"))

    def search(batches: Batches) -> Batches:
        for whole in _whole_cells(batches):
            yield _star_edges(whole, layouts, distance)

    return map_batches(cells.repartition("cell").sortWithinPartitions("cell"), search, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, distance: int = 4, shingle: int = 4, seed: int = 42) -> DataFrame:
    """``(doc_id, text_key, fp, component_id, kept)``: one row for each document.

    A null text has no words; no words give fingerprint zero, which links like any other. ``component_id`` is the
    smallest ``doc_id`` that links reach, null only where no document of the component has one. ``kept`` is true for
    one id and text of each component: the smallest id, nulls last, then the smallest key. Repeated rows come out repeated;
    other columns of ``docs`` are ignored.
    """
    own = staged(fingerprints(docs, shingle, seed), "simhash")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    nodes = staged(own.groupBy("fp").agg(F.min(place).alias("least")), "simhash-nodes")
    roots = component_roots(near_links(nodes, distance))
    rooted = nodes.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    chosen = rooted.groupBy("root").agg(F.min("least").alias("chosen"))
    named = rooted.select("fp", "root").join(chosen, "root").select("fp", "chosen")
    return own.join(named, "fp").select("doc_id", "text_key", "fp", F.col("chosen.doc_id").alias("component_id"), (place == F.col("chosen")).alias("kept"))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))
