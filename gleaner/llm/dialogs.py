"""Repair of conversation structure: cheapest edits by an automaton that shares the suffixes of all conversations."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import Batches, map_batches, staged

#: Blanks of a text; one with nothing else is blank.
BLANK = " \t\n\x0b\x0c\r"
#: Costs of the edits; a truncated row that stays costs ``CUT`` more.
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: Grammar states: nothing yet, after system, after user, after assistant. What may follow each but system at the start.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
FINAL = (START, ASSISTANT)
#: Pairs of initials that may stand side by side.
PAIRS = ("su", "ua", "au")
#: Symbols of a row: its role's initial, in capitals if truncated; ``x`` for other roles, ``d`` for rows that must go.
MUST_GO, OTHER = "d", "x"
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]
#: A piece of a conversation: its first row's place in the order, the last row's initial, what its rows add.
PIECE = "conv_id long, turn long, role string, digest string, closing string, symbols string, first_turn long, last_turn long, turns long, illegal long"


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with planted faults, by crc32 of ``conv_id:turn`` modulo 20; nulls are one space.

    0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats it, 4 makes it a user's.
    """
    filled = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    number = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(number[0], F.lit(":"), number[1]).cast("binary")) % 20
    text = F.when(F.col("_fault") == 1, F.lit("")).when(F.col("_fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("_fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        filled.withColumn("_fault", fault).where("_fault <> 0")
        .select("conv_id", "turn", F.when(F.col("_fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("_copy"))
        .drop("_copy")
    )


# ---- signatures ---------------------------------------------------------------------------------


def _ordered() -> list[Column]:
    """The order of a conversation's rows: by turn, nulls first; ties by role, then by the digest of the text."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _slim(rows: DataFrame) -> DataFrame:
    """What decides a row's faults, without its text."""
    kept = F.rtrim(F.col("text"), F.lit(BLANK))
    end = F.right(kept, F.lit(1))
    return rows.select("conv_id", "turn", "role", F.md5("text").alias("digest"), (kept == "").alias("blank"), (~end.isin(".", "!", "?")).alias("cut"))


def signatures(rows: DataFrame) -> DataFrame:
    """For each conversation its ``signature`` (a symbol for each row, in order), counts of faults and gaps.

    Rows are sorted over all conversations at once, in ranges of ``(conv_id, turn, role, digest)``, so that a conversation of
    any length is dealt to many tasks; each gives a piece of its signature. Equal rows are neighbours then; whether an equal
    text stands at an earlier turn is known from the least turn of each role and text, a map-side minimum.
    """
    slim = staged(_slim(rows), "turns")
    same = ["conv_id", "role", "digest"]
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    repeated = staged(slim.where("NOT blank").groupBy(*same).agg(F.count("*").alias("n"), F.min(turn)["turn"].alias("earliest")).where("n > 1"), "repeated")
    match = slim["conv_id"].eqNullSafe(repeated["conv_id"]) & (slim["role"] == repeated["role"]) & (slim["digest"] == repeated["digest"])
    later = F.col("n").isNotNull() & ~F.col("turn").eqNullSafe(F.col("earliest"))
    marked = slim.join(repeated, match, "left").select(*[slim[c] for c in slim.columns], later.alias("again"))
    dealt = marked.repartitionByRange(*[F.col(c) for c in ("conv_id", "turn", "role", "digest")]).sortWithinPartitions(F.col("conv_id"), *_ordered())
    pieces = staged(map_batches(dealt, _pieces, PIECE), "pieces")
    # few pieces a conversation: one for each range it spans
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", "digest")
    by_place = F.array_sort(F.collect_list(F.struct(order.alias("order"), "closing", "symbols", "first_turn", "last_turn", "turns", "illegal")))
    joined = pieces.groupBy("conv_id").agg(by_place.alias("p"), F.min("first_turn").alias("low"), F.max("last_turn").alias("high"))
    sides = F.slice("p", F.lit(1), F.size("p") - 1), F.slice("p", F.lit(2), F.size("p") - 1)
    pairs = F.zip_with(*sides, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    shared = F.size(F.filter(pairs, lambda x: x["a"]["last_turn"] == x["b"]["first_turn"])).cast("long")
    crossing = F.filter(pairs, lambda x: ~F.concat(x["a"]["closing"], F.left(x["b"]["order"]["role"], F.lit(1))).isin(*PAIRS))
    total = lambda name: F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x[name])
    symbols = F.array_join(F.transform("p", lambda x: x["symbols"]), "")
    return joined.select(
        "conv_id",
        F.translate(symbols, "bD", MUST_GO * 2).alias("signature"),
        F.coalesce(F.col("high") - F.col("low") + 1 - (total("turns") - shared), F.lit(0)).cast("long").alias("gaps"),
        *[(F.length(symbols) - F.length(F.translate(symbols, marks, ""))).cast("long").alias(name) for name, marks in (("blank", "b"), ("duplicate", "D"), ("truncated", "SUAX"))],
        (total("illegal") + F.size(crossing)).alias("illegal"),
    )


def _pieces(batches: Batches) -> Batches:
    """Sorted rows to a piece for each conversation; blank rows are ``b`` and duplicates ``D`` in it."""
    done: list[tuple] = []
    conv: object = done  # no conversation
    before: tuple | None = None
    opened: tuple = ()
    symbols: list[str] = []
    first = last = None
    closing = ""
    turns = illegal = 0

    def piece() -> tuple:
        return (conv, *opened, closing, "".join(symbols), first, last, turns, illegal)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 2 + [pa.string()] * 4 + [pa.int64()] * 4
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in PIECE.split(", ")])

    for batch in batches:
        for own, turn, role, digest, blank, cut, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            initial = role[:1]
            if conv is done or own != conv:
                if conv is not done:
                    done.append(piece())
                conv, opened, symbols, before, first, last, turns, illegal = own, (turn, role, digest), [], None, None, None, 0, 0
            else:
                illegal += closing + initial not in PAIRS
            closing = initial
            if turn is not None and turn != last:
                turns += 1
                first = turn if first is None else first
                last = turn
            if blank:
                symbols.append("b")
            elif again or before == (turn, role, digest):
                symbols.append("D")
            else:
                kind = initial if initial in ("s", "u", "a") else OTHER
                symbols.append(kind.upper() if cut else kind)
            before = (turn, role, digest)
        if len(done) > 10_000:
            yield batch_of(done)
            done.clear()
    if conv is not done:
        done.append(piece())
    yield batch_of(done)


# ---- the automaton ------------------------------------------------------------------------------

#: A node's cost to go and best first edit, for each grammar state.
Node = tuple[tuple[int, str], ...]


def _inserted(best: list[tuple[int, str]]) -> Node:
    """Costs to go when inserts may come first. Two rounds do: of three inserts in a row the last two change nothing."""
    for _ in range(2):
        best = [min(best[s], (best[NEXT[s]][0] + INSERT, "I")) for s in range(4)]
    return tuple(best)


END: Node = _inserted([(0, "") if s in FINAL else (1 << 60, "") for s in range(4)])


def node_of(symbol: str, after: Node) -> Node:
    """The node that reads ``symbol`` and goes on as ``after``. Edits have different initials, so the cost and the first edit settle ties."""
    best = []
    for state in range(4):
        edits = [(DELETE + after[state][0], "D")]
        if symbol != MUST_GO:
            cut = CUT if symbol.isupper() else 0
            to = {"s": SYSTEM if state == START else None, "u": USER, "a": ASSISTANT}.get(symbol.lower())
            if to == SYSTEM or to == NEXT[state]:
                edits.append((cut + after[to][0], "K"))
            edits.append((cut + REROLE + after[NEXT[state]][0], "R"))
        best.append(min(edits))
    return _inserted(best)


def edits_of(signature: str, nodes: list[Node]) -> str:
    """The audit from the start: ``nodes`` is the path from the end to the first row; each step takes the node's best first edit."""
    out, state, at = [], START, 0
    while True:
        edit = nodes[len(signature) - at][state][1]
        if not edit:
            return "".join(out)
        out.append(edit)
        if edit == "I":
            state = NEXT[state]
            continue
        if edit == "R":
            state = NEXT[state]
        elif edit == "K":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[signature[at].lower()]
        at += 1


def _solve(batches: Batches) -> Batches:
    """Signatures sorted by their reversal: the path of the last one from the end is at hand, and what the next shares of it is not computed again."""
    path: list[Node] = [END]  # nodes with their least cost taken off, which is in ``bases``
    bases = [0]
    last = ""
    known: dict[tuple[str, Node], Node] = {}
    shapes: dict[Node, Node] = {END: END}
    for batch in batches:
        found = []
        for signature in batch.column(0).to_pylist():
            backward = signature[::-1]
            shared = 0
            for a, b in zip(last, backward, strict=False):
                if a != b:
                    break
                shared += 1
            del path[shared + 1 :], bases[shared + 1 :]
            for symbol in backward[shared:]:
                # suffixes whose costs differ by the same amount in every state go on alike: they are one node
                if (symbol, path[-1]) not in known:
                    known[symbol, path[-1]] = node_of(symbol, path[-1])
                node = known[symbol, path[-1]]
                least = min(cost for cost, _ in node)
                path.append(shapes.setdefault(shape := tuple((cost - least, edit) for cost, edit in node), shape))
                bases.append(bases[-1] + least)
            last = backward
            found.append((signature, bases[-1] + path[-1][START][0], edits_of(signature, path)))
        columns = list(zip(*found, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string()), strict=True)], names=["signature", "cost", "audit"])


def audits(found: DataFrame) -> DataFrame:
    """``(signature, cost, audit)`` for each distinct signature of ``found``.

    Distinct signatures, found by a map-side aggregate, are sorted by their reversal, so that those with a common suffix are
    neighbours: the suffixes they share are one chain of nodes, solved once for each of the four grammar states.
    """
    distinct = found.select("signature").distinct().withColumn("_backward", F.reverse("signature"))
    dealt = distinct.repartitionByRange(F.col("_backward")).sortWithinPartitions("_backward").select("signature")
    return map_batches(dealt, _solve, "signature string, cost long, audit string")


# ---- repairing ----------------------------------------------------------------------------------


def _applied(edits: Iterator[str], state: list[int]) -> Iterator[str]:
    """The inserted rows that come next, up to the edit of the next given row, which is yielded last."""
    for edit in edits:
        if edit != "I":
            yield edit
            return
        state[0] = NEXT[state[0]]
        yield f"{ROLES[state[0]]}:"


def _repaired(batches: Batches) -> Batches:
    """Rows in order, after a head row with the audit of their conversation, to a digest of the repaired conversation."""
    done: list[tuple] = []
    conv: object = done
    edits: Iterator[str] = iter("")
    state, digest, lines = [START], hashlib.sha256(), 0

    def write(line: str) -> None:
        nonlocal lines
        digest.update((("\n" if lines else "") + line).encode("utf-8", "surrogatepass"))
        lines += 1

    def finish() -> None:
        for line in _applied(edits, state):
            write(line)
        done.append((conv, digest.hexdigest()))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 2
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string())], names=["conv_id", "repaired_sha256"])

    for batch in batches:
        for own, head, audit, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "head", "audit", "role", "text")), strict=True):
            if head:
                if conv is not done:
                    finish()
                conv, edits, state, digest, lines = own, iter(audit), [START], hashlib.sha256(), 0
                continue
            *inserted, edit = _applied(edits, state)
            for line in inserted:
                write(line)
            if edit == "K":
                state[0] = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]
                write(f"{role}:{text}")
            elif edit == "R":
                state[0] = NEXT[state[0]]
                write(f"{ROLES[state[0]]}:{text}")
        if len(done) > 10_000:
            yield batch_of(done)
            done.clear()
    if conv is not done:
        finish()
    yield batch_of(done)


def repaired(rows: DataFrame) -> DataFrame:
    """For each conversation of ``rows`` (``conv_id, turn, role, text``): its faults, the cheapest edits and the repaired text's digest.

    Columns: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``. Null roles and texts are one
    space; null ids are one conversation; rows go by turn, nulls first, ties by role, then by the text's digest. Rows that repeat
    are duplicates of the first. Other columns are left out. An empty table gives an empty table.

    Signatures come from sorted ranges of slim rows and are solved once for all conversations that have them; a signature that
    very many conversations share is one row there, and a side of a join that can be split afterwards. Texts are shuffled
    once, by conversation: a digest of a whole text has to be made in order, so a conversation's texts pass one task, row by row
    in bounded memory, and only its audit (a letter a row) is held.
    """
    filled = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    found = staged(signatures(filled), "signatures")
    solved = staged(found.join(staged(audits(found), "audits"), "signature").drop("signature"), "solved")
    heads = solved.select("conv_id", F.lit(True).alias("head"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("digest"), "audit", F.lit(None).cast("string").alias("text"))
    lines = filled.select("conv_id", F.lit(False).alias("head"), "turn", "role", F.md5("text").alias("digest"), F.lit(None).cast("string").alias("audit"), "text")
    dealt = heads.unionByName(lines).repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.col("head").desc(), *_ordered())
    digests = map_batches(dealt, _repaired, "conv_id long, repaired_sha256 string").withColumnRenamed("conv_id", "_conv")
    return solved.join(digests, solved["conv_id"].eqNullSafe(digests["_conv"])).select("conv_id", *COUNTS, "cost", "audit", "repaired_sha256")


def repaired_all(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """``repaired(rows)`` with a row for every id of ``conversations``: one with no row left has zeros, no audit, an empty text."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("_id")).distinct()
    found = repaired(rows)
    joined = ids.join(found, ids["_id"].eqNullSafe(found["conv_id"]), "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in (*COUNTS, "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select(F.col("_id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
