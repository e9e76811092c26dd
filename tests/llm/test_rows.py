"""Exact duplicates, conversation repair and whitening against plain versions, on awkward rows and on the smallest tables."""

from __future__ import annotations

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter

import cases
import numpy as np
import pytest

from gleaner.llm import dialogs, exact, queries, whitening
from gleaner.llm.common import table

BLANKS = re.compile(r"[\x20\x09-\x0D]+")


# ---- exact duplicates -----------------------------------------------------------------------------


def plain_groups(rows):
    groups: dict = {}
    for i, text in rows:
        groups.setdefault(hashlib.sha256(BLANKS.sub(" ", text or "").encode()).hexdigest(), []).append(i)
    out = []
    for key, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        out += [(i, ids[0], len(ids), n == 0, key) for n, i in enumerate(ids)]
    return Counter(out)


BLANK_ROWS = [(50, "a  b\tc"), (51, "a b c"), (52, " a b c"), (49, "a\n\x0b\x0c\rb c"), (53, " "), (54, " "), (55, ""), (55, ""), (-3, "a b c ")]


def test_exact_duplicates_equal_the_plain_version(spark):
    rows = cases.texts() + BLANK_ROWS
    found = exact.exact_duplicates(cases.documents(spark, rows))
    assert plain_groups(rows) == cases.counted(found.select("doc_id", *exact.ADDED).collect())
    assert set(cases.CLASH) < set(found.columns)


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_exact_duplicates_do_not_depend_on_the_batches(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice([None, *range(200)]), f"text {rng.randrange(40)}" * rng.randrange(2)) for _ in range(400)]
    found = exact.exact_duplicates(cases.documents(spark, rows), parts=parts)
    assert plain_groups(rows) == cases.counted(found.select("doc_id", *exact.ADDED).collect())


def test_exact_duplicates_of_nothing(spark):
    assert exact.exact_duplicates(cases.documents(spark, [])).collect() == []


def test_an_index_outlives_its_batches_and_its_session_entry(spark, tmp_path):
    index = exact.DigestIndex(spark, f"{tmp_path}/index", 4)
    first = exact.unique_documents(cases.documents(spark, [(5, "old"), (6, "old "), (9, "other")]), index)
    assert sorted(r.doc_id for r in first.collect()) == [5, 6, 9]
    again = exact.DigestIndex(spark, f"{tmp_path}/index", 4)  # another catalog entry for the same folder
    later = {r.doc_id: r for r in exact.exact_duplicates(cases.documents(spark, [(1, "old"), (2, "new"), (3, "new")]), again).collect()}
    assert (later[1].keep_id, later[1].kept, later[2].kept, later[3].keep_id, later[3].kept) == (5, False, True, 2, False)
    before = again.read().count()
    again.add(spark.createDataFrame([(bytearray(hashlib.sha256(b"new").digest()), 77, "x")], exact.DigestIndex.SCHEMA))
    assert again.read().count() == before == 4
    small = again.compacted(f"{tmp_path}/compact")
    assert sorted(map(tuple, small.read().collect())) == sorted(map(tuple, again.read().collect()))


def test_the_index_is_not_shuffled_and_is_joined_by_merging(spark, tmp_path):
    index = exact.DigestIndex(spark, f"{tmp_path}/index", int(spark.conf.get("spark.sql.shuffle.partitions")))
    firsts = spark.createDataFrame([(bytearray(b"x"), 1, "a")], exact.DigestIndex.SCHEMA).groupBy("digest").count()
    index.add(spark.createDataFrame([(bytearray(b"x"), 1, "a")], exact.DigestIndex.SCHEMA))
    plan = index.unseen(firsts)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and plan.count("Exchange") == 1


def test_a_text_that_most_rows_have_can_be_split(spark):
    rows = [(i, "the one text" if i % 3 else f"text {i}") for i in range(300)]
    assert plain_groups(rows) == cases.counted(exact.exact_duplicates(cases.documents(spark, rows)).select("doc_id", *exact.ADDED).collect())


# ---- conversations ----------------------------------------------------------------------------------


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def plain_repair(rows):
    """Cheapest edits by a search over (rows taken, last initials), by cost and then by audit."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
    turns = [r[1] for r in rows if r[1] is not None]
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    legal = lambda s: re.fullmatch("s?(ua)*u?", s) is not None
    queue, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, initials, out = heapq.heappop(queue)
        # how it goes on depends on the rows taken and the last initials only
        state = (i, initials[-1:], initials == "")
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            break
        if state in done:
            continue
        done.add(state)
        for role in ("user", "assistant"):
            if legal(initials + role[0]):
                heapq.heappush(queue, (cost + 2, audit + "I", i, initials + role[0], (*out, f"{role}:")))
        if i < len(rows):
            _, _, role, text = rows[i]
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, initials, out))
            if faults[i] not in ("blank", "duplicate"):
                more = int(faults[i] == "truncated")
                if role[:1] in ("s", "u", "a") and legal(initials + role[:1]):
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, initials + role[:1], (*out, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if legal(initials + new[0]):
                        heapq.heappush(queue, (cost + more + 2, audit + "R", i + 1, initials + new[0], (*out, f"{new}:{text}")))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def plain_all(rows):
    left = plain_damage(rows)
    return {conv: plain_repair([r for r in left if r[0] == conv]) for conv in {r[0] for r in rows}}


def repaired(spark, rows):
    data = [(*r, 1, "x") for r in rows]
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, cost int, signature string").repartition(5)
    found = dialogs.repaired_all(frame, dialogs.damaged(frame)).collect()
    out = {r.conv_id: tuple(r)[1:] for r in found}
    assert len(out) == len(found)
    return out


def test_repairs_equal_the_plain_search(spark):
    rng = random.Random(3)
    roles = ["system", "user", "assistant", "tool", "", None, "User", "sys", "a"]
    texts = ["Yes.", "No", " ", "", None, "Why?\n", "so it goes.\x0b", "…", "Hm!", "cut off,", " ", "日本。"]
    rows = [
        (rng.choice([None, *range(40)]), rng.choice([None, *range(-2, 9)]), rng.choice(roles if rng.random() < 0.5 else roles[:3]), rng.choice(texts))
        for _ in range(420)
    ] + [(100, k, ("user", "assistant")[k % 2], f"line {k}.") for k in range(300)]
    assert repaired(spark, rows) == plain_all(rows)


def test_repairs_of_the_smallest_tables(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = {r.conv_id: tuple(r)[1:] for r in queries.QUERIES["op12_conversation_repair"](spark, sf_dir).collect()}
    assert found == plain_all(rows)


def test_repairs_of_nothing_and_of_dropped_rows(spark):
    assert repaired(spark, []) == {}
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert repaired(spark, [(gone, 0, "user", "Hello.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_a_long_conversation_is_dealt_to_many_tasks(spark):
    rng = random.Random(8)
    rows = [(7, k // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "No", "Maybe.", f"n{k}."])) for k in range(6000)]
    assert repaired(spark, rows) == plain_all(rows)


def test_costs_of_short_signatures_equal_an_exhaustive_search():
    letters = "suaxSUAXd"
    for n in range(4):
        for code in range(len(letters) ** n):
            signature = "".join(letters[code // len(letters) ** i % len(letters)] for i in range(n))
            path = [dialogs.END]
            for symbol in reversed(signature):
                path.append(dialogs.node_of(symbol, path[-1]))
            rows = [(0, i, {"s": "system", "u": "user", "a": "assistant", "x": "tool", "d": "user"}[c.lower()], "" if c == "d" else f"{i}" if c.isupper() else f"{i}.") for i, c in enumerate(signature)]
            want = plain_repair(rows)
            assert (path[-1][dialogs.START][0], dialogs.edits_of(signature, path)) == (want[5], want[6]), signature


# ---- whitening --------------------------------------------------------------------------------------


def plain_whitening(vectors, k=8):
    """Exact sums with Python's integers, eigenpairs by a dense solver."""
    x = [[math.floor(1024 * c) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    off = [[n * c - s for c, s in zip(row, sums, strict=True)] for row in x]
    centred = np.array([[o / n for o in row] for row in off])
    v = centred.T @ centred / n
    values, vectors_ = np.linalg.eigh(v)
    values, vectors_ = values[::-1][:k], vectors_[:, ::-1][:, :k]
    return n, [sum(o * o for o in row) for row in off], centred @ vectors_ / np.sqrt(values), values / np.trace(v)


def compared(found, ids, vectors, k=8):
    n, deviations, projected, shares = plain_whitening(vectors, k)
    rows = {(r.vec_id, r.component): r for r in found}
    assert len(rows) == len(found) == len(ids) * projected.shape[1]
    got = np.array([[rows[i, c + 1].whitened for c in range(projected.shape[1])] for i in ids])
    signs = np.sign((got * projected).sum(axis=0))
    assert np.abs(got - projected * signs).max() < 1e-8
    for i, deviation in zip(ids, deviations, strict=True):
        for c, share in enumerate(shares):
            r = rows[i, c + 1]
            assert (r.n, r.deviation) == (n, deviation if deviation < 1 << 63 else None) and math.isclose(r.explained, share, rel_tol=1e-9) and r.identity_error < 1e-8
    assert len({r.identity_error for r in found}) == 1


def test_whitening_of_the_smallest_tables(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding").collect()
    compared(queries.QUERIES["op13_embedding_whitening"](spark, sf_dir).collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_whitening_leaves_out_what_is_no_vector(spark):
    rng = random.Random(5)
    good = [(i, [rng.gauss(0, 1) * (j + 1) for j in range(5)]) for i in range(60)]
    bad = [(100, None), (101, [None] * 5), (102, [1.0, float("nan"), 0.0, 0.0, 0.0]), (103, [float("inf")] * 5), (104, [1.0] * 4), (105, []), (106, [1.0, 2.0, -float("inf"), 0.0, 1.0])]
    frame = spark.createDataFrame([(i, v, 1, "c") for i, v in good + bad], "vec_id long, embedding array<double>, n int, component string").repartition(4)
    compared(whitening.whitened(frame).collect(), [i for i, _ in good], [v for _, v in good])


def test_whitening_with_repeats_ties_and_large_numbers(spark):
    corners = [[float(s if i == j else 0) for j in range(4)] for i in range(4) for s in (1, -1)]  # equal eigenvalues
    frame = spark.createDataFrame([(None if i % 2 else 1, v) for i, v in enumerate(corners * 3)], "vec_id long, embedding array<float>")
    found = whitening.whitened(frame).collect()
    assert len(found) == 24 * 4 and all(math.isclose(r.explained, 0.25) and r.identity_error < 1e-9 for r in found)
    large = [[1e15 * (i % 3 - 1), float(i), 2.0 ** (i % 7)] for i in range(20)]
    frame = spark.createDataFrame(list(enumerate(large)), "vec_id long, embedding array<double>")
    _, deviations, _, _ = plain_whitening(large)
    got = {r.vec_id: r.deviation for r in whitening.whitened(frame, components=1).collect()}
    assert got == {i: d if d < 1 << 63 else None for i, d in enumerate(deviations)}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_no_variance_gives_no_rows(spark, rows):
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert found.collect() == [] and found.columns == ["vec_id", *whitening.ADDED]


def test_columns_of_a_smaller_rank(spark):
    rng = random.Random(2)
    rows = [(i, [a := rng.gauss(0, 3), 7.0, b := rng.gauss(0, 1), 7.0, a + b]) for i in range(50)]
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in found} <= {1, 2, 3} and found[0].identity_error < 1e-6


@pytest.mark.parametrize("kind", ["decay", "clusters", "diagonal", "flat"])
def test_eigenpairs_equal_a_dense_solver(spark, kind):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    values = {
        "decay": 2.0 ** -np.arange(40), "clusters": np.repeat([5.0, 4.0, 4.0 - 1e-9, 1.0], 10), "diagonal": np.arange(1.0, 41.0), "flat": np.ones(40),
    }[kind]
    v = np.diag(values) if kind in ("diagonal", "flat") else (q * values) @ q.T
    v = (v + v.T) / 2
    want = np.sort(values)[::-1][:8]
    got, vectors = whitening.leading(spark, v, 8)
    assert np.abs(got - want).max() < 1e-12 * want[0] * 40
    assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-13 and np.linalg.norm(v @ vectors - vectors * got) < 1e-12 * want[0] * 40


def test_inertia_counts_eigenvalues_above_a_shift():
    rng = np.random.default_rng(3)
    for d in (1, 2, 5, 20):
        a = rng.standard_normal((d, d))
        a = a + a.T
        for shift in rng.standard_normal(6):
            assert whitening.inertia(a, float(shift)) == int((np.linalg.eigvalsh(a) > shift).sum())
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
