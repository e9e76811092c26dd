"""Whitening of embeddings: leading components of their covariance by contour integration."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import Batches, map_batches

#: Columns that ``whitened`` adds, in place of any that ``embeddings`` has by these names.
ADDED = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
#: The vector's name while it is worked on.
VECTOR = "_gleaner_vector"
#: Entries become long numbers: floor of so many times the entry, and an offset.
SCALE, OFFSET = 1024, 100_000
#: Quadrature nodes on the upper half of each contour, and rounds of refinement at most.
NODES, ROUNDS = 16, 30
#: An interval with more eigenvalues is cut, unless it is as narrow as this share of the largest one.
WIDEST, NARROW = 12, 1e-9
#: Residuals, in shares of the largest eigenvalue, at which eigenpairs are done; directions below ``FLAT`` have no variance.
EXACT, FLAT = 1e-12, 1e-12
#: Numbers of at most so many are exact in 64 bits; beyond them Python's own integers are used.
FITS = 1 << 62


# ---- reading vectors ----------------------------------------------------------------------------


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is not null and holds neither nulls nor other than finite numbers."""
    cell = F.col(f"`{vector}`")
    finite = F.forall(cell, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != F.lit(math.inf)))
    return embeddings.where(cell.isNotNull() & finite)


def dimension_of(rows: DataFrame, vector: str = "embedding") -> int:
    """The most frequent length of a vector; of lengths as frequent, the largest. 0 without rows."""
    sizes = rows.groupBy(F.size(f"`{vector}`").alias("d")).agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return first.d if first else 0


def _numbers(column: pa.Array, d: int) -> np.ndarray:
    """The vectors of a batch as whole numbers, a row each; in Python's integers where 64 bits may not do."""
    c = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    whole = np.floor(SCALE * c)
    if len(c) and np.abs(whole).max() >= 2.0**53:
        at_most = np.clip(whole, -(2.0**63), 2.0**63 - 1024)  # a long holds no more
        return np.array([[int(v) + OFFSET for v in row] for row in at_most], object).reshape(-1, d)
    return whole.astype(np.int64) + OFFSET


@dataclass
class Centre:
    """The number of vectors and the exact sums of their entries."""

    n: int
    sums: list[int]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exactly."""
        most = max((abs(int(v)) for v in (x.min(), x.max())), default=0) if x.size else 0
        exact = np.int64 if self.n * most + max(map(abs, self.sums), default=0) < FITS else object
        return x.astype(exact) * self.n - np.array(self.sums, exact)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.n


def centre_of(rows: DataFrame, vector: str, d: int) -> Centre:
    """Exact sums: each task adds up its vectors, and one row for each task and dimension is added after that."""

    def run(batches: Batches) -> Batches:
        n, sums = 0, [0] * d
        for batch in batches:
            x = _numbers(batch.column(0), d)
            n += len(x)
            small = x.dtype == object or not len(x) or int(np.abs(x).max()) * len(x) < FITS
            sums = [a + int(b) for a, b in zip(sums, x.sum(axis=0) if small else x.astype(object).sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array([str(s) for s in sums], pa.string())], names=["i", "n", "s"])

    parts = map_batches(rows.select(vector), run, "i int, n long, s string")
    total = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38, 0)")).cast("string").alias("s")).orderBy("i").collect()  # a row a dimension
    return Centre(total[0].n, [int(r.s) for r in total]) if total else Centre(0, [0] * d)


def _added(partials: DataFrame, width: int) -> np.ndarray:
    """Sums of partial matrix rows ``(i, v)``: row numbers are dealt out, and each task holds only its own rows' sums."""

    def run(batches: Batches) -> Batches:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for i, v in zip(batch.column(0).to_pylist(), values, strict=True):
                held[i] = held[i] + v if i in held else v.copy()
        yield _rows(sorted(held), [held[i] for i in sorted(held)])

    got = map_batches(partials.repartition("i"), run, "i int, v array<double>").toArrow()  # a row a dimension
    out = np.zeros((width, width))
    for i, v in zip(got.column("i").to_pylist(), got.column("v").to_pylist(), strict=True):
        out[i] = v
    return out


def _rows(numbers: list[int], rows: list[np.ndarray] | np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array([r.tolist() for r in rows], pa.list_(pa.float64()))], names=["i", "v"])


def covariance(rows: DataFrame, vector: str, d: int, centre: Centre, project: np.ndarray | None = None) -> np.ndarray:
    """The covariance, divisor n, of the vectors or of their projections, centred before anything is multiplied.

    Vectors are centred by their exact mean, so projections are too, up to rounding; what is left of their mean is taken off
    by the tasks' own means.
    """
    width = d if project is None else project.shape[1]

    def run(batches: Batches) -> Batches:
        total, weight, mean = np.zeros((width, width)), 0, np.zeros(width)
        for batch in batches:
            y = centre.centred(_numbers(batch.column(0), d))
            y = y if project is None else y @ project
            if not len(y):
                continue
            own = y.mean(axis=0)
            shift = own - mean
            y = y - own
            total += y.T @ y + np.outer(shift, shift) * (weight * len(y) / (weight + len(y)))
            weight += len(y)
            mean += shift * (len(y) / weight)
        # the mean of all is zero: a task's spread about it is its own spread and its mean's square
        yield _rows(list(range(width)), total + weight * np.outer(mean, mean))

    return _added(map_batches(rows.select(vector), run, "i int, v array<double>"), width) / max(centre.n, 1)


# ---- eigenpairs by contour integration ------------------------------------------------------------


def inertia(v: np.ndarray, shift: float) -> int:
    """The number of eigenvalues of ``v`` above ``shift``: positive pivots of a symmetric factorisation, in blocks of one or two."""
    a = v - shift * np.eye(len(v))
    above, bound = 0, (1 + math.sqrt(17)) / 8
    while len(a):
        off = np.abs(a - np.diag(np.diag(a)))
        p = int(np.argmax(np.abs(np.diag(a))))
        q, r = np.unravel_index(int(np.argmax(off)), off.shape)
        if abs(a[p, p]) >= bound * off[q, r]:
            if a[p, p] == 0:
                return above  # nothing but zeros is left
            pivot = [p]
            above += int(a[p, p] > 0)
        else:
            pivot = [int(q), int(r)]
            above += 1  # a block of two with a larger corner has one eigenvalue of each sign
        rest = np.setdiff1d(np.arange(len(a)), pivot)
        a = a[np.ix_(rest, rest)] - a[np.ix_(rest, pivot)] @ np.linalg.solve(a[np.ix_(pivot, pivot)], a[np.ix_(pivot, rest)])
        a = (a + a.T) / 2
    return above


def intervals(v: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals ``(low, high, eigenvalues in it)`` that together hold the ``wanted`` largest eigenvalues of ``v``, by inertia counts alone."""
    scale = float(np.abs(v).sum(axis=0).max())  # no eigenvalue is larger
    high, low = scale * 1.01, -scale * 0.01
    inside = lambda a, b: a + (b - a) * 0.4637  # noqa: E731  no round share: eigenvalues often are round numbers
    bottom, top, counted = low, high, len(v)
    while counted > wanted and top - bottom > NARROW * scale:
        middle = inside(bottom, top)
        n = inertia(v, middle)
        if n >= wanted:
            bottom, counted = middle, n
        else:
            top = middle
    out, open_ = [], [(bottom, high, counted, 0)]
    while open_:
        a, b, n_low, n_high = open_.pop()
        n = n_low - n_high
        if n <= 0:
            continue
        if n <= WIDEST and b - a < 0.75 * scale or b - a <= NARROW * scale:
            out.append((a, b, n))
            continue
        middle = inside(a, b)
        n_middle = inertia(v, middle)
        open_ += [(a, middle, n_low, n_middle), (middle, b, n_middle, n_high)]
    return sorted(out)


def _filtered(spark: SparkSession, v: np.ndarray, spans: list[tuple[float, float, int]], bases: list[np.ndarray]) -> list[np.ndarray]:
    """Each basis after the spectral projection onto its interval: a complex solve for each interval and node, dealt out to tasks."""
    points, weights = np.polynomial.legendre.leggauss(NODES)
    shared = spark.sparkContext.broadcast((v, bases, spans))  # a matrix of dimensions, not of rows

    def run(batches: Batches) -> Batches:
        matrix, starts, cuts = shared.value
        for batch in batches:
            for k in batch.column(0).to_pylist():
                at, node = divmod(k, NODES)
                low, high, _ = cuts[at]
                turn = np.exp(1j * math.pi / 2 * (points[node] + 1)) * (high - low) / 2
                solved = np.linalg.solve(((low + high) / 2 + turn) * np.eye(len(matrix)) - matrix, starts[at].astype(complex))
                part = np.real(turn * solved) * (weights[node] / 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at], pa.int32()), pa.array([node], pa.int32()), pa.array([part.ravel().tolist()], pa.list_(pa.float64()))], names=["at", "node", "v"]
                )

    tasks = len(spans) * NODES
    got = map_batches(spark.range(0, tasks, 1, min(tasks, 2 * spark.sparkContext.defaultParallelism)), run, "at int, node int, v array<double>").collect()
    out = [np.zeros_like(b) for b in bases]
    for r in sorted(got, key=lambda r: (r.at, r.node)):
        out[r.at] += np.array(r.v).reshape(out[r.at].shape)
    shared.destroy()
    return out


def leading(spark: SparkSession, v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of ``v``, falling, and their unit eigenvectors as columns.

    Inertia counts choose intervals. In each, a random basis, over twice the interval's count, is projected by quadrature of
    shifted solves along a circle round the interval; a Rayleigh-Ritz step extracts pairs; both repeat until every interval
    has as many pairs as its inertia counts, all with residuals at rounding level. If that fails it is an error: none is missed.
    """
    d = len(v)
    wanted = min(wanted, d)
    if not wanted:
        return np.zeros(0), np.zeros((d, 0))
    spans, rng, scale = intervals(v, wanted), np.random.default_rng(20), float(np.abs(v).sum(axis=0).max())
    bases = [rng.standard_normal((d, min(d, 2 * n + 8))) for _, _, n in spans]
    for _ in range(ROUNDS):
        bases = [np.linalg.qr(b)[0] for b in _filtered(spark, v, spans, bases)]
        good, done = [], True
        for i, (low, high, n) in enumerate(spans):
            values, small = np.linalg.eigh(bases[i].T @ v @ bases[i])
            bases[i] = bases[i] @ small
            inside = (values > low) & (values <= high)
            off = np.linalg.norm(v @ bases[i][:, inside] - bases[i][:, inside] * values[inside], axis=0)
            done &= int(inside.sum()) == n and bool((off <= EXACT * scale).all())
            good.append(bases[i][:, inside])
        if done:
            # one step for all intervals together makes vectors of different intervals orthogonal to the last digit
            joint = np.linalg.qr(np.column_stack(good))[0]
            values, small = np.linalg.eigh(joint.T @ v @ joint)
            return values[::-1][:wanted].copy(), (joint @ small)[:, ::-1][:, :wanted].copy()
    raise ArithmeticError(f"contour integration missed eigenvalues: {[n for _, _, n in spans]} were counted")


# ---- whitening ------------------------------------------------------------------------------------


def whitened(embeddings: DataFrame, components: int = 8, vector: str = "embedding") -> DataFrame:
    """A row for each usable vector and component: all columns but the vector, with ``component`` (from 1), ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``.

    An entry c counts as x = floor(1024 c) + 100000, within a long. ``n`` vectors are fitted, with sums S. ``deviation`` is the exact sum of
    (n x - S)^2, null if a long cannot hold it; ``whitened`` the centred vector's coordinate on the component over the root of its eigenvalue;
    ``explained`` the eigenvalue's share of the trace; ``identity_error`` the largest absolute entry of the measured covariance of
    ``whitened`` minus the identity.

    Vectors that are null or hold a null or a number that is not finite are left out, and so are those of another length than most.
    Directions without variance (less than 1e-12 of the trace) are no components: equal vectors only, one vector or an
    empty table give no rows. Repeated rows and null ids count and come out as often as they go in. Equal eigenvalues have any
    orthonormal vectors, the same for all rows. Columns of the added names in ``embeddings`` are replaced.

    Three passes read the vectors: exact sums, centred products, and the products of the projections; a matrix of dimensions,
    never one of rows, comes to the driver.
    """
    spark = embeddings.sparkSession
    rows = usable(embeddings.drop(*(c for c in ADDED if c != vector)), vector)
    d = dimension_of(rows, vector)
    others = [f for f in rows.schema if f.name != vector]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), "component int, n long, deviation long, whitened double, explained double, identity_error double"])
    if not d:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size(f"`{vector}`") == d)
    vectors = rows.select(F.col(f"`{vector}`").alias(VECTOR))
    centre = centre_of(vectors, VECTOR, d)
    v = covariance(vectors, VECTOR, d, centre)
    v = (v + v.T) / 2
    trace = float(np.trace(v))
    values, found = leading(spark, v, components) if trace > 0 else (np.zeros(0), np.zeros((d, 0)))
    real = values > FLAT * trace
    values, found = values[real], found[:, real]
    if not len(values):
        return spark.createDataFrame([], schema)
    onto = found / np.sqrt(values)
    measured = covariance(vectors, VECTOR, d, centre, onto)
    error = float(np.abs(measured - np.eye(len(values))).max())
    shares = (values / trace).tolist()
    k = len(values)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            x = _numbers(batch.column(VECTOR), d)
            off = centre.deviations(x)
            y = (off.astype(np.float64) / centre.n) @ onto
            # squares of 64-bit numbers may not fit: those go by Python's integers
            small = off.dtype != object and off.size and int(np.abs(off).max()) < math.isqrt(FITS // d)
            squares = [int(s) for s in ((off if small else off.astype(object)) ** 2).sum(axis=1)]
            exact = pa.array([s if s < 1 << 63 else None for s in squares], pa.int64())
            each = pa.array(np.repeat(np.arange(len(x)), k))
            count = len(x) * k
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i).take(each) for i, f in enumerate(others)),
                    pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(count, centre.n), pa.int64()),
                    exact.take(each),
                    pa.array(y.ravel(), pa.float64()),
                    pa.array(np.tile(shares, len(x)), pa.float64()),
                    pa.array(np.full(count, error), pa.float64()),
                ],
                names=[*(f.name for f in others), *ADDED],
            )

    given = rows.select(*[F.col(f"`{f.name}`") for f in others], F.col(f"`{vector}`").alias(VECTOR))
    return map_batches(given, run, schema)
