"""Embedding whitening by contour integration (FEAST).

The rows are counted, summed and multiplied by Spark; what reaches the driver is
bounded by the square of the vectors' dimension ``d``, whatever the number of rows:

1. every entry ``c`` becomes the integer ``floor(1024 * c) + 100000``;
2. sums for each dimension (one aggregate, exact integers);
3. the covariance: rows are centred on the integer part of the mean before they
   are multiplied, the products are exact integers and are added by Spark;
   the fraction of the mean is taken off exactly, so each entry is right
   to the last bit and does not depend on how the rows are partitioned;
4. the leading eigenpairs of that ``d x d`` matrix: Sylvester's law (signs of an
   ``LDL'`` factorisation of the shifted matrix) counts the eigenvalues above any
   point, bisection cuts the upper spectrum into intervals of a few eigenvalues;
   for each interval a quadrature of ``(z I - V)^-1 Y`` over shifts ``z`` on
   a half circle projects a block ``Y`` onto its eigenspace (the solves are
   Spark tasks, one for each interval and shift), Rayleigh-Ritz extracts the
   pairs, and the projection repeats until all residuals vanish and as many
   are found as the inertia counts say, so none is missed;
5. the projections, over the root of the eigenvalue, for every row, and the
   covariance of these over all rows as a check.

Defined cases.  Rows whose vector is null, empty, or holds null or non-finite entries
are left out; so are vectors of another length than the commonest (ties: the longer).
Null ids and repeated rows are rows like any other.  Entries beyond 2**21 count as
2**21 (either sign).  Components with eigenvalue zero (to rounding) do not exist:
a table of equal rows, or an empty one, gives no rows.  Equal eigenvalues: any basis
of their space.  A deviation beyond 2**63 - 1 is null.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100000      # fixed by the contract of the query
CLAMP = 1 << 31
NODES = 8                        # quadrature points on the half circle
FEW = 4                          # eigenvalues in an interval, where a gap allows the cut
ROUNDS = 20
EXACT = 1 << 53


def complete(column: str):
    c = F.col(column)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & finite, F.lit(False))


def as_integers(column) -> np.ndarray:
    """A list column of whole vectors as rows of ``floor(1024 c) + 100000``."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.clip(np.floor(flat * SCALE), -CLAMP, CLAMP).astype(np.int64) + SHIFT
    return x.reshape(len(column), -1)


def products(y: np.ndarray) -> np.ndarray:
    """``y' y`` of integers, exactly: in doubles while every sum stays below 2**53."""
    top = int(np.abs(y).max(initial=0))
    if top * top >= EXACT:
        return y.T.astype(object) @ y.astype(object)
    step = max(1, EXACT // max(1, top * top))
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for at in range(0, len(y), step):
        part = y[at:at + step].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


# ---- spectrum of a d x d matrix ---------------------------------------------------------

def positive_count(a: np.ndarray) -> int:
    """Positive eigenvalues of a symmetric matrix: signs of the blocks of its ``LDL'``
    factorisation with the pivots of Bunch and Kaufman."""
    a, n, k, found = a.copy(), len(a), 0, 0
    alpha = (1 + 17 ** 0.5) / 8
    while k < n:
        if k == n - 1:
            return found + int(a[k, k] > 0)
        below = np.abs(a[k + 1:, k])
        r = k + 1 + int(below.argmax())
        off, own = below.max(), abs(a[k, k])
        if max(off, own) == 0:
            k += 1
            continue
        pivot, two = k, False
        if own < alpha * off:
            row = np.abs(a[r, k:])
            row[r - k] = 0
            sigma = row.max()
            if own * sigma < alpha * off * off:
                pivot, two = r, abs(a[r, r]) < alpha * sigma
        to = k + 1 if two else k
        if pivot != to:
            a[[to, pivot]] = a[[pivot, to]]
            a[:, [to, pivot]] = a[:, [pivot, to]]
        if two:
            block = a[k:k + 2, k:k + 2].copy()
            found += 1 if np.linalg.det(block) < 0 else 2 * int(block[0, 0] > 0)
            side = a[k + 2:, k:k + 2].copy()
            a[k + 2:, k + 2:] -= side @ np.linalg.solve(block, side.T)
            k += 2
        else:
            found += int(a[k, k] > 0)
            side = a[k + 1:, k].copy()
            a[k + 1:, k + 1:] -= np.outer(side, side / a[k, k])
            k += 1
    return found


def intervals(v: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """``(low, high, count)`` that hold the ``k`` largest positive eigenvalues and no
    other, but for those too close to the ``k``-th to be parted from it."""
    top = float(np.abs(v).sum(1).max(initial=0.0)) * (1 + 1e-9)
    unit = np.eye(len(v))
    above = lambda at: positive_count(v - at * unit)
    floor = top * 1e-13 * len(v)
    k = min(k, above(floor)) if top > 0 else 0
    if not k:
        return []
    low, n_low, high = floor, above(floor), top
    while n_low > k and high - low > 1e-10 * top:
        middle = (low + high) / 2
        n = above(middle)
        if n >= k:
            low, n_low = middle, n
        else:
            high = middle
    out, todo = [], [(low, top, n_low, 0)]              # ends, eigenvalues above each
    while todo:
        a, b, over_a, over_b = todo.pop()
        if over_a - over_b <= FEW or b - a < 1e-9 * top:
            out.append((a, b, over_a - over_b))
            continue
        middle = (a + b) / 2
        over = above(middle)
        todo += [part for part in ((a, middle, over_a, over), (middle, b, over, over_b)) if part[2] > part[3]]
    return sorted(out, reverse=True)


def half_circle(low: float, high: float) -> list[tuple[complex, complex]]:
    """Shifts and weights: Gauss-Legendre points on the upper half of the circle
    through both ends; the lower half is their conjugate."""
    x, w = np.polynomial.legendre.leggauss(NODES)
    radius, centre = (high - low) / 2, (high + low) / 2
    turn = radius * np.exp(1j * (np.pi / 2) * (1 - x))
    return [(complex(centre + t), complex(c * t / 2)) for t, c in zip(turn, w)]


def shifted_solve(v: np.ndarray, shift: complex, weight: complex, y: np.ndarray) -> np.ndarray:
    return (weight * np.linalg.solve(shift * np.eye(len(v)) - v, y.astype(complex))).real


def solve_here(v, work):
    return [shifted_solve(v, *w) for w in work]


def solve_on(spark: SparkSession) -> Callable:
    """The solves as Spark tasks; each gives ``d`` rows of a block's width."""
    def solve_all(v, work):
        def run(batches):
            for batch in batches:
                for i in batch.column(0).to_pylist():
                    found = shifted_solve(v, *work[i])
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([found.tobytes()], pa.binary())],
                                                     names=["id", "block"])
        rows = spark.range(0, len(work), 1, len(work)).mapInArrow(run, "id long, block binary").collect()
        blocks = {r["id"]: r["block"] for r in rows}                    # bounded: intervals x shifts x d x block
        return [np.frombuffer(blocks[i]).reshape(work[i][2].shape) for i in range(len(work))]
    return solve_all


def leading_pairs(v: np.ndarray, k: int, solve_all: Callable = solve_here) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest positive eigenvalues, falling, and unit eigenvectors (columns, the
    largest entry positive); fewer where there are fewer."""
    d, parts = len(v), intervals(v, k)
    size = float(np.abs(v).sum(1).max(initial=0.0))
    rng = np.random.default_rng(20)
    guess = {p: rng.normal(size=(d, min(d, 2 * p[2] + 4))) for p in parts}
    done: dict = {}
    for turn_no in range(ROUNDS):
        open_parts = [p for p in parts if p not in done]
        if not open_parts:
            break
        work = [(*node, guess[p]) for p in open_parts for node in half_circle(*p[:2])]
        solved = solve_all(v, work)
        for j, p in enumerate(open_parts):
            base, _ = np.linalg.qr(sum(solved[j * NODES:(j + 1) * NODES]))
            values, turn = np.linalg.eigh(base.T @ v @ base)
            vectors = base @ turn
            left = np.linalg.norm(v @ vectors - vectors * values, axis=0)
            inside = (values > p[0]) & (values <= p[1]) & (left <= 1e-12 * size)
            if inside.sum() == p[2]:                                    # the inertia's count: none is missed
                done[p] = vectors[:, inside]
            wider = min(d - vectors.shape[1], p[2] + 4) if turn_no % 5 == 4 else 0     # slow: a larger block
            guess[p] = np.hstack([vectors, rng.normal(size=(d, wider))])
    missed = [p for p in parts if p not in done]
    if missed:
        raise ArithmeticError(f"eigenpairs not verified in {missed}")
    if not parts:
        return np.zeros(0), np.zeros((d, 0))
    base, _ = np.linalg.qr(np.hstack([done[p] for p in parts]))
    values, turn = np.linalg.eigh(base.T @ v @ base)
    order = np.argsort(-values, kind="stable")[:k]
    vectors = (base @ turn)[:, order]
    vectors *= np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return values[order], vectors


# ---- rows ---------------------------------------------------------------------------------

@dataclass
class Whitening:
    n: int                       # rows of the fit list
    sums: list[int]              # for each dimension
    values: np.ndarray           # eigenvalues, falling
    vectors: np.ndarray          # d x components
    trace: float

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows less the integer part of the mean, and the rest of the sums (exact)."""
        base = np.array([s // self.n for s in self.sums], np.int64)
        return x - base, np.array([s % self.n for s in self.sums], np.int64)

    def project(self, x: np.ndarray) -> np.ndarray:
        y, rest = self.centred(x)
        return ((y - rest / self.n) @ self.vectors) / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        y, rest = self.centred(x)
        size = ((y.astype(float) * self.n - rest) ** 2).sum(1)
        if size.max(initial=0.0) < 9e18:
            return ((y * self.n - rest) ** 2).sum(1).tolist()
        exact = [sum((int(a) * self.n - int(r)) ** 2 for a, r in zip(row, rest)) for row in y]
        return [e if e < 1 << 63 else None for e in exact]


def _pairs(values: np.ndarray, kind) -> pa.RecordBatch:
    i, j = np.triu_indices(len(values))
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                       pa.array([values[a, b] for a, b in zip(i, j)], kind)], names=["i", "j", "total"])


def _symmetric(rows, d: int, dtype) -> np.ndarray:
    out = np.zeros((d, d), dtype=dtype)
    for r in rows:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["total"]
    return out


def fit(vectors: DataFrame, column: str, components: int, solve_all: Callable | None = None) -> Whitening | None:
    """``vectors``: complete rows of one length."""
    spark = vectors.sparkSession
    entry = F.floor(F.greatest(F.least(F.col("c").cast("double") * SCALE, F.lit(float(CLAMP))), F.lit(-float(CLAMP)))) + SHIFT
    rows = (vectors.select(F.posexplode(column).alias("i", "c")).groupBy("i")
            .agg(F.sum(entry).alias("total"), F.count(F.lit(1)).alias("n")).collect())          # a row for each dimension
    if not rows:
        return None
    n, d = rows[0]["n"], len(rows)
    model = Whitening(n, [r["total"] for r in sorted(rows, key=lambda r: r["i"])], np.zeros(0), np.zeros((d, 0)), 0.0)

    def multiply(batches):
        total = np.zeros((d, d), dtype=object)
        for batch in batches:
            if batch.num_rows:
                total += products(model.centred(as_integers(batch.column(0)))[0])
        total = np.array([[Decimal(int(x)) for x in row] for row in total], dtype=object)
        yield _pairs(total, pa.decimal128(38, 0))

    sums = (vectors.select(column).mapInArrow(multiply, "i int, j int, total decimal(38,0)")
            .groupBy("i", "j").agg(F.sum("total").alias("total")).collect())                       # d * (d + 1) / 2 rows
    exact = _symmetric(sums, d, object)
    rest = [s % n for s in model.sums]
    v = np.array([[float(Fraction(n * int(exact[i, j]) - rest[i] * rest[j], n * n)) for j in range(d)] for i in range(d)])
    model.values, model.vectors = leading_pairs(v, components, solve_all or solve_on(spark))
    model.trace = float(np.trace(v))
    return model


def identity_error(vectors: DataFrame, column: str, model: Whitening) -> float:
    """Largest entry of the covariance of all rows' whitened values, less the identity.
    The values are centred before they are multiplied; what rounding leaves of their
    means (about 1e-13) is taken off by the last row and column of the sums."""
    k = len(model.values)

    def multiply(batches):
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            if batch.num_rows:
                w = np.column_stack([model.project(as_integers(batch.column(0))), np.ones(batch.num_rows)])
                total += w.T @ w
        yield _pairs(total, pa.float64())

    sums = (vectors.select(column).mapInArrow(multiply, "i int, j int, total double")
            .groupBy("i", "j").agg(F.sum("total").alias("total")).collect())
    total = _symmetric(sums, k + 1, float) / model.n
    return float(np.abs(total[:k, :k] - np.outer(total[k, :k], total[k, :k]) - np.eye(k)).max())


def whiten(frame: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each complete vector and component: vec_id, component (from 1), n, deviation,
    whitened, explained, identity_error."""
    rows = frame.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                        F.col(f"`{vector_col}`").cast("array<double>").alias("vector")).filter(complete("vector"))
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    length = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.filter(F.size("vector") == (length["d"] if length else 0))
    model = fit(rows, "vector", components)
    if model is None or not len(model.values):
        return frame.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, "vector", model)
    k = len(model.values)
    share = model.values / model.trace

    def project(batches):
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = as_integers(batch.column(1))
            take = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                 pa.array(np.full(m * k, model.n), pa.int64()), pa.array(model.deviations(x), pa.int64()).take(take),
                 pa.array(model.project(x).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)
