"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Vectors are put on an integer grid, so sums and scatter are exact whole numbers whatever the order in which tasks are
added up. Tasks add up their rows; what reaches the driver has the size of the dimension squared, not of the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.common import python_ready, table
from reviewlake.session import pin

#: Steps of the grid per unit, and what is added to keep its numbers positive.
GRID, SHIFT = 64, 1_000_000
#: Components returned.
COMPONENTS = 16
#: Whole numbers below these bounds are exact in a double and in a long.
EXACT_DOUBLE, EXACT_LONG = 1 << 53, 1 << 62

_EPS = float(np.finfo(np.float64).eps)


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: n fitted vectors, their sums, eigenvalues and components (rows), and trace of V."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The whole number nearest to each mean, and what its n-fold lacks to the sum."""
        whole = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        return np.array(whole, dtype=np.int64), np.array([s - self.n * w for s, w in zip(self.sums, whole, strict=True)], dtype=object)


def gridded(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`id`, `x`: rows whose vector is whole and finite, on the grid x = floor(GRID * entry) + SHIFT as longs.

    A null vector, one with a null, NaN or infinite entry and one without entries are dropped. If lengths differ, the
    most frequent one stays (the longest of equally frequent ones), as there is no covariance between the others.
    """
    entries = F.col(vector)
    sound = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = vectors.select(F.col(id_column).alias("id"), entries.alias("v")).filter(entries.isNotNull() & (F.size(entries) > 0) & sound)
    lengths = whole.groupBy(F.size("v").alias("d")).count()
    chosen = lengths.agg(F.max(F.struct("count", "d"))["d"].alias("d")).first()["d"]
    x = F.transform("v", lambda c: F.floor(c.cast("double") * GRID).cast("long") + SHIFT)
    return whole.filter(F.size("v") == F.lit(chosen if chosen is not None else 0)).select("id", x.alias("x"))


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _largest(y: np.ndarray) -> int:
    return int(max(y.max(), -y.min())) if y.size else 0


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """How many vectors there are, and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                safe = _largest(x) * len(x) < EXACT_LONG
                own = x.sum(axis=0).astype(object) if safe else x.astype(object).sum(axis=0)
                n, total = n + len(x), own if total is None else total + own
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total))), pa.array(np.full(len(total), n)), _decimals(total)], ["i", "n", "s"]
            )

    partial = fit.select("x").mapInArrow(add, "i long, n long, s decimal(38,0)")
    rows = sorted(partial.groupBy("i").agg(F.sum("n"), F.sum("s")).collect())  # one row per dimension
    return (rows[0][1] if rows else 0), [int(r[2]) for r in rows]


def _scatter(fit: DataFrame, whole: np.ndarray) -> dict[tuple[int, int], int]:
    """Exact upper triangle of the sum of y y', y = x less the whole number nearest to its mean."""
    upper = np.triu_indices(len(whole))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bound = None, 0

        def told():
            arrays = [pa.array(upper[0]), pa.array(upper[1]), _decimals(held[upper])]
            return pa.RecordBatch.from_arrays(arrays, ["i", "j", "s"])

        for batch in batches:
            if not batch.num_rows:
                continue
            y = _matrix(batch) - whole
            most = _largest(y) ** 2 * len(y)
            if held is not None and bound + most >= EXACT_LONG:
                yield told()
                held, bound = None, 0
            if most < EXACT_DOUBLE:
                own = (y.T.astype(np.float64) @ y.astype(np.float64)).astype(np.int64)
            elif most < EXACT_LONG:
                own = y.T @ y
            else:
                own = y.T.astype(object) @ y.astype(object)
            held, bound = own if held is None else held + own, bound + most
        if held is not None:
            yield told()

    partial = fit.select("x").mapInArrow(add, "i long, j long, s decimal(38,0)")
    return {(r[0], r[1]): int(r[2]) for r in partial.groupBy("i", "j").agg(F.sum("s")).collect()}  # d * (d + 1) / 2 rows


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """A with v = A A': rows of the lower triangular factor, put back in the order of `v`; one column per pivot.

    Each step takes the largest remaining diagonal entry. What is left of an entry counts as zero when it is within
    rounding of the entry itself, so that dimensions on very different scales keep their own.
    """
    d = len(v)
    rest, left = v.astype(np.float64).copy(), np.diag(v).astype(np.float64).copy()
    floor = left * (8 * d * _EPS)
    columns = []
    for _ in range(d):
        open_ = np.where(left > floor, left, 0.0)
        p = int(np.argmax(open_))
        if open_[p] <= 0:
            break
        column = rest[:, p] / np.sqrt(left[p])
        column[left == -np.inf] = 0.0
        rest -= np.outer(column, column)
        columns.append(column)
        left = np.where(left == -np.inf, -np.inf, np.diag(rest))
        left[p] = -np.inf
    return np.array(columns).T.reshape(d, len(columns))


def one_sided_jacobi(a: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """`a` with its columns rotated until they are orthogonal; disjoint pairs of columns turn together."""
    w = a.astype(np.float64).copy()
    n = w.shape[1]
    ring = list(range(n + n % 2))  # with an odd number, the last seat is empty
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            pairs = [(x, y) for x, y in zip(ring[:half], ring[: half - 1 : -1], strict=True) if x < n and y < n]
            p, q = (np.array(side, dtype=np.int64) for side in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
            left, right = w[:, p], w[:, q]
            alpha, beta, gamma = (left * left).sum(0), (right * right).sum(0), (left * right).sum(0)
            scale = np.sqrt(alpha * beta)
            off = np.divide(np.abs(gamma), scale, out=np.zeros_like(gamma), where=scale > 0)
            worst = max(worst, float(off.max(initial=0.0)))
            turn = off > _EPS
            safe = np.where(turn, gamma, 1.0)
            zeta = (beta - alpha) / (2 * safe)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = np.where(turn, 1 / np.hypot(1.0, t), 1.0)
            s = np.where(turn, c * t, 0.0)
            w[:, p], w[:, q] = c * left - s * right, s * left + c * right
            ring = [ring[0], ring[-1], *ring[1:-1]]
        if worst <= 4 * _EPS:
            break
    return w


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues of a covariance, falling, and its unit eigenvectors as rows (largest entry positive)."""
    w = one_sided_jacobi(pivoted_cholesky(v))
    norms = np.sqrt((w * w).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    rows = (w[:, order] / norms[order]).T
    lead = np.take_along_axis(rows, np.abs(rows).argmax(axis=1)[:, None], axis=1) if len(rows) else rows
    return norms[order] ** 2, rows * np.where(lead < 0, -1.0, 1.0) if len(rows) else rows


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The transform fitted on the vectors `x` of `fit`, each counting once per row; None if there are none."""
    python_ready(fit.sparkSession)
    n, sums = _sums(fit)
    if not n:
        return None
    blank = Whitening(n, tuple(sums), np.zeros(0), np.zeros((0, len(sums))), 0.0)
    whole, lacking = blank.centre
    found = _scatter(fit, whole)
    v = np.zeros((len(sums), len(sums)))
    for (i, j), s in found.items():
        v[i, j] = v[j, i] = (n * s - lacking[i] * lacking[j]) / (n * n)
    diagonal = sum(n * found[i, i] - lacking[i] * lacking[i] for i in range(len(sums)))
    values, rows = eigen(v)
    return Whitening(n, tuple(sums), values[:components], rows[:components], diagonal / (n * n))


def _whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    whole, lacking = model.centre
    centred = (x - whole).astype(np.float64) - (lacking / model.n).astype(np.float64)
    return centred @ (model.components / np.sqrt(model.values)[:, None]).T


def _deviation(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum over dimensions of (n * x - S) squared, exact; None where a long can't hold it."""
    whole, lacking = model.centre
    y = x - whole
    most = model.n * _largest(y) + max(abs(int(e)) for e in lacking)
    if most * most * x.shape[1] < EXACT_LONG:
        apart = y * model.n - lacking.astype(np.int64)
        return (apart * apart).sum(axis=1).tolist()
    apart = y.astype(object) * model.n - lacking
    return [s if s < 1 << 63 else None for s in (apart * apart).sum(axis=1)]


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of (covariance of the whitened fit vectors - identity)."""
    k = len(model.values)
    if not k:
        return 0.0

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = _whitened(_matrix(batch), model)
                first += w.sum(axis=0)
                second += w.T @ w
        i, j = np.indices((k, k + 1)).reshape(2, -1)
        flat = np.concatenate((second, first[:, None]), axis=1).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(flat)], ["i", "j", "s"])

    partial = fit.select("x").mapInArrow(add, "i long, j long, s double")
    whole = np.zeros((k, k + 1))
    for i, j, s in partial.groupBy("i", "j").agg(F.sum("s")).collect():  # k * (k + 1) rows
        whole[i, j] = s / model.n
    mean = whole[:, k]  # the vectors are centred before they are projected: this only takes out rounding
    return float(np.abs(whole[:, :k] - np.outer(mean, mean) - np.eye(k)).max())


def whitened(vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of each sound vector and component.

    The transform is fitted on each distinct gridded vector once. Repeated rows are returned each, with equal values;
    an id may be null. Directions without variance have no component, so constant vectors, or fewer distinct vectors
    than components, give fewer rows (one distinct vector or an empty table: none). Other columns are not read.
    """
    spark = vectors.sparkSession
    python_ready(spark)
    rows = gridded(vectors, id_column, vector)
    fit = pin(rows.select("x").distinct())
    model = fit_whitening(fit, components)
    id_type = vectors.schema[id_column].dataType
    schema = T.StructType(
        [
            T.StructField("vec_id", id_type),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    error = identity_error(fit, model)
    k = len(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            n = len(x)
            each = pa.array(np.repeat(np.arange(n), k))
            columns = [
                batch.column("id").take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                pa.array(np.full(n * k, model.n)),
                pa.array(_deviation(x, model), pa.int64()).take(each),
                pa.array(_whitened(x, model).ravel()),
                pa.array(np.tile(model.values / model.trace, n)),
                pa.array(np.full(n * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(project, schema)


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
