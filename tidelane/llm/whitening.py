"""Whitening of whole-number vectors along their principal components.

Every distinct vector counts once. Sums are exact; a second pass adds up the scatter of the centred
vectors, block by block in every task, and Spark adds the tasks' matrices. A pivoted Cholesky
factor of the covariance is then rotated by one-sided Jacobi until its columns are orthogonal:
their squared norms are the eigenvalues, the columns scaled to length one the components. Only
matrices of the vectors' length, and no rows, reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidelane.llm.common import stored

#: Numbers of a batch that are worked on at once.
BLOCK = 1 << 19
_LARGEST = float(1 << 62)
_HALF = 31


@dataclass
class Model:
    """Whitening of vectors of one length: ``n`` distinct ones with exact ``sums``; components are rows, eigenvalues fall."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    def __post_init__(self) -> None:
        self.floor = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = [s % self.n for s in self.sums]
        self.fraction = np.array([r / self.n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x`` less the mean; whole parts are subtracted exactly."""
        return (x - self.floor).astype(np.float64) - self.fraction

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.values)[:, None]).T

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sum over dimensions of ``(n * x - sum)**2``; None beyond 64 bits."""
        apart = x - self.floor
        largest = self.n * (float(np.abs(apart.astype(np.float64)).max(initial=0)) + 1)
        if largest * largest * x.shape[1] < _LARGEST:
            d = self.n * apart - np.array(self.rest, np.int64)
            return (d * d).sum(axis=1).tolist()
        d = self.n * apart.astype(object) - np.array(self.rest, object)
        return [s if s < 1 << 63 else None for s in (d * d).sum(axis=1).tolist()]


def grid(vector: Column, scale: int = 64, shift: int = 1_000_000) -> Column:
    """``floor(scale * x) + shift`` of each component, as double; null if one is null or not finite.

    Components beyond 2**62 / ``scale`` in absolute value count as that.
    """
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    near = lambda x: F.greatest(F.least(x.cast("double") * scale, F.lit(_LARGEST)), F.lit(-_LARGEST))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(near(x)).cast("long") + F.lit(shift).cast("long")))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of a batch that have one length: the batch, their places in it and the vectors as a matrix."""
    for batch in batches:
        longest = int(np.max(batch["vector"].value_lengths().to_numpy(), initial=1))
        rows = max(1, BLOCK // max(longest, 1))
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            sizes, flat = part["vector"].value_lengths().to_numpy(), part["vector"].flatten().to_numpy()
            for dim in np.unique(sizes).tolist():
                these = sizes == dim
                yield part, np.flatnonzero(these), flat[np.repeat(these, sizes)].reshape(int(these.sum()), dim)


def _added(vectors: DataFrame, of_block: Callable[[np.ndarray], np.ndarray], kind: str) -> dict[int, dict[tuple[int, int], int | float]]:
    """``of_block`` of all blocks, added up per length of vector: ``{length: {(row, column): sum}}``.

    A task adds its own blocks and hands over one matrix per length; Spark adds those.
    """
    whole = kind == "long"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for _, _, x in _matrices(batches):
            part = of_block(x)
            held[x.shape[1]] = held[x.shape[1]] + part if x.shape[1] in held else part
        for dim, matrix in held.items():
            rows = pa.ListArray.from_arrays(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1], pa.array(matrix.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array([dim] * len(matrix), pa.int32()), pa.array(range(len(matrix)), pa.int32()), rows], ["dim", "i", "part"])

    parts = vectors.select("vector").mapInArrow(scan, f"dim int, i int, part array<{kind}>")
    value = F.col("value").cast("decimal(38,0)") if whole else F.col("value")
    sums = parts.select("dim", "i", F.posexplode("part").alias("j", "value")).groupBy("dim", "i", "j").agg(F.sum(value).alias("s"))
    out: dict[int, dict] = {}
    for dim, i, j, s in sums.collect():
        out.setdefault(dim, {})[i, j] = int(s) if isinstance(s, Decimal) else s
    return out


def _dense(cells: dict[tuple[int, int], float]) -> np.ndarray:
    out = np.zeros((1 + max(i for i, _ in cells), 1 + max(j for _, j in cells)))
    for at, value in cells.items():
        out[at] = value
    return out


def _whole_sums(x: np.ndarray) -> np.ndarray:
    """Row count, and sums of the upper and lower parts of the numbers, none of which can leave 64 bits."""
    return np.stack([np.full(x.shape[1], len(x), np.int64), (x >> _HALF).sum(axis=0), (x & ((1 << _HALF) - 1)).sum(axis=0)])


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower triangular ``t`` and ``order`` with ``a[order][:, order] = t @ t.T``; as many columns as ``a`` has rank.

    The pivot is the largest remaining variance. A dimension of which no more than rounding is
    left, measured by its own variance, depends on those before it and gives no column.
    """
    d = len(a)
    left = a.diagonal().copy()
    least = 16 * d * np.finfo(float).eps * left
    t, order = np.zeros((d, d)), np.arange(d)
    for k in range(d):
        left[left <= least] = 0
        at = k + int(np.argmax(left[order[k:]]))
        if left[order[at]] <= 0:
            return t[:, :k], order
        order[[k, at]] = order[[at, k]]
        t[[k, at]] = t[[at, k]]
        t[k, k] = np.sqrt(left[order[k]])
        t[k + 1 :, k] = (a[order[k + 1 :], order[k]] - t[k + 1 :, :k] @ t[k, :k]) / t[k, k]
        left[order[k + 1 :]] -= t[k + 1 :, k] ** 2
        left[order[k]] = 0
    return t, order


def rotated(t: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Columns of ``t`` made orthogonal by one-sided Jacobi rotations, in rounds of disjoint pairs."""
    d, r = t.shape
    least = max(d, 1) * np.finfo(float).eps
    m = r + r % 2
    c = np.zeros((m, d))
    c[:r] = t.T
    seats = np.arange(m)
    for _ in range(sweeps if m > 1 else 0):
        turned = False
        for _ in range(m - 1):
            i, j = seats[: m // 2], seats[: m // 2 - 1 : -1]
            a, b = c[i], c[j]
            aa, bb, ab = (a * a).sum(axis=1), (b * b).sum(axis=1), (a * b).sum(axis=1)
            some = np.abs(ab) > least * np.sqrt(aa * bb)
            if some.any():
                turned = True
                zeta = (bb[some] - aa[some]) / (2 * ab[some])
                tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
                cosine = (1 / np.hypot(1, tangent))[:, None]
                sine = cosine * tangent[:, None]
                c[i[some]] = cosine * a[some] - sine * b[some]
                c[j[some]] = sine * a[some] + cosine * b[some]
            seats[1:] = np.roll(seats[1:], 1)
        if not turned:
            break
    return c[:r].T


def principal(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as rows; none for directions without variance."""
    t, order = pivoted_cholesky(covariance)
    columns = rotated(t)
    values = (columns * columns).sum(axis=0)
    first = np.argsort(-values, kind="stable")
    components = np.empty((len(first), len(covariance)))
    components[:, order] = (columns[:, first] / np.sqrt(values[first])).T
    return values[first], components


def fit(vectors: DataFrame, *, components: int = 16) -> dict[int, Model]:
    """A model for each length of vector. ``vectors`` has a column ``vector``, array<long> without nulls.

    Each distinct vector counts once; covariances are divided by their number. Constant dimensions
    and those that others determine give no component, so there are at most ``components`` of them,
    and none for a single distinct vector.
    """
    distinct = stored(vectors.select("vector").filter(F.size("vector") > 0).distinct(), "whitening")
    models = {}
    for dim, cells in _added(distinct, _whole_sums, "long").items():
        sums = [(cells[1, j] << _HALF) + cells[2, j] for j in range(dim)]
        models[dim] = Model(cells[0, 0], sums, np.ones(0), np.empty((0, dim)), 0.0)
    if not models:
        return {}

    def scatter(x: np.ndarray) -> np.ndarray:
        c = models[x.shape[1]].centred(x)
        return c.T @ c

    for dim, cells in _added(distinct, scatter, "double").items():
        model = models[dim]
        covariance = _dense(cells) / model.n
        values, rows = principal((covariance + covariance.T) / 2)
        model.values, model.components, model.trace = values[:components], rows[:components], float(covariance.trace())

    def spread(x: np.ndarray) -> np.ndarray:
        w = models[x.shape[1]].whitened(x)
        return np.vstack([w.sum(axis=0), w.T @ w])

    for dim, cells in _added(distinct, spread, "double").items():
        model = models[dim]
        if len(model.values):
            sums = _dense(cells)
            mean = sums[0] / model.n
            covariance = sums[1:] / model.n - np.outer(mean, mean)
            model.identity_error = float(np.abs(covariance - np.eye(len(mean))).max())
    return models


def whiten(vectors: DataFrame, models: dict[int, Model] | None = None, *, components: int = 16, id_col: str = "vec_id", vector_col: str = "vector") -> DataFrame:
    """``id_col``, ``n``, ``deviation``, ``whitened``, ``explained`` (arrays by component) and ``identity_error`` of each row.

    ``vector_col`` holds arrays of whole numbers (long). ``deviation`` is the exact sum of
    ``(n * x - sum)**2`` over dimensions, null beyond 64 bits. Rows with a null vector or one that
    holds null take no part. Vectors of another length are whitened apart; an empty vector has no
    components, and a length that ``models`` lacks gives none either. Rows that repeat count once
    for the model and are each returned; null ids stay. An empty table gives no rows. Other columns,
    whatever their names, are not looked at.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<long>").alias("vector"))
    rows = rows.filter(F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull()))
    found = fit(rows, components=components) if models is None else models

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, places, x in _matrices(batches):
            model = found.get(x.shape[1])
            m = len(places)
            k = len(model.values) if model else 0
            ends = pa.array(np.arange(m + 1, dtype=np.int32) * k)
            white = model.whitened(x).ravel() if k else np.empty(0)
            share = np.tile(model.values / model.trace, m) if k else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [
                    part["id"].take(pa.array(places)), pa.array([model.n if model else 0] * m, pa.int64()),
                    pa.array(model.deviation(x) if model else [None] * m, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(white)), pa.ListArray.from_arrays(ends, pa.array(share)),
                    pa.array([model.identity_error if model else None] * m, pa.float64()),
                ],
                ["id", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    return rows.mapInArrow(scan, schema).withColumnRenamed("id", id_col)
