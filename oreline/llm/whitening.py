"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Entries are put on a grid of whole numbers, so sums and deviations are exact. The scatter of the distinct vectors is summed over tasks
after centring; only this matrix (dimensions squared) reaches the driver. It is factored by Cholesky with the largest diagonal entry as
pivot, and the columns of the triangular factor are rotated until they are orthogonal: their squared lengths are the eigenvalues
and, scaled to one, they are the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import keep_table
from .columns import field, pick

#: A grid value beyond this is written as this, so that it fits a long (entries up to 7e13 at the usual scale are far from it).
FARTHEST = 1 << 52
#: Rows multiplied at once, rotations sweeps at most, and the cosine under which two columns count as orthogonal.
ROWS, SWEEPS, ORTHOGONAL = 4096, 60, 1e-15


def on_grid(vec: Column, scale: int = 64, shift: int = 1_000_000) -> Column:
    """array<long>: floor(scale * entry) + shift."""
    most = float(FARTHEST)
    return F.transform(vec, lambda c: F.greatest(F.lit(-most), F.least(F.lit(most), F.floor(c.cast("double") * scale) + F.lit(float(shift)))).cast("long"))


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """Factor L with rows in the given order and L L' = matrix; one column per pivot, as many as the rank. Pivots stop where what is left of
    the diagonal is rounding."""
    n = len(matrix)
    left, factor, order = np.diag(matrix).astype(float).copy(), np.zeros((n, n)), []
    least = n * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    for k in range(n):
        at = int(left.argmax())
        if not left[at] > least:
            return factor[:, :k]
        column = matrix[:, at] - factor[:, :k] @ factor[at, :k]
        column[order] = 0.0
        factor[:, k] = column / np.sqrt(column[at])
        left -= factor[:, k] ** 2
        order.append(at)
        left[order] = -np.inf
    return factor


def rounds_of_pairs(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every pair of n columns once, in rounds of disjoint pairs."""
    ring, out = list(range(n + n % 2)), []
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[:len(ring) // 2], ring[::-1]) if a < n and b < n]
        if pairs:
            out.append(tuple(np.array(side) for side in zip(*pairs)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of factor @ factor.T, by rotating the factor's columns."""
    work = factor.copy()
    for _ in range(SWEEPS):
        worst = 0.0
        for p, q in rounds_of_pairs(work.shape[1]):
            x, y = work[:, p], work[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            scale = np.sqrt(xx * yy)
            off = np.abs(xy) > ORTHOGONAL * scale
            if not off.any():
                continue
            worst = max(worst, float((np.abs(xy[off]) / scale[off]).max()))
            tau = (yy[off] - xx[off]) / (2 * xy[off])
            t = np.where(tau >= 0, 1.0, -1.0) / (np.abs(tau) + np.hypot(1.0, tau))
            c = 1 / np.hypot(1.0, t)
            s = c * t
            a, b = x[:, off], y[:, off]
            work[:, p[off]], work[:, q[off]] = c * a - s * b, s * a + c * b
        if worst <= 8 * ORTHOGONAL:
            break
    values = (work * work).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order], work[:, order] / np.sqrt(values[order])


@dataclass
class Whitening:
    """Fit of one dimension: number of distinct vectors, sums, eigenvalues, components as columns, trace and the largest entry by which
    the covariance of the whitened vectors differs from the identity."""
    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    def __post_init__(self):
        # z = n * x - sums = n * (x - floor(mean)) - rest, in small numbers
        self.floors = np.array([s // self.n for s in self.sums], np.int64)
        self.rests = [s - self.n * (s // self.n) for s in self.sums]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly: 64-bit numbers where they fit, else Python's."""
        step = x - self.floors
        if len(x) and int(np.abs(step).max()) < (1 << 62) // self.n:
            return step * np.int64(self.n) - np.array(self.rests, np.int64)
        return step.astype(object) * self.n - np.array(self.rests, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)

    def squares(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of squared deviations; none where a long can't hold it."""
        z = self.deviations(x)
        if z.dtype == np.int64 and z.size and int(np.abs(z).max()) ** 2 * z.shape[1] < 1 << 63:
            return (z * z).sum(axis=1).tolist()
        found = [sum(int(v) ** 2 for v in row) for row in z]
        return [v if v < 1 << 63 else None for v in found]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, rows x dimension) for each dimension among the lists of a column."""
    sizes = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten())
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, flat[starts[at][:, None] + np.arange(size)]


def added(rows: DataFrame, of_block, kind: str) -> dict[int, dict[tuple[int, int], object]]:
    """Sums over all rows of matrices that ``of_block`` makes of a block of vectors of one dimension: {dimension: {(i, j): sum}}.

    A task sums its blocks, tasks are summed entry by entry; the sums alone reach the driver.
    """
    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                for _, x in matrices(batch.column(0).slice(at, ROWS)):
                    found = of_block(x)
                    sums[x.shape[1]] = sums[x.shape[1]] + found if x.shape[1] in sums else found
        for dim, total in sums.items():
            for i, row in enumerate(total):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim] * len(row), pa.int64()), pa.array([i] * len(row), pa.int64()), pa.array(range(len(row)), pa.int64()),
                     pa.array([str(v) for v in row.tolist()] if kind.startswith("decimal") else row, pa.string() if kind.startswith("decimal") else pa.float64())],
                    names=["dim", "i", "j", "v"])

    sent = "string" if kind.startswith("decimal") else "double"
    total = rows.mapInArrow(partial, f"dim long, i long, j long, v {sent}").groupBy("dim", "i", "j").agg(F.sum(F.col("v").cast(kind)).alias("v"))
    out: dict[int, dict[tuple[int, int], object]] = {}
    for r in total.collect():
        out.setdefault(r.dim, {})[r.i, r.j] = r.v
    return out


def fit(points: DataFrame) -> dict[int, Whitening]:
    """A fit per dimension for distinct vectors (one column x array<long>). What reaches the driver grows with the dimension only."""
    def sums(x):
        wide = x.astype(object) if x.size and int(np.abs(x).max()) * len(x) >= 1 << 62 else x
        return np.vstack([np.asarray(wide.sum(axis=0), dtype=object), np.full(x.shape[1], len(x), dtype=object)])

    fits = {}
    for dim, entries in added(points, sums, "decimal(38,0)").items():
        if dim:
            fits[dim] = Whitening(int(entries[1, 0]), [int(entries[0, j]) for j in range(dim)], np.empty(0), np.empty((dim, 0)), 0.0)

    def scatter(x):
        centred = fits[x.shape[1]].centred(x) if x.shape[1] in fits else np.zeros((len(x), 0))
        return centred.T @ centred

    for dim, entries in added(points, scatter, "double").items():
        one = fits[dim]
        covariance = np.array([[entries[min(i, j), max(i, j)] for j in range(dim)] for i in range(dim)]) / one.n
        one.trace = float(np.trace(covariance))
        one.values, one.components = one_sided_jacobi(pivoted_cholesky(covariance))
    return fits


def measure(points: DataFrame, fits: dict[int, Whitening], k: int) -> None:
    """Sets ``identity_error`` from the whitened vectors' own covariance over all points, for the first k components."""
    def kept(x):
        one = fits.get(x.shape[1])
        return np.zeros((len(x), 0)) if one is None else one.whiten(x)[:, :k]

    means = {}
    for dim, entries in added(points, lambda x: kept(x).sum(axis=0)[None], "double").items():
        means[dim] = np.array([entries[0, j] for j in range(min(k, len(fits[dim].values)))]) / fits[dim].n

    def scatter(x):
        centred = kept(x) - means[x.shape[1]] if x.shape[1] in means else kept(x)
        return centred.T @ centred

    for dim, entries in added(points, scatter, "double").items():
        size = len(means[dim])
        found = np.array([[entries[i, j] for j in range(size)] for i in range(size)]) / fits[dim].n
        fits[dim].identity_error = float(np.abs(found - np.eye(size)).max())


def whitened(vectors: DataFrame, k: int = 16, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): up to k rows per row of ``vectors``, components from 1 by falling
    eigenvalue.

    Rows whose vector is null or holds null or non-finite entries are dropped. The fit counts each distinct grid vector once; vectors of
    different dimensions are fitted apart. A component without variance (fewer distinct vectors than dimensions, or one vector alone)
    can't be whitened and has no row, nor has a vector without entries. Repeated rows and null ids are rows like any other, equal
    eigenvalues keep the order the rotations left them in, ``deviation`` is null where it passes a long. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = pick(vectors, id_=id_col, vec=vec_col)
    finite = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec").isNotNull() & F.coalesce(finite, F.lit(False))).select(F.col("id_"), on_grid(F.col("vec"), scale, shift).alias("x"))
    points = keep_table(rows.select("x").distinct(), "points")
    fits = fit(points)
    measure(points, fits, k)
    shared = spark.sparkContext.broadcast(fits)  # two matrices a dimension at most

    def shown(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                for at, x in matrices(part.column(1)):
                    one = shared.value.get(x.shape[1])
                    size = 0 if one is None else min(k, len(one.values))
                    if not size:
                        continue
                    yield pa.RecordBatch.from_arrays([
                        part.column(0).take(pa.array(np.repeat(at, size))), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(len(at) * size, one.n)), pa.array([v for v in one.squares(x) for _ in range(size)], pa.int64()),
                        pa.array(one.whiten(x)[:, :size].ravel()), pa.array(np.tile(one.values[:size] / one.trace, len(at))),
                        pa.array(np.full(len(at) * size, one.identity_error))],
                        names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    long, double = T.LongType(), T.DoubleType()
    return rows.mapInArrow(shown, T.StructType([
        T.StructField(id_col, field(rows, "id_").dataType), T.StructField("component", T.IntegerType()), T.StructField("n", long), T.StructField("deviation", long),
        T.StructField("whitened", double), T.StructField("explained", double), T.StructField("identity_error", double)]))
