"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Vectors are put on a grid of integers, so that sums and products are exact whatever the order in which tasks add them.
One pass over the distinct vectors gives their number, sums and products, as whole numbers; the centred scatter
n * sum(x x') - S S' of d x d whole numbers is factored on the driver as L L' with the largest remaining pivot
first, down to the rank. Jacobi rotations then make the columns of L orthogonal: their squared norms are the
eigenvalues, the columns brought to length one are the components, small eigenvalues as precise as large ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.session import stage

GRID = 256
COMPONENTS = 4
LIMB_BITS, LIMBS = 30, 7  # sums of products travel as this many pieces, exact up to 2^200
BLOCK = 4096  # vectors that are multiplied at once
_EXACT = 1 << 53  # whole numbers that doubles hold


def on_grid(vector: Column, grid: int = GRID) -> Column:
    """floor(grid * c) of every entry as long; entries beyond the range of long take its end."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(grid)) * c.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all of its entries are finite numbers."""
    good = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def products(x: np.ndarray) -> np.ndarray:
    """x' x of a block of whole numbers, exact: in doubles where they hold the sums, else in Python's numbers."""
    top = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if top * top * len(x) < _EXACT:
        y = x.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    y = x.astype(object)
    return y.T.dot(y)


def limbs(values: np.ndarray) -> list[np.ndarray]:
    """Whole numbers of any size as pieces of `LIMB_BITS` bits, the last one signed."""
    out, rest = [], values
    for _ in range(LIMBS - 1):
        out.append((rest & ((1 << LIMB_BITS) - 1)).astype(np.int64))
        rest = rest >> LIMB_BITS
    return [*out, rest.astype(np.int64)]


def _rows(batch: pa.RecordBatch, column: int, d: int) -> np.ndarray:
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(lists), d)


def _sums(points: DataFrame, d: int) -> np.ndarray:
    """[[n, S], [S', sum(x x')]] over the rows of `points` (x), as whole numbers of any size.

    Every task adds up its own rows and hands on one number per pair of dimensions, in pieces that Spark sums.
    """
    at, to = np.triu_indices(d + 1)
    columns = [f"p{k}" for k in range(LIMBS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = _rows(batch, 0, d)
            for s in range(0, len(x), BLOCK):
                block = x[s : s + BLOCK]
                part = products(np.hstack([np.ones((len(block), 1), np.int64), block]))
                total = part if total is None else total + part
        if total is not None:
            pieces = limbs(total[at, to])
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int64()), pa.array(to, pa.int64()), *(pa.array(p, pa.int64()) for p in pieces)],
                names=["i", "j", *columns],
            )

    added = points.select("x").mapInArrow(run, "i long, j long, " + ", ".join(f"{c} long" for c in columns))
    added = added.groupBy("i", "j").agg(*(F.sum(c).alias(c) for c in columns))
    out = np.zeros((d + 1, d + 1), object)
    for row in added.collect():  # (d + 1) (d + 2) / 2 rows, whatever the data
        out[row.i, row.j] = out[row.j, row.i] = sum(int(row[c]) << (LIMB_BITS * k) for k, c in enumerate(columns))
    return out


def _as_long_double(values: np.ndarray) -> np.ndarray:
    """Whole numbers of any size to the precision of long doubles."""
    flat = []
    for v in values.ravel().tolist():
        sign, v = (-1 if v < 0 else 1), abs(v)
        shift = max(0, v.bit_length() - 96)
        v >>= shift
        flat.append(sign * np.ldexp(np.longdouble(v >> 48) * np.longdouble(1 << 48) + np.longdouble(v & ((1 << 48) - 1)), shift))
    return np.array(flat, np.longdouble).reshape(values.shape)


def pivoted_cholesky(scatter: np.ndarray) -> np.ndarray:
    """L of full column rank with L L' = scatter; rows in the order of `scatter`, triangular in the order of pivots."""
    rest = _as_long_double(scatter)
    d = len(rest)
    largest = rest.diagonal().max(initial=0)
    columns = []
    for _ in range(d):
        k = int(np.argmax(rest.diagonal()))
        pivot = rest[k, k]
        if pivot <= largest * d * 4 * np.finfo(np.longdouble).eps:
            break
        column = rest[:, k] / np.sqrt(pivot)
        rest = rest - np.outer(column, column)
        rest[k, :] = rest[:, k] = 0  # exactly
        columns.append(column)
    return np.array(columns, np.longdouble).reshape(len(columns), d).T


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, components as columns) of factor factor', by rotating pairs of columns until all are
    orthogonal. The pairs of one round have no column in common and are rotated at once."""
    a = factor.copy()
    r = a.shape[1]
    close = np.finfo(np.float64).eps / 8
    order = list(range(r + r % 2))  # the last one is no column if r is odd
    for _ in range(sweeps):
        worst = np.longdouble(0)
        for _ in range(len(order) - 1):
            half = len(order) // 2
            pairs = [(p, q) for p, q in zip(order[:half], order[:half - 1:-1]) if max(p, q) < r]
            p, q = (np.array(v, int) for v in zip(*pairs)) if pairs else (np.zeros(0, int),) * 2
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            off = np.abs(xy) / np.sqrt(xx * yy)
            worst = max(worst, off.max(initial=0))
            turn = off > close
            zeta = (yy - xx) / np.where(turn, 2 * xy, 1)
            t = np.where(zeta < 0, -1, 1) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            t = np.where(turn, t, 0)
            c = 1 / np.sqrt(1 + t * t)
            a[:, p], a[:, q] = c * x - c * t * y, c * t * x + c * y
            order = [order[0], order[-1], *order[1:-1]]
        if worst <= close:
            break
    values = (a * a).sum(0)
    by = np.argsort(-values, kind="stable")
    return values[by], a[:, by] / np.sqrt(values[by])


@dataclass(frozen=True)
class Whitening:
    """The fitted model: n vectors with sums `total`, and per component eigenvalue, share of the trace and direction."""

    n: int
    total: tuple[int, ...]
    values: tuple[float, ...]
    explained: tuple[float, ...]
    components: np.ndarray  # d x k

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Rows of whole numbers, centred, projected and brought to variance one."""
        return self.centred(x).astype(np.float64) / max(1, self.n) @ (self.components / np.sqrt(self.values))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        top = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
        if self.n * top + max(map(abs, self.total), default=0) < 1 << 62:
            return x * self.n - np.array(self.total, np.int64)
        return x.astype(object) * self.n - np.array(self.total, object)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Squared length of n * x - S; None where long can't hold it."""
        away = self.centred(x)
        longest = max(abs(int(away.max(initial=0))), abs(int(away.min(initial=0))))
        if longest * longest * max(1, x.shape[1]) < 1 << 63:
            away = away.astype(np.int64)
            return (away * away).sum(1).tolist()
        away = away.astype(object)
        return [v if v < 1 << 63 else None for v in (away * away).sum(1).tolist()]


def fit(points: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of the rows of `points` (x array<long> of length d), each row counted once."""
    sums = _sums(points, d)
    n, total = int(sums[0, 0]), [int(v) for v in sums[0, 1:]]
    outer = np.array(total, object)
    scatter = n * sums[1:, 1:] - np.outer(outer, outer) if d else np.zeros((0, 0), object)  # n^2 * V
    values, directions = one_sided_jacobi(pivoted_cholesky(scatter))
    trace = sum(int(scatter[i, i]) for i in range(d))
    k = min(components, len(values))
    scale = np.longdouble(n) * np.longdouble(n)
    return Whitening(
        n,
        tuple(total),
        tuple(float(v / scale) for v in values[:k]),
        tuple(float(v / np.longdouble(trace)) for v in values[:k]),
        directions[:, :k].astype(np.float64).reshape(d, k),
    )


def identity_error(points: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened rows minus the identity; 0 without components."""
    d, k = model.components.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = model.apply(_rows(batch, 0, d))
            yield pa.RecordBatch.from_arrays([pa.array(w[:, i].copy()) for i in range(k)], names=[f"w{i}" for i in range(k)])

    if not k:
        return 0.0
    white = points.select("x").mapInArrow(run, ", ".join(f"w{i} double" for i in range(k)))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    # covar_pop keeps means and centred products per task and merges those.
    row = white.agg(*(F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs)).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(row, pairs))


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    grid: int = GRID,
) -> DataFrame:
    """One row per usable row of `vectors` and component: vec_id, component, n, deviation, whitened, explained,
    identity_error.

    Rows whose vector is null or holds a null or a number that is not finite are left out, and so are those whose
    length is not the most frequent one (of equally frequent ones the longest). Vectors are put on the grid; the
    model is fitted on each distinct one once and applied to all rows, so equal vectors have equal results. Null and
    repeated ids are kept as they are; other columns are ignored. There are no more components than the rank: an
    empty table, one distinct vector and vectors of length 0 give no rows. deviation is null where it passes long.

    What reaches the driver are (d + 1) (d + 2) / 2 sums for d dimensions; the model, d times `components` numbers,
    goes out with the code.
    """
    points = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")).where(usable(F.col("v")))
    lengths = points.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0].d if lengths else 0
    points = points.where(F.size("v") == d).select("vec_id", on_grid(F.col("v"), grid).alias("x"))
    distinct = stage(points.select("x").distinct(), "whitening-points")
    model = fit(distinct, d, components)
    error = identity_error(distinct, model)
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            x = _rows(batch, 1, d)
            of = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(of)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(model.deviation(x), pa.int64()).take(pa.array(of)),
                    pa.array(model.apply(x).ravel()),
                    pa.array(np.tile(np.array(model.explained), len(x))),
                ],
                names=["vec_id", "component", "deviation", "whitened", "explained"],
            )

    kind = points.schema["vec_id"].dataType.simpleString()
    out = points.mapInArrow(run, f"vec_id {kind}, component int, deviation long, whitened double, explained double")
    return out.select(
        "vec_id",
        "component",
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(error).alias("identity_error"),
    )
