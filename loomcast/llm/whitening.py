"""Whitening vectors with principal components found by contour integration (FEAST).

Entries are put on a whole-number grid. Sums over the rows give the mean, a second pass the
covariance of the centred rows, a matrix as wide as a vector. Its leading eigenpairs come
from spectral slices: the inertia of a shifted matrix (the signs of its pivots, in
tridiagonal form) counts the eigenvalues on each side of a cut, and bisection on these
counts places cuts in gaps so that a slice holds few. Spark deals the slices to its tasks. A task
integrates (z - V)^-1 Y over a circle through its slice's ends by quadrature, with one
complex solve for each node; this projects Y onto the eigenvectors inside the circle, and
Rayleigh-Ritz extracts them. It repeats until the residuals are at rounding level and the
number of eigenvalues found equals the slice's inertia count, so that none is missed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.llm.common import python_ready

#: Components returned at most.
COMPONENTS = 32
#: Entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Share of the largest variance below which a component is rounding noise and left out.
NOISE = 1e-11
#: Eigenvalues that bisection leaves in a slice, unless they lie too close to be parted.
SLICE = 6
#: Bisection steps, and gap below a slice as a share of its width from which it is wide.
STEPS, GAP = 52, 0.2
#: Quadrature nodes on the half circle; the other half is their mirror image.
NODES = 8
#: Subspace iterations, and residual (as a share of the largest eigenvalue) at which they end.
ROUNDS, RESIDUAL = 40, 1e-13
#: Entries that a task looks at together.
ENTRIES = 1 << 21


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the eigenvalues of a symmetric one, by reflections."""
    a = np.array(matrix, dtype=float)
    for k in range(len(a) - 2):
        column = a[k + 1 :, k]
        if not column[1:].any():
            continue
        head = -np.copysign(np.linalg.norm(column), column[0])
        v = column.copy()
        v[0] -= head
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        w = rest @ v
        w -= (v @ w) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        column[:] = 0
        column[0] = head
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy()


def below(form: tuple[np.ndarray, np.ndarray], cuts: np.ndarray) -> np.ndarray:
    """Number of eigenvalues under each cut: negative pivots of the shifted matrix (its inertia)."""
    diagonal, beside = form
    cuts = np.asarray(cuts, dtype=float)
    count = np.zeros(cuts.shape, dtype=np.int64)
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    least = max(tiny, float(np.max(beside**2, initial=0.0)) * 1e-300)
    pivot = np.ones_like(cuts)
    for k, own in enumerate(diagonal):
        pivot = own - cuts - (beside[k - 1] ** 2 / pivot if k else 0.0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot < 0
    return count


def spectral_slices(matrix: np.ndarray, components: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) of slices that hold the largest ``components`` eigenvalues, highest first.

    Bisection on inertia counts brackets the leading eigenvalues. A slice ends in the
    middle of a gap that is wide for the slice's own width, where there is one within
    ``SLICE`` eigenvalues. Eigenvalues at the noise level are left out.
    """
    size = len(matrix)
    reach = float(np.abs(matrix).sum(axis=1).max()) if size else 0.0
    if not reach > 0:
        return []
    form, known = tridiagonal(matrix), components + SLICE + 1
    while True:
        wanted = np.arange(1, min(size, known) + 1)  # k-th largest
        low, high = np.full(len(wanted), -reach), np.full(len(wanted), reach * (1 + 1e-9))
        for _ in range(STEPS):
            middle = (low + high) / 2
            reached = size - below(form, middle) >= wanted
            low, high = np.where(reached, middle, low), np.where(reached, high, middle)
        place = (low + high) / 2
        count = int((place > NOISE * place[0]).sum())
        after = np.append(place[1:], place[-1] - abs(place[0]) if len(place) == size else place[-1])
        gap = place - after
        parted = gap > 1e-9 * np.abs(place) + 1e-12 * place[0]  # closer ones stay in one slice
        if len(place) == size or count < len(place) or parted[components - 1 :].any():
            break
        known *= 2
    slices, start = [], 0
    while start < min(count, components):
        ends = [k for k in range(start, count) if parted[k]] or [count - 1]
        near = [k for k in ends if k < start + SLICE] or ends[:1]
        wide = [k for k in near if gap[k] >= GAP * (place[start] - place[k])]
        end = wide[-1] if wide else max(near, key=lambda k: gap[k] / (place[start] - place[k] + 1e-12 * place[0]))
        top = place[start] + (gap[start - 1] / 2 if start else max(gap[end], 1e-3 * place[0]))
        cut = place[end] - gap[end] / 2
        inside = int(np.diff(below(form, np.array([cut, top])))[0])
        slices.append((float(cut), float(top), inside))
        start = end + 1
    return slices


def eigenpairs_inside(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between ``low`` and ``high``, falling, and their unit eigenvectors as columns."""
    size = len(matrix)
    centre, radius = (low + high) / 2, (high - low) / 2
    scale = float(np.abs(matrix).sum(axis=1).max())
    node, weight = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * np.pi / 2 * (1 - node))
    for attempt in range(4):
        width = min(size, max(count + 4 + 4 * attempt, (3 + attempt) * count // 2 + 2))
        block, settled = np.random.default_rng(attempt).normal(size=(size, width)), 0
        for _ in range(ROUNDS):
            sums = np.zeros_like(block)
            for w, e in zip(weight, turn):
                solved = np.linalg.solve((centre + radius * e) * np.eye(size) - matrix, block)
                sums += w / 2 * (radius * e * solved).real
            basis, kept, _ = np.linalg.svd(sums, full_matrices=False)
            basis = basis[:, kept > 1e-13 * kept[0]]
            values, small = np.linalg.eigh(basis.T @ matrix @ basis)
            block = basis @ small
            inside = (values > low) & (values < high)
            own = block[:, inside]
            error = np.abs(matrix @ own - own * values[inside]).max(initial=0.0)
            if inside.sum() == count and error <= RESIDUAL * scale * np.sqrt(size):
                settled += 1
            if settled == 2:  # one round past the limit: small eigenvalues gain by it
                order = np.argsort(-values[inside])
                return values[inside][order], own[:, order]
    raise ArithmeticError(f"{count} eigenvalues between {low} and {high} did not converge")


def settled_pairs(matrix: np.ndarray, vectors: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The leading pairs of all slices' vectors together: Rayleigh-Ritz makes close ones of two slices orthogonal."""
    basis, _ = np.linalg.qr(vectors)
    values, small = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values)[:components]
    return values[order], (basis @ small)[:, order]


def leading_eigenpairs(spark: SparkSession, matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and their unit eigenvectors as columns; slices are dealt to tasks."""
    slices = spectral_slices(matrix, components)
    if not slices:
        return np.zeros(0), np.zeros((len(matrix), 0))
    shape = "value double, vector array<double>"

    def solve(batches):
        for batch in batches:
            for low, high, count in zip(*(c.to_pylist() for c in batch.columns)):
                values, vectors = eigenpairs_inside(matrix, low, high, count)
                columns = [pa.array(values), pa.array(list(vectors.T), type=pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["value", "vector"])

    # one slice a task; the matrix is as wide as a vector, whatever the number of rows
    dealt = spark.createDataFrame(slices, "low double, high double, count long").repartition(len(slices), "low")
    found = dealt.mapInArrow(solve, shape).orderBy(F.col("value").desc()).collect()
    return settled_pairs(matrix, np.array([r["vector"] for r in found]).T, components)


def _grid(batch: pa.RecordBatch, scale: float, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole-number entries of a batch's vectors one after another, each vector's size, and which can be used."""
    column = batch.column("vector")
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = pc.fill_null(column.flatten(), float("nan")).to_numpy(zero_copy_only=False) * float(scale)
    wrong = ~(np.abs(entries) < 2.0**62)  # null, not finite, or past a long
    held = np.maximum(sizes, 0)
    row = np.repeat(np.arange(len(sizes)), held)
    usable = (sizes > 0) & (np.bincount(row, weights=wrong, minlength=len(sizes)) == 0)
    whole = np.floor(np.where(wrong, 0.0, entries)).astype(np.int64) + shift
    return whole, sizes, usable


def _vectors(batches: Iterable[pa.RecordBatch], width: int, scale: float, shift: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, matrix of grid entries) of the usable vectors of ``width`` entries, in bounded parts."""
    step = max(1, ENTRIES // max(width, 1))
    for whole in batches:
        for start in range(0, whole.num_rows, step):
            batch = whole.slice(start, step)
            entries, sizes, usable = _grid(batch, scale, shift)
            usable &= sizes == width
            own = entries[np.repeat(usable, np.maximum(sizes, 0))].reshape(-1, width)
            if len(own):
                yield batch.column("id").filter(pa.array(usable)), own


def _cells(totals: np.ndarray) -> pa.RecordBatch:
    flat = totals.ravel()
    kind = pa.int64() if flat.dtype.kind == "i" else pa.float64()
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat, type=kind)], names=["cell", "total"])


def _summed(slim: DataFrame, kind: str, size: int, part) -> np.ndarray:
    """The sum over all tasks of the array of ``size`` numbers that ``part`` makes of a task's batches."""

    def run(batches):
        yield _cells(part(batches))

    sums = slim.mapInArrow(run, f"cell long, total {kind}").groupBy("cell").agg(F.sum("total").alias("total"))
    found = {row["cell"]: row["total"] for row in sums.collect()}
    return np.array([found.get(k, 0) for k in range(size)], dtype=np.int64 if kind == "long" else float)


def usual_size(slim: DataFrame, scale: float, shift: int) -> int:
    """The commonest size of usable vectors, the larger of equals; 0 without any."""

    def run(batches):
        for batch in batches:
            _, sizes, usable = _grid(batch, scale, shift)
            known, counts = np.unique(sizes[usable], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(counts)], names=["size", "n"])

    counts = slim.mapInArrow(run, "size long, n long").groupBy("size").agg(F.sum("n").alias("n"))
    first = counts.orderBy(F.col("n").desc(), F.col("size").desc()).first()
    return first["size"] if first else 0


@dataclass(frozen=True)
class Whitening:
    """Mean and leading components of a table's vectors on the grid."""

    n: int
    sums: np.ndarray  # by dimension
    variances: np.ndarray  # falling
    axes: np.ndarray  # one column for each component
    trace: float
    identity_error: float
    scale: float
    shift: int

    def centred(self, whole: np.ndarray) -> np.ndarray:
        return _centred(whole, self.n, self.sums)

    def apply(self, whole: np.ndarray) -> np.ndarray:
        return self.centred(whole) @ (self.axes / np.sqrt(self.variances))

    def deviation(self, whole: np.ndarray) -> pa.Array:
        """Sum over the dimensions of (n * x - S) ** 2, exact; null where it is past a long."""
        bound = self.n * np.abs(self.centred(whole)).max(initial=0.0) + 1
        if whole.shape[1] * bound**2 < 2.0**62 and self.n * np.abs(whole).max(initial=0) < 2.0**62:
            return pa.array(((self.n * whole - self.sums) ** 2).sum(axis=1))
        exact = ((self.n * whole.astype(object) - self.sums.astype(object)) ** 2).sum(axis=1)
        return pa.array([x if x < 2**63 else None for x in exact], type=pa.int64())


def _centred(whole: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n in doubles: the whole part of the mean is taken off exactly, then the rest."""
    near = np.array([int(s) // n for s in sums], dtype=np.int64)
    rest = np.array([(int(s) % n) / n for s in sums])
    return (whole - near) - rest


def _slim(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return python_ready(
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    )


def fit_whitening(
    vectors: DataFrame,
    components: int = COMPONENTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = SCALE,
    shift: int = SHIFT,
) -> Whitening:
    """Mean, components and the covariance error of all vectors; see ``whiten``.

    Only sums reach the driver: as many numbers as a vector has, or their square.
    """
    slim = _slim(vectors, id_col, vector_col)
    width = usual_size(slim, scale, shift)

    def added(batches) -> np.ndarray:
        parts = (np.append(x.sum(axis=0), len(x)) for _, x in _vectors(batches, width, scale, shift))
        return sum(parts, np.zeros(width + 1, dtype=np.int64))

    *sums, n = _summed(slim, "long", width + 1, added) if width else [0]
    n, sums = int(n), np.array(sums, dtype=np.int64)
    if not n:
        return Whitening(0, sums, np.zeros(0), np.zeros((width, 0)), 0.0, 0.0, scale, shift)

    def squared(project: np.ndarray | None):
        def part(batches) -> np.ndarray:
            side = width if project is None else project.shape[1]
            total = np.zeros((side, side))
            for _, x in _vectors(batches, width, scale, shift):
                y = _centred(x, n, sums)
                y = y if project is None else y @ project
                total += y.T @ y
            return total

        side = width if project is None else project.shape[1]
        found = _summed(slim, "double", side * side, part).reshape(side, side) / n
        return (found + found.T) / 2

    covariance = squared(None)
    variances, axes = leading_eigenpairs(vectors.sparkSession, covariance, components)
    error = 0.0
    if len(variances):
        white = squared(axes / np.sqrt(variances))
        error = float(np.abs(white - np.eye(len(white))).max())
    return Whitening(n, sums, variances, axes, float(np.trace(covariance)), error, scale, shift)


ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """One row per usable vector and component: the columns of ``ROWS``.

    Entry c counts as x = floor(scale * c) + shift. ``whitened`` is x - S / n projected on
    the component and divided by the root of its variance; ``explained`` the variance's
    share of the whole; ``deviation`` the sum of (n * x - S) ** 2, null where it is past a
    long; ``identity_error`` the largest entry of the whitened vectors' covariance minus
    the identity, from a pass over all of them. Components are numbered from 1 by falling
    variance; those below ``NOISE`` of the largest variance are left out, so a table
    without any variance gives no rows. Vectors that are null or empty, hold null or
    non-finite entries or ones whose x is past a long, or whose size is not the commonest,
    take no part. Repeated rows count as often as they come, ids may be null, and other
    columns are ignored, whatever their names. An empty table gives an empty result.
    """
    model = fit_whitening(vectors, components, id_col, vector_col, scale, shift)
    count = len(model.variances)
    slim = _slim(vectors, id_col, vector_col)
    names = [x.split()[0] for x in ROWS.split(", ")]

    def run(batches):
        if not count:
            return
        for ids, whole in _vectors(batches, len(model.sums), scale, shift):
            step = max(1, ENTRIES // count)
            for start in range(0, len(whole), step):
                x = whole[start : start + step]
                each = pa.array(np.repeat(np.arange(len(x)), count))
                rows = len(x) * count
                columns = [
                    ids.slice(start, step).take(each),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(rows, model.n)),
                    model.deviation(x).take(each),
                    pa.array(model.apply(x).ravel()),
                    pa.array(np.tile(model.variances / model.trace, len(x))),
                    pa.array(np.full(rows, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return slim.mapInArrow(run, ROWS)
