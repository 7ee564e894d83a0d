"""Least squares from summed cross-products.

A regression needs only Z'Z.  It is a sum over rows, so tasks build it from blocks
of a series and Spark adds the blocks up; a small solve per key follows.  One
matrix at the largest lag serves every smaller model on the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.functions.blocks import BLK, Cut, spread
from loomcast.functions.grouped import per_group
from loomcast.functions.joins import match

CHUNK = 65_536
NARROW = 20
CHUNK_VALUES = 4_000_000
LAGGED = (100,)  # specs whose matrix is Z(t)'Z(t-1), not symmetric
Values = dict[str, np.ndarray]
Design = Callable[[Values, int, int, int, int], dict[int, np.ndarray]]


@dataclass
class Solved:
    """Coefficients of one least-squares fit."""

    coef: np.ndarray
    se: np.ndarray
    rss: float
    n: int

    @property
    def aic(self) -> float:
        return self.n * np.log(max(self.rss, 1e-300) / self.n) + 2 * (len(self.coef) + 1)

    @property
    def bic(self) -> float:
        return self.n * np.log(max(self.rss, 1e-300) / self.n) + np.log(self.n) * (len(self.coef) + 1)


def _scaled(gram: np.ndarray, columns: list[int], target: int):
    a, b = gram[np.ix_(columns, columns)], gram[columns, target]
    scale = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
    return a / np.outer(scale, scale), b / scale, scale


def solve(gram: np.ndarray, columns: Sequence[int], target: int, n: int) -> Solved | None:
    """Regress ``target`` on ``columns`` of a cross-product matrix; None if it cannot be solved."""
    columns = list(columns)
    if n <= len(columns):
        return None
    a, b, scale = _scaled(gram, columns, target)
    try:
        np.linalg.cholesky(a)
        inverse = np.linalg.inv(a)
    except np.linalg.LinAlgError:
        inverse = np.linalg.pinv(a, hermitian=True)
    coef = inverse @ b
    rss = max(float(gram[target, target] - coef @ b), 0.0)
    free = n - len(columns)
    se = np.sqrt(np.maximum(np.diag(inverse), 0.0) * rss / free)
    return Solved(coef / scale, se / scale, rss, n)


def residual_sum(gram: np.ndarray, columns: Sequence[int], target: int) -> float:
    """Residual sum of squares alone."""
    a, b, _ = _scaled(gram, list(columns), target)
    try:
        root = np.linalg.cholesky(a)
        part = np.linalg.solve(root, b)
        explained = part @ part
    except np.linalg.LinAlgError:
        explained = b @ np.linalg.pinv(a, hermitian=True) @ b
    return max(float(gram[target, target] - explained), 0.0)


@dataclass
class Summed:
    """What a solver gets per key: one matrix per spec and the first values of each column."""

    grams: dict[int, np.ndarray]
    head: Values
    first: pd.Series


def _chunked(values: Values, design: Design, start: int, stop: int, offset: int, total: int):
    """Sum of Z'Z per spec over rows ``start`` … ``stop`` in chunks that fit memory."""
    grams: dict[int, np.ndarray] = {}
    for begin in range(start, stop, CHUNK):
        for spec, z in design(values, begin, min(begin + CHUNK, stop), offset, total).items():
            part = z[0].T @ z[1] if isinstance(z, tuple) else z.T @ z
            grams[spec] = grams[spec] + part if spec in grams else part
    return grams


def lagged_fit(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    columns: Sequence[str],
    reach: int,
    design: Design,
    solver: Callable[[Summed], pd.DataFrame],
    extra: str,
    carry: Sequence[str] = (),
    head: int = 0,
    size: int | None = None,
) -> DataFrame:
    """Fit models on lagged columns: one result frame per key.

    ``design(values, start, stop, offset, total)`` gives the matrix of each spec
    for rows ``start … stop`` of ``values`` (a pair of matrices for a product of
    two); ``offset`` is the position of the
    first value and ``total`` the series length, read from column ``_n``.
    ``carry`` are columns constant per key.  A bounded series does all of it in
    its own task; others sum blocks first.
    """
    keys = list(keys)
    cut = Cut(df.select(*keys, pos, "_n", *columns, *carry), keys, pos, before=reach, size=size)
    width = cut.size

    def values_of(pdf: pd.DataFrame) -> Values:
        return {c: pdf[c].to_numpy(float) for c in columns}

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos, ignore_index=True)
        values = values_of(pdf)
        grams = _chunked(values, design, 0, len(pdf), 0, int(pdf["_n"].iloc[0]))
        return solver(Summed(grams, {c: v[:head] for c, v in values.items()}, pdf.iloc[0]))

    if cut.whole:
        return per_group(spread(cut.rows, keys), keys, keys, extra, whole)

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos, ignore_index=True)
        at = pdf[pos].to_numpy()
        number = int(pdf[BLK].iloc[0])
        start = int(np.searchsorted(at, number * width))
        stop = int(np.searchsorted(at, (number + 1) * width))
        values = values_of(pdf)
        grams = _chunked(values, design, start, stop, int(at[0]), int(pdf["_n"].iloc[0]))
        parts = [pd.DataFrame({"spec": [], "r": [], "c": [], "s": []})]
        for spec, gram in grams.items():
            r, c = np.indices(gram.shape).reshape(2, -1) if spec in LAGGED else np.triu_indices(len(gram))
            parts.append(pd.DataFrame({"spec": spec, "r": r, "c": c, "s": gram[r, c]}))
        if at[0] < head:
            for k, c in enumerate(columns):
                first = values[c][: max(0, min(head - int(at[0]), stop))]
                mine = np.arange(len(first)) >= start
                parts.append(
                    pd.DataFrame(
                        {"spec": -1 - k, "r": 0, "c": np.arange(len(first)) + int(at[0]), "s": first}
                    )[mine]
                )
        return pd.concat(parts).astype({"spec": "int32", "r": "int32", "c": "int32", "s": float})

    partial = per_group(cut.rows, cut.groups, keys, "spec int, r int, c int, s double", block)
    summed = partial.groupBy(*keys, "spec", "r", "c").agg(F.sum("s").alias("s"))
    constant = df.groupBy(*keys).agg(*[F.first(c).alias(c) for c in ("_n", *carry)])

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        grams, start = {}, {}
        for spec, part in pdf.groupby("spec"):
            if spec < 0:
                start[columns[-1 - spec]] = part.sort_values("c")["s"].to_numpy(float)
                continue
            k = int(part["c"].max()) + 1
            gram = np.zeros((k, k))
            gram[part["r"], part["c"]] = part["s"]
            if spec not in LAGGED:
                gram[part["c"], part["r"]] = part["s"]
            grams[int(spec)] = gram
        return solver(Summed(grams, start, pdf.iloc[0]))

    return per_group(match(summed, constant, keys), keys, keys, extra, finish)


def lags(values: np.ndarray, start: int, stop: int, count: int) -> np.ndarray:
    """Columns ``values[t-1] … values[t-count]`` for t in start … stop-1 (all t >= count)."""
    return np.column_stack([values[start - h : stop - h] for h in range(1, count + 1)]) if count else (
        np.empty((stop - start, 0))
    )


def row_gram(
    df: DataFrame, keys: Sequence[str], part: str, columns: Sequence[str], pos: str
) -> DataFrame:
    """(keys, part, r, c, s): cross-products of columns of the same row, per key and part.

    A narrow matrix is a plain aggregation.  A wide one is multiplied in chunks of
    rows and the chunks are summed, so neither the plan nor a task grows too large.
    """
    keys = list(keys)
    if len(columns) <= NARROW:
        pairs = [(r, c) for r in range(len(columns)) for c in range(r, len(columns))]
        wide = df.groupBy(*keys, part).agg(
            *[
                F.sum(F.col(columns[r]) * F.col(columns[c])).alias(f"_{r}_{c}")
                for r, c in pairs
            ]
        )
        rows = [
            F.struct(F.lit(r).alias("r"), F.lit(c).alias("c"), F.col(f"_{r}_{c}").alias("s"))
            for r, c in pairs
        ]
        return wide.select(*keys, part, F.explode(F.array(*rows)).alias("_g")).select(
            *keys, part, "_g.*"
        )
    rows = max(1024, CHUNK_VALUES // len(columns))
    packed = df.select(
        *keys,
        part,
        F.floor(F.col(pos) / F.lit(rows)).alias(BLK),
        F.array(*columns).alias("_z"),
    )

    def multiply(pdf: pd.DataFrame) -> pd.DataFrame:
        z = np.stack(pdf["_z"].to_numpy()).astype(float)
        gram = z.T @ z
        r, c = np.triu_indices(len(gram))
        return pd.DataFrame({"r": r, "c": c, "s": gram[r, c]}).astype({"r": "int32", "c": "int32"})

    partial = per_group(
        packed, [*keys, part, BLK], [*keys, part], "r int, c int, s double", multiply
    )
    return partial.groupBy(*keys, part, "r", "c").agg(F.sum("s").alias("s"))


def square(pdf: pd.DataFrame) -> np.ndarray:
    """Symmetric matrix from (r, c, s) rows of its upper triangle."""
    k = int(pdf["c"].max()) + 1
    gram = np.zeros((k, k))
    gram[pdf["r"], pdf["c"]] = pdf["s"]
    gram[pdf["c"], pdf["r"]] = pdf["s"]
    return gram


def dot(left: Column, right: Column) -> Column:
    """Inner product of two array columns; missing tails count as zero."""
    products = F.zip_with(
        left, right, lambda a, b: F.coalesce(a, F.lit(0.0)) * F.coalesce(b, F.lit(0.0))
    )
    return F.aggregate(products, F.lit(0.0), lambda total, term: total + term)
