"""Choosing and applying an imputation method per series and column.

The operators work on a long table: key columns (with the variable name among
them), a dense position and one value column.  So all columns of all series go
through one plan.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomcast.functions.blocks import BLK, Cut, known_bound, position
from loomcast.functions.curves import spline_moments
from loomcast.functions.grouped import per_group, to_null
from loomcast.functions.joins import match
from loomcast.operators.profile import nrmse_expression
from loomcast.operators.windows import fill_candidates, linear_value, neighbours
from loomcast.session import settle

METHODS = ("ffill", "bfill", "linear", "cubic", "knn", "model")
_KNOT_BLOCK, _KNOT_HALO = 2_048, 64


def _spline_pieces(df: DataFrame, keys: Sequence[str], pos: str, value: str) -> DataFrame:
    """(keys, knot, m0, m1): second derivatives at each known point and at the next one.

    A knot's pull on the curve fades by a factor of about four per knot, so a halo
    of 64 knots makes a block's result equal to the whole series' to the last bit.
    """
    keys = list(keys)
    known = position(
        df.where(F.col(value).isNotNull()).select(*keys, pos, value), keys, pos, "_j"
    )
    sizes = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"))
    cut = Cut(match(known, sizes, keys), keys, "_j", _KNOT_HALO, _KNOT_HALO, _KNOT_BLOCK).rows

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_j", ignore_index=True)
        rank, total = pdf["_j"].to_numpy(), int(pdf["_m"].iloc[0])
        none = pd.DataFrame({"knot": [], "m0": [], "m1": []}).astype({"knot": "int64"})
        if total < 4 or len(pdf) < 4:
            return none
        moments = spline_moments(
            pdf[pos].to_numpy(float),
            pdf[value].to_numpy(float),
            bool(rank[0] == 0),
            bool(rank[-1] == total - 1),
        )
        mine = (rank[:-1] // _KNOT_BLOCK) == pdf[BLK].iloc[0]
        return pd.DataFrame(
            {
                "knot": pdf[pos].to_numpy("int64")[:-1][mine],
                "m0": moments[:-1][mine],
                "m1": moments[1:][mine],
            }
        )

    return per_group(cut, [*keys, BLK], keys, "knot bigint, m0 double, m1 double", solve)


def _spline_value(pos: str, value: str) -> Column:
    p, q = F.col("_prev"), F.col("_next")
    h = F.nullif(q["p"] - p["p"], F.lit(0)).cast("double")
    a, b = (q["p"] - F.col(pos)) / h, (F.col(pos) - p["p"]) / h
    curve = (
        a * p["v"]
        + b * q["v"]
        + ((a * a * a - a) * F.col("m0") + (b * b * b - b) * F.col("m1")) * h * h / 6.0
    )
    return F.coalesce(F.col(value), curve)


def fill_cubic(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, blocks: bool | None = None
) -> DataFrame:
    """Cubic spline (not-a-knot) through all known points; both ends stay missing."""
    filled = fill_all(df, keys, pos, value, blocks=blocks)
    return filled.select(*df.columns, F.col("cubic").alias("filled"))


def _whole_series_cubic(df: DataFrame, keys: Sequence[str], pos: str, value: str) -> DataFrame:
    """Add ``cubic`` for series short enough for one task each."""
    schema = T.StructType([*df.schema.fields, T.StructField("cubic", T.DoubleType())])
    names = [f.name for f in schema.fields]

    def curve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos, ignore_index=True)
        y = pdf[value].to_numpy(float)
        x = pdf[pos].to_numpy(float)
        known = ~np.isnan(y)
        out = y.copy()
        if known.sum() >= 4:
            kx, ky = x[known], y[known]
            moments = spline_moments(kx, ky, True, True)
            gaps = np.flatnonzero(~known & (x > kx[0]) & (x < kx[-1]))
            left = np.searchsorted(kx, x[gaps]) - 1
            h = kx[left + 1] - kx[left]
            a, b = (kx[left + 1] - x[gaps]) / h, (x[gaps] - kx[left]) / h
            bend = (a**3 - a) * moments[left] + (b**3 - b) * moments[left + 1]
            out[gaps] = a * ky[left] + b * ky[left + 1] + bend * h * h / 6
        return pdf.assign(cubic=out)[names]

    return to_null(df.groupBy(*keys).applyInPandas(curve, schema), "cubic")


def fill_all(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    n: int = 8,
    blocks: bool | None = None,
) -> DataFrame:
    """Columns ``ffill bfill linear knn cubic`` side by side.

    A bounded series takes its spline in its own task; others piece it together
    from blocks of knots.
    """
    keys = list(keys)
    if blocks is None:
        blocks = known_bound(df, pos) is None
    around = neighbours(df, keys, pos, value, n)
    fills = [
        F.col("_prev.v").alias("ffill"),
        F.col("_next.v").alias("bfill"),
        linear_value(pos, value).alias("linear"),
        F.coalesce(F.col(value), F.col("_mean")).alias("knn"),
    ]
    if not blocks:
        plain = around.select(*df.columns, *fills)
        return _whole_series_cubic(plain, keys, pos, value)
    pieces = _spline_pieces(df, keys, pos, value)
    at_knot = around.withColumn(
        "knot", F.when(F.col(value).isNull() & F.col("_next").isNotNull(), F.col("_prev.p"))
    )
    return match(at_knot, pieces, [*keys, "knot"], "left").select(
        *df.columns, *fills, _spline_value(pos, value).alias("cubic")
    )


def holdout_mask(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, n: int = 50, seed: int = 42
) -> DataFrame:
    """Known rows, densely re-indexed as ``j``, with ``n`` of them blanked in ``masked``.

    The blanked rows have the lowest md5 of (keys, j, seed): the same rows on any
    cluster and after any retry.  For unbounded series the rank filter is cut to
    ``n`` rows per task before the shuffle, so no series is gathered for it.
    """
    keys = list(keys)
    known = position(
        df.where(F.col(value).isNotNull()).select(*keys, pos, value), keys, pos, "j"
    )
    draw = F.md5(F.concat_ws("/", *[F.col(k) for k in keys], F.col("j"), F.lit(seed)).cast("binary"))
    by_draw = Window.partitionBy(*keys).orderBy("_draw", "j")
    drawn = known.withColumn("_draw", draw)
    if known_bound(known, "j") is not None:
        marked = drawn.withColumn("hidden", F.row_number().over(by_draw) <= n)
    else:
        picked = (
            drawn.select(*keys, "j", "_draw")
            .withColumn("_rank", F.row_number().over(by_draw))
            .where(F.col("_rank") <= n)
            .select(*keys, "j", F.lit(True).alias("_hit"))
        )
        marked = match(drawn, picked, [*keys, "j"], "left").withColumn(
            "hidden", F.coalesce("_hit", F.lit(False))
        )
    return marked.select(
        *keys, "j", value, "hidden", F.when(~F.col("hidden"), F.col(value)).alias("masked")
    )


def score_imputers(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    n: int = 50,
    seed: int = 42,
    knn: int = 8,
    cubic: bool = True,
) -> DataFrame:
    """(keys, method, nrmse): every method tried on the same blanked values."""
    keys = list(keys)
    masked = holdout_mask(df, keys, pos, value, n, seed)
    if cubic:
        tried, methods = fill_all(masked, keys, "j", "masked", knn), METHODS[:5]
    else:
        tried = fill_candidates(masked, keys, "j", "masked", knn)
        methods = ("ffill", "bfill", "linear", "knn")
    wide = tried.groupBy(*keys).agg(*[nrmse_expression(value, m, n).alias(m) for m in methods])
    return wide.unpivot(keys, list(methods), "method", "nrmse")


def choose_imputer(
    scores: DataFrame, keys: Sequence[str], exclude: Sequence[str] = ()
) -> DataFrame:
    """(keys, method): lowest score; missing scores last; ties in the order of ``METHODS``."""
    order = F.array_position(F.array(*[F.lit(m) for m in METHODS]), F.col("method"))
    rank = F.struct(
        F.col("nrmse").isNull().alias("a"), F.col("nrmse").alias("b"), order.alias("c")
    )
    allowed = scores.where(~F.col("method").isin(*exclude)) if exclude else scores
    return allowed.groupBy(*keys).agg(
        F.min_by("method", rank).alias("method"), F.min_by("nrmse", rank).alias("nrmse")
    )


def impute_chosen(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    choice: DataFrame,
    knn: int = 8,
    out: str = "filled",
    strict: bool = False,
) -> DataFrame:
    """Fill each series with its chosen method.

    A method that cannot reach a series' ends leaves gaps; unless ``strict`` those
    take the straight-line, last or next value, so the column is complete.
    """
    keys = list(keys)
    tried = fill_all(df, keys, pos, value, knn)
    picked = F.lit(None).cast("double")
    for m in METHODS[:5]:
        picked = F.when(F.col("method") == m, F.col(m)).otherwise(picked)
    parts = [F.col(value), picked]
    if not strict:
        parts += [F.col("linear"), F.col("ffill"), F.col("bfill")]
    return match(tried, choice.select(*keys, "method"), keys, "left").select(
        *df.columns, "method", F.coalesce(*parts).alias(out)
    )


def impute_easy(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, n: int = 50, seed: int = 42
) -> DataFrame:
    """Score, choose and fill.

    Scoring and filling both read the series, so it is written once; what built it
    from raw rows does not run twice.
    """
    df = settle(df)
    choice = choose_imputer(score_imputers(df, keys, pos, value, n, seed), keys)
    return impute_chosen(df, keys, pos, value, choice)


def usable_features(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Which columns have no gap where the target is missing, and where it is present."""
    gone = F.col(target).isNull()
    others = [c for c in cols if c != target]
    wide = df.agg(
        *[
            F.struct(
                F.count_if(gone & F.col(c).isNull()).alias("gaps_where_missing"),
                F.count_if(~gone & F.col(c).isNull()).alias("gaps_where_known"),
            ).alias(c)
            for c in others
        ]
    )
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("_g")) for c in others]))
    return wide.select(rows.alias("_r")).select(
        "_r.variable",
        F.col("_r._g.gaps_where_missing").alias("gaps_where_missing"),
        F.col("_r._g.gaps_where_known").alias("gaps_where_known"),
        (F.col("_r._g.gaps_where_missing") == 0).alias("usable"),
    )
