"""Fills, lags, differences, peaks and caps over ordered series.

Every operator takes a dense position column (see ``reshape.series_index``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.functions.blocks import BLK, BLOCK_VALUES, Cut, block_of, order_statistics, value_counts
from loomcast.functions.joins import attach, match


def neighbours(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, n: int = 0, size: int | None = None
) -> DataFrame:
    """Add ``_prev``/``_next``: nearest known (position, value) at or before / after a row.

    Inside a block this is a window; what a block hands to the next one is a
    single row, carried over the small block table.  With ``n`` also the mean
    of the ``n`` values around (``_mean``).
    """
    keys = list(keys)
    half = math.ceil(n / 2)
    known = F.when(
        F.col(value).isNotNull(), F.struct(F.col(pos).alias("p"), F.col(value).alias("v"))
    )
    cut = Cut(df, keys, pos, half, max(half - 1, 0), size)
    upto = (Window.unboundedPreceding, 0)
    extra = []
    if n:
        extra = [F.avg(value).over(cut.window.rowsBetween(-half, half - 1)).alias("_mean")]
    local = cut.rows.select(
        "*",
        F.last(known, ignorenulls=True).over(cut.window.rowsBetween(*upto)).alias("_prev"),
        F.last(known, ignorenulls=True).over(cut.backward.rowsBetween(*upto)).alias("_next"),
        *extra,
    )
    if cut.whole:
        return local
    local = local.where(F.col(BLK) == block_of(pos, cut.size))
    ends = (
        Cut(df, keys, pos, size=cut.size)
        .rows.groupBy(*keys, BLK)
        .agg(F.max(known).alias("_last"), F.min(known).alias("_first"))
    )
    by_block = Window.partitionBy(*keys).orderBy(BLK)
    by_block_desc = Window.partitionBy(*keys).orderBy(F.col(BLK).desc())
    before = (Window.unboundedPreceding, -1)
    carry = ends.select(
        *keys,
        BLK,
        F.last("_last", ignorenulls=True).over(by_block.rowsBetween(*before)).alias("_cp"),
        F.last("_first", ignorenulls=True).over(by_block_desc.rowsBetween(*before)).alias("_cn"),
    )
    return (
        match(local, carry, [*keys, BLK])
        .withColumns({"_prev": F.coalesce("_prev", "_cp"), "_next": F.coalesce("_next", "_cn")})
        .drop(BLK, "_cp", "_cn")
    )


def linear_value(pos: str, value: str) -> Column:
    p, q = F.col("_prev"), F.col("_next")
    between = p["v"] + (q["v"] - p["v"]) * (F.col(pos) - p["p"]) / F.nullif(
        q["p"] - p["p"], F.lit(0)
    )
    return (
        F.when(F.col(value).isNotNull(), F.col(value))
        .when(p.isNull(), F.lit(None).cast("double"))
        .when(q.isNull(), p["v"])
        .otherwise(between)
    )


def fill_candidates(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, n: int = 8, size: int | None = None
) -> DataFrame:
    """All window fills of one column side by side: ``ffill bfill linear knn``."""
    around = neighbours(df, keys, pos, value, n, size)
    return around.select(
        *df.columns,
        F.col("_prev.v").alias("ffill"),
        F.col("_next.v").alias("bfill"),
        linear_value(pos, value).alias("linear"),
        F.coalesce(F.col(value), F.col("_mean")).alias("knn"),
    )


def _one_fill(df, keys, pos, value, expression, size) -> DataFrame:
    around = neighbours(df, keys, pos, value, size=size)
    return around.select(*df.columns, expression.alias("filled"))


def fill_forward(df: DataFrame, keys, pos: str, value: str, size: int | None = None) -> DataFrame:
    """Last known value; leading gaps stay missing."""
    return _one_fill(df, keys, pos, value, F.col("_prev.v"), size)


def fill_backward(df: DataFrame, keys, pos: str, value: str, size: int | None = None) -> DataFrame:
    """Next known value; trailing gaps stay missing."""
    return _one_fill(df, keys, pos, value, F.col("_next.v"), size)


def fill_linear(df: DataFrame, keys, pos: str, value: str, size: int | None = None) -> DataFrame:
    """Straight line by position; trailing gaps take the last value, leading gaps stay."""
    return _one_fill(df, keys, pos, value, linear_value(pos, value), size)


def fill_neighbour_mean(
    df: DataFrame, keys, pos: str, value: str, n: int = 8, size: int | None = None
) -> DataFrame:
    """Mean of the known values in rows ``i - n/2 … i + n/2 - 1`` of the original series."""
    half = math.ceil(n / 2)
    cut = Cut(df, keys, pos, half, half - 1, size)
    mean = F.avg(value).over(cut.window.rowsBetween(-half, half - 1))
    return cut.own(cut.rows.withColumn("filled", F.coalesce(F.col(value), mean)))


def lag_features(
    df: DataFrame, keys, pos: str, lags: dict[str, int], size: int | None = None
) -> DataFrame:
    """Add ``{col}_1 … {col}_L`` for every column with largest lag ``L``, in one projection."""
    reach = max(lags.values(), default=0)
    cut = Cut(df, keys, pos, before=reach, size=size)
    added = [
        F.lag(col, h).over(cut.window).alias(f"{col}_{h}")
        for col, top in lags.items()
        for h in range(1, top + 1)
    ]
    return cut.own(cut.rows.select("*", *added))


def select_target_lags(
    df: DataFrame, target: str, keep: Sequence[int], columns: Sequence[str] | None = None
) -> DataFrame:
    """Of all ``{target}_h`` columns keep only the lags in ``keep``."""
    wanted = {f"{target}_{h}" for h in keep}
    prefix = f"{target}_"
    names = columns or df.columns
    return df.select(
        *[
            c
            for c in names
            if not (c.startswith(prefix) and c[len(prefix) :].isdigit()) or c in wanted
        ]
    )


def leading_target_lags(target: str, first_insignificant: int) -> list[str]:
    """The first version's choice: target lags 1 … first lag whose PACF is insignificant."""
    return [f"{target}_{h}" for h in range(1, first_insignificant + 1)]


def longest_lag(columns: Sequence[str]) -> int:
    """Largest lag number found as a column suffix, 0 if there is none."""
    tails = [c.rsplit("_", 1)[-1] for c in columns]
    return max((int(t) for t in tails if t.isdigit()), default=0)


def difference(
    df: DataFrame, keys, pos: str, value: str, d: int = 1, out: str = "diff", size: int | None = None
) -> DataFrame:
    """``d``-th difference as a signed binomial sum of lags; the first ``d`` rows are missing."""
    cut = Cut(df, keys, pos, before=d, size=size)
    total = F.col(value)
    for h in range(1, d + 1):
        weight = float((-1) ** h * math.comb(d, h))
        total = total + F.lit(weight) * F.lag(value, h).over(cut.window)
    return cut.own(cut.rows.withColumn(out, total))


def moving_peaks(
    df: DataFrame, keys, pos: str, value: str, lag: int, threshold: float, size: int | None = None
) -> DataFrame:
    """Signal 1 where a value is over ``threshold`` deviations off the mean of the ``lag`` before it."""
    cut = Cut(df, keys, pos, before=lag, size=size)
    trail = cut.window.rowsBetween(-lag, -1)
    measured = cut.rows.select(
        "*",
        F.when(F.col(pos) >= lag, F.avg(value).over(trail)).alias("trail_mean"),
        F.when(F.col(pos) >= lag, F.stddev_pop(value).over(trail)).alias("trail_std"),
    )
    off = F.abs(F.col(value) - F.col("trail_mean"))
    hit = off > F.lit(float(threshold)) * F.col("trail_std")
    return cut.own(measured.withColumn("signal", F.when(hit, F.lit(1)).otherwise(F.lit(0))))


def winsorize_upper(
    df: DataFrame, keys: Sequence[str], value: str, pct: float, out: str = "capped", max_rows: int = BLOCK_VALUES
) -> DataFrame:
    """Lower the top ``floor(n * pct / 100)`` values to the next lower order statistic."""
    keys = list(keys)
    counts = value_counts(df, keys, value, max_rows)
    cut = F.floor(F.col("_total") * F.lit(float(pct)) / F.lit(100.0))
    caps = order_statistics(counts, keys, value, {"_cap": F.col("_total") - cut - 1})
    capped = F.when(F.col(value).isNotNull(), F.least(F.col(value), F.col("_cap")))
    return attach(df, caps, keys).select(*df.columns, capped.alias(out))


def clip_negative(df: DataFrame, value: str, out: str | None = None) -> DataFrame:
    """Forecasts below zero become zero; missing stays missing."""
    col = F.col(value)
    return df.withColumn(out or value, F.when(col < 0, F.lit(0.0)).otherwise(col))


def round_forecast(df: DataFrame, value: str, out: str | None = None) -> DataFrame:
    """Half to even, then integer."""
    return df.withColumn(out or value, F.bround(F.col(value)).cast("int"))
