"""Season, trend and remainder."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.functions.blocks import Cut, keep_bound
from loomcast.functions.curves import loess_decompose
from loomcast.functions.grouped import per_series, to_null
from loomcast.functions.joins import attach


def seasonal_decompose(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, period: int, size: int | None = None
) -> DataFrame:
    """Centred moving-average trend, phase means as season; adds ``trend season resid``."""
    keys = list(keys)
    half = period // 2
    cut = Cut(df, keys, pos, half, half, size)
    wide = cut.window.rowsBetween(-half, half)
    full = F.count(value).over(wide) == 2 * half + 1
    if period % 2:
        mean = F.avg(value).over(wide)
    else:
        ends = F.lag(value, half).over(cut.window) + F.lead(value, half).over(cut.window)
        mean = (F.sum(value).over(wide) - ends / 2) / F.lit(float(period))
    smooth = cut.own(cut.rows.withColumn("trend", F.when(full, mean)))
    phased = smooth.withColumn("_phase", F.col(pos) % period)
    means = phased.groupBy(*keys, "_phase").agg(F.avg(F.col(value) - F.col("trend")).alias("_m"))
    level = means.groupBy(*keys).agg(F.avg("_m").alias("_level"))
    season = means.join(level, keys).select(
        *keys, "_phase", (F.col("_m") - F.col("_level")).alias("season")
    )
    return phased.join(season, [*keys, "_phase"], "left").select(
        *df.columns,
        "trend",
        "season",
        (F.col(value) - F.col("trend") - F.col("season")).alias("resid"),
    )


def stl(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    period: int | Column,
    robust: bool = False,
    seasonal: int = 7,
) -> DataFrame:
    """Loess decomposition per series: (keys, pos, value, season, trend, resid).

    ``period`` may be a column, one value per series; a missing period gives a zero
    season with the series itself as trend (``status`` "no period").  A series of
    fewer than two periods cannot be decomposed: its parts are NULL and its status is
    "short".  All others are "ok".  Missing positions inside a series keep their place:
    they are bridged by a straight line for the smoother, so that the phases after a gap
    stay right, and give no rows.  The smoother is sequential over the whole series,
    so it runs as one task per series of bounded length.
    """
    step = F.lit(period) if isinstance(period, int) else period
    frame = df.where(F.col(value).isNotNull()).withColumn("_period", step.cast("double"))

    def decompose(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf[value].to_numpy(float)
        every = pdf["_period"].iloc[0]
        status = "ok"
        if np.isnan(every):
            season, trend, resid = np.zeros(len(y)), y, np.zeros(len(y))
            status = "no period"
        elif len(y) < 2 * int(every):
            season, trend, resid = (np.full(len(y), np.nan) for _ in range(3))
            status = "short"
        else:
            at = (pdf[pos] - pdf[pos].iloc[0]).to_numpy()
            whole = y if at[-1] == len(y) - 1 else np.interp(np.arange(at[-1] + 1), at, y)
            season, trend, resid = (part[at] for part in loess_decompose(whole, int(every), robust, seasonal))
        return pd.DataFrame(
            {pos: pdf[pos], value: y, "season": season, "trend": trend, "resid": resid, "status": status}
        )

    extra = f"`{pos}` bigint, `{value}` double, season double, trend double, resid double, status string"
    parts = per_series(frame, keys, pos, [value, "_period"], extra, decompose)
    return keep_bound(to_null(parts, "season", "trend", "resid"), df, pos)


def additive_adjust(
    df: DataFrame, value: str, remove: Sequence[str] = ("season",), out: str = "adjusted"
) -> DataFrame:
    """Value less the named components."""
    left = F.col(value)
    for part in remove:
        left = left - F.col(part)
    return df.withColumn(out, left)


def deseasonalize(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    periods: DataFrame,
    remove: Sequence[str] = ("season",),
) -> DataFrame:
    """Loess-adjust each series by its own found period, ``int(period) + 1`` steps long.

    Series without a period stay as they are, and so do those of fewer than two periods,
    which have no season to remove: (keys, pos, value, adjusted).
    """
    joined = attach(df, periods.select(*keys, "period"), keys)
    parts = stl(joined, keys, pos, value, F.floor("period") + 1)
    kept = parts.withColumn("_found", F.when(F.col("status") == "ok", 1))
    adjusted = additive_adjust(kept, value, remove, "_adj")
    return to_null(
        adjusted.select(
            *keys,
            pos,
            value,
            F.when(F.col("_found").isNull(), F.col(value)).otherwise(F.col("_adj")).alias("adjusted"),
        ),
        "adjusted",
    )
