"""Rank and regression trends, and their removal."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.functions.curves import kendall_s, median_slope
from loomcast.functions.grouped import per_series, to_null
from loomcast.functions.joins import attach
from loomcast.functions.tails import normal_sf

Z95 = 1.959963984540054


def mann_kendall(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, alpha: float = 0.05
) -> DataFrame:
    """(keys, n, s, var_s, z, p_value, trend, slope, intercept) per series.

    Pairs are counted by merging, never listed: the sum of signs and the median
    slope each cost a few sorts of the series.  Missing values are left out; slope
    and intercept run over the positions, so gaps keep their width.
    """

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        known = pdf[pdf[value].notna()]
        y, x = known[value].to_numpy(float), known[pos].to_numpy(float)
        n = len(y)
        row = dict(n=n, s=0, var_s=0.0, z=0.0, p_value=1.0, trend="no trend")
        row.update(slope=np.nan, intercept=np.nan)
        if n > 1:
            ties = np.unique(y, return_counts=True)[1].astype(float)
            s = kendall_s(y)
            var = (n * (n - 1.0) * (2 * n + 5) - (ties * (ties - 1) * (2 * ties + 5)).sum()) / 18
            z = (s - np.sign(s)) / np.sqrt(var) if var > 0 else 0.0
            p = float(2 * normal_sf(abs(z)))
            if p < alpha:
                row["trend"] = "increasing" if z > 0 else "decreasing"
            slope = median_slope(y, x)
            row.update(s=s, var_s=var, z=z, p_value=p, slope=slope)
            row["intercept"] = np.median(y) - slope * np.median(x)
        return pd.DataFrame([row])

    extra = (
        "n bigint, s bigint, var_s double, z double, p_value double, trend string, "
        "slope double, intercept double"
    )
    found = per_series(df, keys, pos, [value], extra, test)
    return to_null(found, "slope", "intercept")


def detrend_mk(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, out: str = "detrended"
) -> tuple[DataFrame, DataFrame]:
    """Remove the median-slope line where there is a trend, and test again.

    Returns the series with ``out`` and the report (keys, pre_trend, slope,
    intercept, post_trend).
    """
    keys = list(keys)
    before = mann_kendall(df, keys, pos, value)
    marks = before.select(*keys, "trend", "slope", "intercept")
    line = F.col("intercept") + F.col("slope") * F.col(pos)
    changed = attach(df, marks, keys).select(
        *df.columns,
        F.when(F.col("trend") != "no trend", F.col(value) - line).otherwise(F.col(value)).alias(out),
    )
    after = mann_kendall(changed, keys, pos, out).select(*keys, F.col("trend").alias("_after"))
    trended = F.col("trend") != "no trend"
    report = attach(marks, after, keys).select(
        *keys,
        F.col("trend").alias("pre_trend"),
        F.when(trended, F.col("slope")).alias("slope"),
        F.when(trended, F.col("intercept")).alias("intercept"),
        F.when(trended, F.col("_after")).alias("post_trend"),
    )
    return changed, report


def ols_trend(df: DataFrame, keys: Sequence[str], pos: str, value: str) -> DataFrame:
    """(keys, n, slope, intercept, t_value) of the value on 1 … n, all from one aggregation."""
    y, x = F.col(value), F.when(F.col(value).isNotNull(), F.col(pos) + 1).cast("double")
    sums = df.groupBy(*keys).agg(
        F.regr_count(y, x).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_sxx(y, x).alias("_sxx"),
        F.regr_syy(y, x).alias("_syy"),
        F.regr_sxy(y, x).alias("_sxy"),
    )
    error = (F.col("_syy") - F.col("slope") * F.col("_sxy")) / F.nullif(F.col("n") - 2, F.lit(0))
    deviation = F.sqrt(F.greatest(error, F.lit(0.0)) / F.nullif(F.col("_sxx"), F.lit(0.0)))
    return sums.select(
        *keys, "n", "slope", "intercept", (F.col("slope") / F.nullif(deviation, F.lit(0.0))).alias("t_value")
    )


def detrend_ols(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, out: str = "detrended"
) -> DataFrame:
    """Subtract the fitted line where its slope is significant; adds ``out`` and ``d_trend``."""
    keys = list(keys)
    fit = ols_trend(df, keys, pos, value).drop("n")
    line = F.col("intercept") + F.col("slope") * (F.col(pos) + 1)
    strong = F.coalesce(F.abs("t_value") > Z95, F.lit(False))
    return attach(df, fit, keys).select(
        *df.columns,
        F.when(strong, F.col(value) - line).otherwise(F.col(value)).alias(out),
        strong.alias("d_trend"),
    )
