"""Power spectrum, spectral peaks, autocorrelation and partial autocorrelation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomcast.functions.blocks import BLK, Cut, known_bound, position, with_totals
from loomcast.functions.grouped import per_group, per_series
from loomcast.functions.joins import match

Z95 = 1.959963984540054
PRODUCT_BLOCK = 65_536


def power_spectrum(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, zero: bool = False
) -> DataFrame:
    """(keys, m, n, freq, power): absolute Fourier transform at frequencies m/n.

    The mean is not removed.  Bins run from 1 (or 0 with ``zero``) to (n-1)/2.
    """

    def transform(pdf: pd.DataFrame) -> pd.DataFrame:
        signal = pdf[value].dropna().to_numpy(float)
        n = len(signal)
        bins = np.arange(0 if zero else 1, (n - 1) // 2 + 1)
        power = np.abs(np.fft.rfft(signal))[bins] if n else np.array([])
        return pd.DataFrame(
            {"m": bins, "n": np.full(len(bins), n), "freq": bins / max(n, 1), "power": power}
        )

    return per_series(
        df, keys, pos, [value], "m bigint, n bigint, freq double, power double", transform
    )


def _prominence(power: np.ndarray, peak: int) -> float:
    """Height of a peak over the higher of the lowest points before ground rises above it."""
    higher = np.flatnonzero(power > power[peak])
    left = higher[higher < peak]
    right = higher[higher > peak]
    start = left[-1] + 1 if len(left) else 0
    stop = right[0] if len(right) else len(power)
    return power[peak] - max(power[start : peak + 1].min(), power[peak:stop].min())


def _local_peaks(power: np.ndarray) -> np.ndarray:
    """Strict local maxima; a flat top counts once, at its middle."""
    if len(power) < 3:
        return np.array([], dtype=int)
    fresh = np.flatnonzero(np.concatenate(([True], power[1:] != power[:-1])))
    ends = np.concatenate((fresh[1:], [len(power)])) - 1
    level = power[fresh]
    top = np.flatnonzero((level[1:-1] > level[:-2]) & (level[1:-1] > level[2:])) + 1
    return (fresh[top] + ends[top]) // 2


def spectral_peaks(
    spectrum: DataFrame, keys: Sequence[str], prominence: float = 5.0, deviations: float = 3.0
) -> DataFrame:
    """(keys, period): n/m of the lowest-frequency peak in the first quarter of the bins.

    A peak must stand out by ``prominence`` means and exceed both neighbours by
    mean + ``deviations`` standard deviations.  No peak gives a missing period.
    """

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("m", ignore_index=True)
        power = pdf["power"].to_numpy()[: len(pdf) // 4]
        period = None
        if len(power):
            mean, spread = power.mean(), power.std()
            for k in _local_peaks(power):
                rise = min(power[k] - power[k - 1], power[k] - power[k + 1])
                if rise >= mean + deviations * spread and _prominence(power, k) >= prominence * mean:
                    period = float(pdf["n"].iloc[0]) / float(pdf["m"].iloc[k])
                    break
        return pd.DataFrame({"period": [period]}).astype({"period": "float64"})

    found = per_group(spectrum, keys, keys, "period double", find)
    return found.withColumn("period", F.nanvl("period", F.lit(None).cast("double")))


def spectral_peaks_median(
    spectrum: DataFrame, keys: Sequence[str], factor: float = 10.0
) -> DataFrame:
    """Older rule: every peak up to frequency 0.25 that stands out by ``factor`` medians.

    Takes a spectrum with its zero bin; the median is over all bins.
    """

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("m", ignore_index=True)
        power = pdf["power"].to_numpy()
        low = power[pdf["freq"].to_numpy() <= 0.25]
        need = factor * np.median(power) if len(power) else 0.0
        peaks = [k for k in _local_peaks(low) if _prominence(low, k) >= need]
        bins = pdf["m"].to_numpy()[peaks]
        return pd.DataFrame(
            {"m": bins, "period": float(pdf["n"].iloc[0]) / bins, "power": power[peaks]}
        )

    return per_group(spectrum, keys, keys, "m bigint, period double, power double", find)


def dominant_period(spectrum: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole period of the strongest bin; the lower frequency wins a tie."""
    best = F.max(F.struct("power", (-F.col("m")).alias("_m"), "n"))
    return spectrum.groupBy(*keys).agg(best.alias("_b")).select(
        *keys, F.bround(F.col("_b.n") / -F.col("_b._m")).cast("int").alias("period")
    )


def acf(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    nlags: int,
    size: int | None = None,
) -> DataFrame:
    """(keys, lag, n, acf, half_width): biased autocorrelation with 95 % Bartlett bounds.

    Missing values are dropped first.  Each task multiplies one block of a series
    with its lagged self and emits one sum per lag; the sums are added up.
    """
    keys = list(keys)
    known = df.where(F.col(value).isNotNull()).select(*keys, pos, value)
    ranked = position(known, keys, pos, "_j")
    centred = with_totals(
        ranked, keys, "_j", {"_mean": F.avg(value), "_n": F.count(F.lit(1))}
    ).select(*keys, "_j", "_n", (F.col(value) - F.col("_mean")).alias("_e"))
    bound = known_bound(centred, "_j")
    cut = Cut(centred, keys, "_j", before=nlags, size=size)
    if cut.whole and bound > 4 * PRODUCT_BLOCK:
        # a date could reach far: blocks keep a task's product small whatever the length
        cut = Cut(centred, keys, "_j", before=nlags, size=PRODUCT_BLOCK)
    width = cut.size

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_j", ignore_index=True)
        e, j = pdf["_e"].to_numpy(float), pdf["_j"].to_numpy()
        first = 0
        if BLK in pdf:
            first = int(np.searchsorted(j, pdf[BLK].iloc[0] * width))
        last = len(e) if BLK not in pdf else int(np.searchsorted(j, (pdf[BLK].iloc[0] + 1) * width))
        top = min(nlags, last - 1)
        own = e[first:last]
        sums = []
        for h in range(top + 1):
            start = max(first, h)
            sums.append(float(own[start - first :] @ e[start - h : last - h]))
        return pd.DataFrame(
            {"lag": np.arange(len(sums)), "_s": sums, "_n": int(pdf["_n"].iloc[0])}
        ).astype({"lag": "int32"})

    partial = per_group(cut.rows, cut.groups, keys, "lag int, _s double, _n bigint", products)
    summed = partial.groupBy(*keys, "lag").agg(F.sum("_s").alias("_s"), F.max("_n").alias("n"))
    by_lag = Window.partitionBy(*keys).orderBy("lag")
    scaled = summed.where(F.col("lag") < F.col("n")).withColumn(
        "acf", F.col("_s") / F.nullif(F.first("_s").over(by_lag), F.lit(0.0))
    )
    earlier = F.coalesce(
        F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(
            by_lag.rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0.0),
    )
    half = F.lit(Z95) * F.sqrt((F.lit(1.0) + F.lit(2.0) * earlier) / F.col("n"))
    return scaled.select(
        *keys,
        "lag",
        "n",
        "acf",
        F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(half).alias("half_width"),
    )


def pacf_from_acf(table: DataFrame, keys: Sequence[str], adjusted: bool = True) -> DataFrame:
    """(keys, lag, n, pacf, half_width) by the Durbin-Levinson recursion over the ACF rows."""
    keys = list(keys)

    def recurse(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag", ignore_index=True)
        n = int(pdf["n"].iloc[0])
        r = pdf["acf"].to_numpy(float)
        if adjusted:
            r = r * n / (n - np.arange(len(r)))
        out = np.ones(len(r))
        phi = np.zeros(0)
        for k in range(1, len(r)):
            back = r[k - 1 : 0 : -1]
            last = (r[k] - phi @ back) / (1 - phi @ r[1:k])
            phi = np.append(phi - last * phi[::-1], last)
            out[k] = last
        half = np.full(len(r), Z95 / np.sqrt(n))
        half[0] = 0.0
        return pd.DataFrame(
            {"lag": pdf["lag"].astype("int32"), "n": n, "pacf": out, "half_width": half}
        )

    return per_group(table, keys, keys, "lag int, n bigint, pacf double, half_width double", recurse)


def pacf(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, nlags: int, adjusted: bool = True
) -> DataFrame:
    """Partial autocorrelation with 95 % bounds."""
    return pacf_from_acf(acf(df, keys, pos, value, nlags), keys, adjusted)


def first_insignificant_lag(partial: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First lag whose PACF lies inside its own bound."""
    inside = (F.col("lag") > 0) & (F.abs("pacf") < F.col("half_width"))
    return partial.groupBy(*keys).agg(F.min(F.when(inside, F.col("lag"))).alias("lag"))


def significant_auto_lags(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    min_lag: int,
    window: int = 52,
) -> DataFrame:
    """Lags over ``min_lag``, up to ``min_lag + window``, where ACF or PACF leaves its bound."""
    keys = list(keys)
    auto = acf(df, keys, pos, value, min_lag + window)
    partial = pacf_from_acf(auto, keys).withColumnRenamed("half_width", "pacf_half_width").drop("n")
    joined = match(auto, partial, [*keys, "lag"])
    out = (F.abs("acf") >= F.col("half_width")) | (F.abs("pacf") >= F.col("pacf_half_width"))
    return joined.where((F.col("lag") > min_lag) & out).select(*keys, "lag", "acf", "pacf")
