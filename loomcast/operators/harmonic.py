"""Seasonality as sums of sines and cosines, and forecasts with autoregressive errors."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.functions.blocks import BOUND, known_bound, position, with_totals
from loomcast.functions.gram import Summed, dot, lags, lagged_fit, row_gram, solve, square
from loomcast.functions.grouped import per_group
from loomcast.functions.joins import attach, match
from loomcast.operators.arma import Z95, continue_series, shock_weights
from loomcast.session import settle

# The seasonality choices to compare.
PERIOD_SETS = {
    "No Seasonality": (),
    "Yearly": (52,),
    "Every other year": (104,),
    "Both": (52, 104),
}


def _waves(periods: Sequence[int], harmonics: int) -> list[tuple[int, int]]:
    return [(p, k) for p in periods for k in range(1, harmonics + 1) if 2 * k < p]


def _wave_columns(pos: Column, waves: Sequence[tuple[int, int]]) -> list[Column]:
    out = []
    for p, k in waves:
        # the phase is taken modulo the period, so it stays exact on long series
        angle = (pos * k % p) * F.lit(2 * math.pi / p)
        out += [F.sin(angle), F.cos(angle)]
    return out


def _wave_matrix(at: np.ndarray, waves: Sequence[tuple[int, int]]) -> np.ndarray:
    out = [np.ones(len(at))]
    for p, k in waves:
        angle = (at * k % p) * (2 * np.pi / p)
        out += [np.sin(angle), np.cos(angle)]
    return np.column_stack(out)


def harmonic_fit(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    period_sets: dict[str, Sequence[int]],
    harmonics: int = 2,
) -> DataFrame:
    """(keys, set, n, rss, coef) for every set of periods, from one cross-product matrix.

    ``coef`` is the constant followed by sine and cosine of every wave of all sets;
    waves a set does not use have coefficient zero.
    """
    keys = list(keys)
    every = sorted({p for s in period_sets.values() for p in s})
    waves = _waves(every, harmonics)
    names = ["_one", *[f"_w{k}" for k in range(2 * len(waves))], "_y"]
    known = df.where(F.col(value).isNotNull())
    rows = known.select(
        *keys,
        pos,
        F.lit(0).alias("_part"),
        F.lit(1.0).alias("_one"),
        *[c.alias(f"_w{k}") for k, c in enumerate(_wave_columns(F.col(pos), waves))],
        F.col(value).alias("_y"),
    )
    grams = row_gram(rows, keys, "_part", names, pos)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        gram = square(pdf)
        n, last = int(round(gram[0, 0])), len(gram) - 1
        out = []
        for name, periods in period_sets.items():
            used = [0]
            for at, (p, _) in enumerate(waves):
                if p in periods:
                    used += [1 + 2 * at, 2 + 2 * at]
            found = solve(gram, used, last, n)
            if found is None:
                continue
            coef = np.zeros(last)
            coef[used] = found.coef
            out.append({"set": name, "n": n, "rss": found.rss, "coef": coef.tolist()})
        return pd.DataFrame(out, columns=["set", "n", "rss", "coef"])

    return per_group(
        grams, keys, keys, "`set` string, n bigint, rss double, coef array<double>", fit
    )


def harmonic_deseasonalize(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    periods: Sequence[int] = (52,),
    harmonics: int = 3,
) -> DataFrame:
    """Add ``season`` (the fitted periodic part) and ``adjusted`` (the value less it)."""
    keys = list(keys)
    fits = harmonic_fit(df, keys, pos, value, {"only": tuple(periods)}, harmonics)
    waves = _waves(sorted(periods), harmonics)
    columns = F.array(F.lit(0.0), *_wave_columns(F.col(pos), waves))
    season = dot(columns, F.col("coef"))
    return match(df, fits.select(*keys, "coef"), keys, "left").select(
        *df.columns, season.alias("season"), (F.col(value) - season).alias("adjusted")
    )


def harmonic_forecast(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    horizon: int | DataFrame,
    period_sets: dict[str, Sequence[int]] = PERIOD_SETS,
    harmonics: int = 2,
    ar: int = 2,
    spans: Sequence[str] = ("full", "half"),
) -> tuple[DataFrame, DataFrame]:
    """Harmonic regression with autoregressive errors for every set and data length.

    Returns (scores, forecasts): scores (keys, span, set, n, aic) and, for the set
    with the lowest AIC of each span, (keys, span, set, step, mean, lower, upper, status).
    Span ``half`` uses the later half of a series.  Every series of ``df`` gets every step
    asked for; where there is no forecast the values are NULL and ``status`` says why:
    "no values" or "not fitted" (too short for the waves and lags), otherwise "ok".
    """
    keys = list(keys)
    known = df.where(F.col(value).isNotNull()).select(*keys, pos, value)
    ranked = position(known, keys, pos, "_j")
    sized = with_totals(ranked, keys, "_j", {"_total": F.count(F.lit(1))})
    start = F.when(F.col("span") == "half", F.floor(F.col("_total") / F.lit(2))).otherwise(F.lit(0))
    spanned = (
        sized.withColumn("span", F.explode(F.array(*[F.lit(s) for s in spans])))
        .withColumn("_from", start.cast("long"))
        .where(F.col("_j") >= F.col("_from"))
    )
    bound = known_bound(spanned, "_j")
    local = spanned.withColumn("_at", (F.col("_j") - F.col("_from")).cast("long"))
    if bound is not None:
        local = local.withMetadata("_at", {BOUND: bound})
    by_span = [*keys, "span"]
    # one row per series, span and set, read several times below: written once
    fits = settle(harmonic_fit(local, by_span, "_j", value, period_sets, harmonics))
    waves = _waves(sorted({p for s in period_sets.values() for p in s}), harmonics)
    columns = F.array(F.lit(1.0), *_wave_columns(F.col("_j"), waves))
    per_set = [*by_span, "set"]
    errors = match(local, fits.select(*per_set, "coef", F.col("n").alias("_n")), by_span).select(
        *per_set, "_at", "_j", "_n", (F.col(value) - dot(columns, F.col("coef"))).alias("_r")
    )

    def design(values, begin, stop, offset, total):
        first = max(begin, ar - offset)
        r = values["_r"]
        return {0: np.column_stack([lags(r, first, stop, ar), r[first:stop]])} if first < stop else {}

    def fit(data: Summed) -> pd.DataFrame:
        n = int(data.first["_n"]) - ar
        found = solve(data.grams[0], range(ar), ar, n) if 0 in data.grams else None
        row = {"phi": None, "rss": np.nan, "used": n}
        if found is not None:
            row.update(phi=found.coef.tolist(), rss=found.rss)
        return pd.DataFrame([row])

    residual_fits = lagged_fit(
        errors, per_set, "_at", ["_r"], ar, design, fit, "phi array<double>, rss double, used bigint"
    )
    models = settle(match(residual_fits, fits.select(*per_set, "coef"), per_set))
    free = F.aggregate("coef", F.lit(0), lambda a, c: a + F.when(c != 0, 1).otherwise(0))
    aic = F.col("used") * F.log(F.col("rss") / F.col("used")) + 2 * (free + ar + 1)
    scored = models.where(F.col("phi").isNotNull()).withColumn("aic", aic)
    scores = scored.select(*per_set, F.col("used").alias("n"), "aic")
    best = scored.groupBy(*by_span).agg(
        F.min_by(F.struct("set", "phi", "rss", "used", "coef"), F.struct("aic", "set")).alias("_b")
    ).select(*by_span, "_b.*")
    if isinstance(horizon, DataFrame):
        best = match(best, horizon.select(*keys, "horizon"), keys)
    else:
        best = best.withColumn("horizon", F.lit(horizon))
    ends = local.groupBy(*by_span).agg(F.max("_j").alias("_last"))
    tail = match(match(errors, best, per_set), ends, by_span).where(F.col("_j") > F.col("_last") - ar)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_j", ignore_index=True)
        row = pdf.iloc[0]
        steps = int(row["horizon"])
        weights = {h + 1: float(c) for h, c in enumerate(row["phi"])}
        r = continue_series(pdf["_r"], np.zeros(len(pdf)), weights, {}, 0.0, np.zeros(steps), steps)
        at = int(row["_last"]) + np.arange(1, steps + 1)
        mean = _wave_matrix(at, waves) @ np.asarray(row["coef"], float) + r
        sigma = np.sqrt(row["rss"] / row["used"])
        half = Z95 * sigma * np.sqrt(np.cumsum(shock_weights(weights, {}, steps) ** 2))
        return pd.DataFrame(
            {
                "set": row["set"],
                "step": np.arange(1, steps + 1),
                "mean": mean,
                "lower": mean - half,
                "upper": mean + half,
            }
        ).astype({"step": "int32"})

    extra = "`set` string, step int, mean double, lower double, upper double"
    found = per_group(tail, by_span, by_span, extra, run)
    asked = df.groupBy(*keys).agg(F.count(value).alias("_values"))
    if isinstance(horizon, DataFrame):
        asked = attach(asked, horizon.select(*keys, "horizon"), keys, "inner")
    else:
        asked = asked.withColumn("horizon", F.lit(horizon))
    steps = F.explode(F.sequence(F.lit(1), F.col("horizon").cast("int"))).alias("step")
    asked = asked.where("horizon > 0").select(*keys, "_values", F.explode(F.array(*[F.lit(s) for s in spans])).alias("span"), "horizon")
    asked = asked.select(*by_span, "_values", steps)
    status = F.when(F.col("_values") == 0, "no values").when(F.col("mean").isNull(), "not fitted").otherwise("ok")
    told = attach(asked, found, [*by_span, "step"])
    return scores, told.select(*by_span, "set", "step", "mean", "lower", "upper", status.alias("status"))
