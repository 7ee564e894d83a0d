"""Seasonal forecasts, model comparison and the final forecast table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomcast.functions.blocks import position, with_totals
from loomcast.functions.joins import attach
from loomcast.operators.arma import arma_forecast, arma_grid, innovations
from loomcast.operators.decompose import additive_adjust, stl
from loomcast.operators.likelihood import likelihood_grid
from loomcast.operators.windows import clip_negative, round_forecast
from loomcast.session import settle


def seasonal_parts(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, period: int, robust: bool = True
) -> DataFrame:
    """Loess parts with ``adjusted`` = value less season."""
    return additive_adjust(stl(df, keys, pos, value, period, robust), value)


def last_season(parts: DataFrame, keys: Sequence[str], pos: str, period: int) -> DataFrame:
    """(keys, phase, season): the last known season of each phase, the position modulo the period.

    A gap in the last period leaves its phases to the period before.
    """
    phase = (F.col(pos) % period).cast("int").alias("phase")
    known = parts.where(F.col("season").isNotNull())
    return known.groupBy(*keys, phase).agg(F.max_by("season", pos).alias("season"))


def seasonal_arma_forecast(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    order: tuple[int, int],
    period: int,
    horizon: int | DataFrame,
    clip: bool = True,
    likelihood: bool = False,
) -> DataFrame:
    """(keys, step, mean, lower, upper, status): robust decomposition, ARMA on the rest, last season added back.

    The order is fitted by two-stage least squares or, with ``likelihood``, by exact maximum
    likelihood.

    Every series of ``df`` gets every step asked for.  Where there is no forecast, the
    values are NULL and ``status`` tells why: "no values", "short" (fewer than two
    periods), "not fitted" (the order cannot be fitted) or "no season" (no known value in
    the step's phase); otherwise it is "ok".
    """
    keys = list(keys)
    # the decomposition is the dear step and is read several times below
    parts = settle(seasonal_parts(df, keys, pos, value, period))
    shocks = innovations(parts, keys, pos, "adjusted")
    grid = likelihood_grid if likelihood else arma_grid
    fits = grid(shocks, keys, [order[0]], [order[1]])
    ahead = arma_forecast(shocks, fits.where(F.col("coef").isNotNull()), keys, horizon)
    asked = df.select(*keys).distinct()
    if isinstance(horizon, DataFrame):
        asked = attach(asked, horizon.select(*keys, "horizon"), keys, "inner")
    else:
        asked = asked.withColumn("horizon", F.lit(horizon))
    asked = asked.where("horizon > 0").withColumn("step", F.explode(F.sequence(F.lit(1), F.col("horizon").cast("int"))))
    ends = parts.groupBy(*keys).agg(F.max(pos).alias("_end"), F.max("status").alias("_parts"))
    asked = attach(asked, ends, keys).withColumn("phase", ((F.col("_end") + F.col("step")) % period).cast("int"))
    joined = attach(attach(asked, ahead, [*keys, "step"]), last_season(parts, keys, pos, period), [*keys, "phase"])
    status = (
        F.when(F.col("_parts").isNull(), "no values")
        .when(F.col("_parts") != "ok", F.col("_parts"))
        .when(F.col("mean").isNull(), "not fitted")
        .when(F.col("season").isNull(), "no season")
        .otherwise("ok")
    )
    out = joined.select(
        *keys, "step", *[(F.col(c) + F.col("season")).alias(c) for c in ("mean", "lower", "upper")], status.alias("status")
    )
    return clip_negative(out, "mean") if clip else out


def season_repeat_forecast(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, period: int, horizon: int
) -> DataFrame:
    """Yardstick: the value one period earlier, repeated."""
    keys = list(keys)
    known = df.where(F.col(value).isNotNull())
    ends = known.groupBy(*keys).agg(F.max(pos).alias("_end"))
    tail = attach(known, ends, keys).where(F.col(pos) > F.col("_end") - period)
    phase = (F.col(pos) - F.col("_end") + period).cast("int")
    steps = F.sequence(phase, F.lit(horizon), F.lit(period))
    return tail.where(phase <= horizon).select(
        *keys, F.explode(steps).alias("step"), F.col(value).alias("mean")
    )


def compare_models(
    predictions: DataFrame, keys: Sequence[str], model: str, truth: str, guess: str
) -> DataFrame:
    """(keys, model, mae, best): predictions clipped at zero, scored on the holdout."""
    keys = list(keys)
    clipped = clip_negative(predictions.where(F.col(truth).isNotNull()), guess)
    scores = clipped.groupBy(*keys, model).agg(
        F.avg(F.abs(F.col(truth) - F.col(guess))).alias("mae")
    )
    order = Window.partitionBy(*keys).orderBy("mae", model)
    return scores.withColumn("best", F.row_number().over(order) == 1)


def missing_steps(
    df: DataFrame, keys: Sequence[str], pos: str, target: str, out: str = "step"
) -> DataFrame:
    """Rows whose target is missing, numbered 1, 2, … per key."""
    missing = df.where(F.col(target).isNull())
    return position(missing, keys, pos, out).withColumn(out, (F.col(out) + 1).cast("int"))


def combine_forecasts(
    df: DataFrame,
    forecasts: DataFrame,
    keys: Sequence[str],
    pos: str,
    target: str = "total_cases",
    columns: Sequence[str] = ("city", "year", "weekofyear"),
    guess: str = "mean",
) -> DataFrame:
    """Match step h of each key's forecast to its h-th missing row; clipped, rounded, integer.

    A missing row without a forecast stays in the result with a missing target.
    """
    keys = list(keys)
    steps = missing_steps(df, keys, pos, target).drop(target)
    joined = attach(steps, forecasts.select(*keys, "step", F.col(guess).alias(target)), [*keys, "step"])
    return round_forecast(clip_negative(joined, target), target).select(*columns, target)


def holdout_frame(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, frac: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """(train rows, test rows with their ``step``) split on the known rows of each key."""
    keys = list(keys)
    known = position(df.where(F.col(value).isNotNull()), keys, pos, "_j")
    sized = with_totals(known, keys, "_j", {"_rows": F.count(F.lit(1))})
    cut = F.floor(F.col("_rows") * F.lit(float(frac)))
    train = sized.where(F.col("_j") < cut).drop("_j", "_rows")
    test = sized.where(F.col("_j") >= cut).withColumn("step", (F.col("_j") - cut + 1).cast("int"))
    return train, test.drop("_j", "_rows")
