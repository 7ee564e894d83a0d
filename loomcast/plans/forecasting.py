"""Prepared panel to whole-number forecasts by decomposition and ARMA."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.operators.arma import arma_grid, innovations
from loomcast.operators.forecast import combine_forecasts, seasonal_arma_forecast, seasonal_parts
from loomcast.operators.reshape import forecast_horizon, series_index
from loomcast.operators.windows import winsorize_upper


@dataclass(frozen=True)
class Setting:
    """How one series is forecast."""

    order: tuple[int, int]
    period: int
    winsorize: float | None = None


# The chosen orders, periods and cap of the two cities.
CITY_SETTINGS = {"sj": Setting((3, 1), 104, 2.5), "iq": Setting((1, 1), 52)}


def _capped(known: DataFrame, key: str, target: str, setting: Setting) -> DataFrame:
    if setting.winsorize is None:
        return known
    capped = winsorize_upper(known, [key], target, setting.winsorize, "_capped")
    return capped.withColumn(target, F.col("_capped")).drop("_capped")


def order_search(
    df: DataFrame,
    key: str,
    order: str,
    target: str,
    setting: Setting,
    p: Sequence[int],
    q: Sequence[int],
) -> DataFrame:
    """AIC and Ljung-Box of every order on the deseasonalised series."""
    known = series_index(df.where(F.col(target).isNotNull()).select(key, order, target), [key], order)
    parts = seasonal_parts(_capped(known, key, target, setting), [key], "i", target, setting.period)
    return arma_grid(innovations(parts, [key], "i", "adjusted"), [key], p, q)


def forecast_panel(
    df: DataFrame,
    key: str = "city",
    order: str = "week_start_date",
    target: str = "total_cases",
    columns: Sequence[str] = ("city", "year", "weekofyear"),
    settings: dict[str, Setting] | None = None,
    default: Setting = Setting((1, 1), 52),
) -> DataFrame:
    """Forecast every missing target row.

    Series with a setting of their own are grouped by it; all others share
    ``default``.  The plan has one branch per distinct setting, not per series.
    """
    settings = settings or {}
    by_setting: dict[Setting, list[str]] = {}
    for name, setting in settings.items():
        by_setting.setdefault(setting, []).append(name)
    horizons = forecast_horizon(df, [key], target).where("horizon > 0")
    chosen = [(s, F.col(key).isin(*names)) for s, names in by_setting.items()]
    # a null key is in no list of settings
    chosen.append((default, ~F.coalesce(F.col(key).isin(*settings), F.lit(False)) if settings else F.lit(True)))
    branches = []
    for setting, mine in chosen:
        known = df.where(mine & F.col(target).isNotNull()).select(key, order, target)
        capped = _capped(series_index(known, [key], order), key, target, setting)
        branches.append(
            seasonal_arma_forecast(
                capped, [key], "i", target, setting.order, setting.period, horizons
            )
        )
    forecasts = reduce(DataFrame.unionByName, branches)
    return combine_forecasts(df, forecasts, [key], order, target, columns)
