"""Prepared panel to forests on each series' own lags of the deseasonalised target."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.functions.joins import attach
from loomcast.operators.harmonic import harmonic_deseasonalize
from loomcast.operators.regression import lasso_select
from loomcast.operators.reshape import series_index
from loomcast.operators.selection import granger_features
from loomcast.operators.trees import LAG_FOREST_GRID, KeyedTrees, predict_trees, train_trees
from loomcast.operators.windows import lag_features
from loomcast.session import settle


@dataclass
class LagForest:
    """The trained trees and what led to them."""

    sign_lags: DataFrame  # (keys, feature, sign_lag)
    lagged: DataFrame  # rows with the lag columns; 0 where a series does not use a lag
    chosen: DataFrame  # (keys, feature, coef) the columns each series' lasso keeps
    model: KeyedTrees

    def predict(self) -> DataFrame:
        return predict_trees(only_chosen(self.lagged, self.chosen, self.model.keys, self.model.features), self.model)


def lag_table(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    features: Sequence[str],
    target: str,
    periods: Sequence[int] = (52,),
    maxlag: int = 52,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """(significant lags of each series, rows with lag columns, names of all feature columns).

    Each series has its own lags: a column of a lag that it does not use is 0 in all of its
    rows, so no model can use it, and costs it no row.  A lag that it uses is NULL where
    the series does not reach back that far.  The driver reads one number per feature to
    name the columns.
    """
    keys, features = list(keys), list(features)
    indexed = series_index(df, keys, order)
    known = indexed.where(F.col(target).isNotNull())
    level = harmonic_deseasonalize(known, keys, "i", target, periods)
    level = settle(level.drop("season"))
    level = series_index(level.drop("i"), keys, order)
    found = settle(granger_features(level, keys, "i", "adjusted", features, maxlag))
    largest = found.groupBy("feature").agg(F.max("sign_lag").alias("top")).collect()
    tops = {r["feature"]: int(r["top"]) for r in largest}
    wanted = {c: tops.get(c, 0) for c in features}
    own = F.map_from_entries(F.collect_list(F.struct("feature", F.col("sign_lag").cast("int"))))
    lags = found.groupBy(*keys).agg(own.alias("_lags"))
    lagged = attach(lag_features(level, keys, "i", wanted), lags, keys)
    own_lag = {c: F.coalesce(F.try_element_at("_lags", F.lit(c)), F.lit(0)) for c in features}
    made = {f"{c}_{h}": (own_lag[c], h) for c in features for h in range(1, wanted[c] + 1)}
    used = {name: F.when(lag >= h, F.col(name)).otherwise(F.lit(0.0)) for name, (lag, h) in made.items()}
    return found, settle(lagged.withColumns(used).drop("_lags")), [*features, *made]


def only_chosen(df: DataFrame, chosen: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``columns`` with 0 in place of those that a series has not chosen; all stay where it chose none."""
    sets = chosen.groupBy(*keys).agg(F.collect_set("feature").alias("_chosen"))
    mine = attach(df, sets, keys)
    shown = {c: F.when(F.coalesce(F.array_contains("_chosen", c), F.lit(True)), F.col(c)).otherwise(F.lit(0.0)) for c in columns}
    return mine.withColumns(shown).drop("_chosen")


def train_lag_forest(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    features: Sequence[str],
    target: str,
    periods: Sequence[int] = (52,),
    maxlag: int = 52,
    grid: dict | None = None,
    folds: int = 5,
) -> LagForest:
    """Deseason, Granger lags, lasso columns, forest: lags, columns and trees are each series' own."""
    keys = list(keys)
    found, lagged, names = lag_table(df, keys, order, features, target, periods, maxlag)
    lagged = settle(lagged.na.drop(subset=names))
    lagged = settle(series_index(lagged.drop("i"), keys, order))
    chosen = settle(lasso_select(lagged, keys, "i", "adjusted", names))
    picked = {r["feature"] for r in chosen.select("feature").distinct().collect()}
    columns = [c for c in names if c in picked] or list(features)
    model = train_trees(
        only_chosen(lagged, chosen, keys, columns),
        keys,
        "i",
        columns,
        "adjusted",
        grid or LAG_FOREST_GRID,
        scoring="neg_mean_absolute_error",
        time_series=True,
        folds=folds,
    )
    return LagForest(found, lagged, chosen, model)
