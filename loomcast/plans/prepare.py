"""Raw panel to prepared panel: impute, deseason, detrend, difference."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.functions.joins import attach, match
from loomcast.operators.decompose import deseasonalize
from loomcast.operators.impute import impute_easy
from loomcast.operators.models import impute_difficult
from loomcast.operators.profile import assert_complete, missing_profile, split_easy_difficult
from loomcast.operators.reshape import series_index, to_long, to_matrix
from loomcast.operators.spectrum import power_spectrum, spectral_peaks
from loomcast.operators.stationarity import adf_test, difference_until_stationary
from loomcast.operators.trend import detrend_mk
from loomcast.session import settle


@dataclass
class Prepared:
    """The prepared panel and the tables found on the way."""

    panel: DataFrame
    profile: DataFrame
    periods: DataFrame
    trends: DataFrame
    tests: DataFrame
    target_test: DataFrame


def impute_panel(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    features: Sequence[str],
    threshold: float = 1.0,
    grid: dict | None = None,
    n: int = 50,
    seed: int = 42,
    folds: int = 5,
) -> tuple[DataFrame, DataFrame]:
    """Fill every feature: window methods where a series misses little, a model contest elsewhere.

    A column is difficult in the series that miss at least ``threshold`` percent of it and
    easy in the others, where it gets the series' best window method.  The model of a
    difficult column learns from the columns that are easy in every series; where there is
    none, from window fills of all other columns, which serve as features only.  The
    driver reads one entry per column.
    """
    keys, features = list(keys), list(features)
    profile = split_easy_difficult(missing_profile(df, features, keys), threshold)
    per_column = profile.groupBy("variable").agg(F.min("easy").alias("easy")).collect()
    easy = [c for c in features if {r["variable"]: r["easy"] for r in per_column}[c]]
    hard = [c for c in features if c not in easy]
    rest = [c for c in df.columns if c not in features]
    by_variable = [*keys, "variable"]
    long = to_long(df, [*keys, pos], features if not easy else _easy_anywhere(profile, features))
    filled = attach(impute_easy(long, by_variable, pos, "value", n, seed), profile.select(*by_variable, "easy"), by_variable)
    filled = settle(filled.withColumn("_own", F.when(F.col("easy"), F.col("filled")).otherwise(F.col("value"))))
    named = [r["variable"] for r in filled.select("variable").distinct().collect()]
    wide = to_matrix(filled, [*keys, pos], "variable", "_own", named)
    done = match(df.select(*rest, *[c for c in features if c not in named]), wide, [*keys, pos])
    helpers = []
    if not easy:
        guesses = to_matrix(filled, [*keys, pos], "variable", "filled", features)
        helpers = [f"_by_window_{c}" for c in features]
        done = match(done, guesses.withColumnsRenamed(dict(zip(features, helpers))), [*keys, pos])
    done = settle(done)
    for target in hard:
        known = easy or [h for h, c in zip(helpers, features) if c != target]
        done = impute_difficult(done, keys, pos, target, known, grid, n, seed, folds)[0].drop("method")
        done = settle(done)
    done = done.drop(*helpers).select(*rest, *features)
    assert_complete(done, features)
    return done, profile


def _easy_anywhere(profile: DataFrame, features: Sequence[str]) -> list[str]:
    found = {r["variable"] for r in profile.where("easy").select("variable").distinct().collect()}
    return [c for c in features if c in found]


def prepare_panel(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    features: Sequence[str],
    target: str,
    threshold: float = 1.0,
    grid: dict | None = None,
    n: int = 50,
    seed: int = 42,
    folds: int = 5,
) -> Prepared:
    """The whole preparation on (key, variable) rows: all columns of all series in one plan."""
    keys, features = list(keys), list(features)
    indexed = series_index(df, keys, order)
    imputed, profile = impute_panel(indexed, keys, "i", features, threshold, grid, n, seed, folds)
    rest = [c for c in imputed.columns if c not in features and c != "i"]
    imputed = series_index(imputed.select(*rest, *features), keys, order)
    by_variable = [*keys, "variable"]
    long = to_long(imputed, [*keys, "i"], features)
    periods = spectral_peaks(power_spectrum(long, by_variable, "i", "value"), by_variable)
    periods = settle(periods)
    level = settle(deseasonalize(long, by_variable, "i", "value", periods))
    detrended, trends = detrend_mk(level, by_variable, "i", "adjusted")
    detrended = settle(detrended)
    changed, tests = difference_until_stationary(detrended, by_variable, "i", "detrended")
    wide = to_matrix(changed, [*keys, "i"], "variable", "stationary", features)
    panel = match(imputed.select(*rest, "i"), wide, [*keys, "i"])
    return Prepared(
        panel,
        profile,
        periods,
        trends,
        tests,
        adf_test(imputed, keys, "i", target),
    )
