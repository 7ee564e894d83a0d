"""No asked row disappears: null keys, no keys, short, gappy and constant series."""

import numpy as np
import pandas as pd
import pytest

from loomcast.functions.joins import attach
from loomcast.operators import arma, decompose, forecast, harmonic, profile, trend
from loomcast.operators.reshape import series_index
from loomcast.operators.stationarity import difference_until_stationary
from loomcast.session import settle
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def nulls(spark):
    rows = [(None, 1, 1.0), (None, 2, 3.0), ("a", 1, 2.0), ("a", 2, 6.0)]
    return spark.createDataFrame(rows, "k string, h long, v double")


@pytest.mark.parametrize("keys", [["k"], []])
def test_scalers_keep_null_keys(nulls, keys):
    for done in (
        profile.minmax_scale(nulls, keys, ["v"]),
        profile.standardize(nulls, keys, ["v"]),
        profile.max_scale(nulls, keys, "v"),
        profile.log_shift(nulls, keys, "v"),
        profile.log_shift_if_skewed(nulls, keys, "v"),
    ):
        assert done.count() == 4
    assert profile.histogram(nulls, keys, "v").agg(F.sum("n")).first()[0] == 4
    if keys:
        scaled = {(r.k, r.h): r.v for r in profile.minmax_scale(nulls, keys, ["v"]).collect()}
        assert scaled == {(None, 1): 0.0, (None, 2): 1.0, ("a", 1): 0.0, ("a", 2): 1.0}


def test_series_index_keeps_null_keys_and_refuses_repeats(spark, nulls):
    for span in (None, (0, 10)):
        assert series_index(nulls, ["k"], "h", span=span).count() == 4
        twice = nulls.union(nulls)
        with pytest.raises(Exception, match="not unique"):
            series_index(twice, ["k"], "h", span=span).collect()


def test_small_facts_are_broadcast_and_rows_stay(spark, nulls):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plan = profile.minmax_scale(nulls, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_large_facts_are_joined_by_shuffle(spark, nulls, monkeypatch):
    monkeypatch.setattr("loomcast.functions.joins.BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = attach(nulls, nulls.groupBy("k").agg(F.max("v").alias("top")), ["k"])
        assert done.count() == 4 and done.where("top is null").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def uneven(spark):
    """Long, gappy, short, constant and empty series."""
    draw, rows = np.random.default_rng(1), []
    for name, size in (("long", 300), ("gappy", 300), ("short", 8), ("constant", 300), ("none", 20), (None, 250)):
        for i in range(size):
            v = 10 + 3 * np.sin(2 * np.pi * i / 52) + 0.3 * draw.normal()
            v = 5.0 if name == "constant" else v
            if name == "none" or name == "gappy" and 270 <= i < 284:
                v = None
            rows.append((name, i, None if v is None else float(v)))
    return series_index(spark.createDataFrame(rows, "k string, h long, v double"), ["k"], "h", span=(0, 10_000))


def test_every_step_comes_back(uneven):
    found = forecast.seasonal_arma_forecast(uneven, ["k"], "i", "v", (3, 1), 52, 60).toPandas()
    assert len(found) == 6 * 60 and (found.groupby("k", dropna=False).size() == 60).all()
    status = {k: set(g.status) for k, g in found.groupby("k", dropna=False)}
    status = {None if isinstance(k, float) else k: v for k, v in status.items()}
    assert status["long"] == status["gappy"] == status[None] == {"ok"}
    assert status["short"] == {"short"} and status["none"] == {"no values"}
    assert found[found.status == "ok"]["mean"].notna().all() and found[found.status != "ok"]["mean"].isna().all()
    truth = 10 + 3 * np.sin(2 * np.pi * (300 + np.arange(60)) / 52)
    for name in ("long", "gappy"):
        guess = found[found.k == name].sort_values("step")["mean"].to_numpy()
        assert np.abs(guess - truth).mean() < 0.6, name  # out of phase it would be about 2


def test_harmonic_steps_come_back(uneven):
    _, found = harmonic.harmonic_forecast(uneven, ["k"], "i", "v", 5, {"year": (52,)})
    found = found.toPandas()
    assert len(found) == 6 * 2 * 5
    status = {(None if isinstance(k, float) else k): set(g.status) for k, g in found.groupby("k", dropna=False)}
    assert status["long"] == status["gappy"] == status[None] == {"ok"}
    assert "not fitted" in status["short"] and status["none"] == {"no values"}
    assert (found["mean"].notna() == (found.status == "ok")).all()


def test_in_sample_keeps_null_keys(uneven):
    shocks = settle(arma.innovations(uneven.where("k is null or k = 'long'"), ["k"], "i", "v"))
    fits = arma.arma_grid(shocks, ["k"], [1], [0])
    found = arma.in_sample_predict(shocks, fits, ["k"], "i", 50)
    assert {r.k: r["count"] for r in found.groupBy("k").count().collect()} == {"long": 300, None: 250}


def test_panel_forecast_keeps_null_keys(uneven):
    from loomcast.plans.forecasting import Setting, forecast_panel

    asked = uneven.where("k is null or k = 'long'").withColumn("v", F.when(F.col("i") < 240, F.col("v")))
    found = forecast_panel(asked, "k", "i", "v", ["k", "i"], {"long": Setting((1, 1), 52)}, Setting((1, 1), 52))
    rows = found.toPandas()
    assert len(rows) == 60 + 10 and rows["v"].notna().all()


def test_series_repeat_keeps_null_keys(uneven):
    found = forecast.season_repeat_forecast(uneven.where("k is null"), ["k"], "i", "v", 52, 60)
    assert found.count() == 60


def test_combined_forecasts_keep_missing_rows(spark):
    frame = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("b", 1, None)], "city string, t long, total_cases int")
    guess = spark.createDataFrame([("a", 1, 2.4)], "city string, step int, mean double")
    done = forecast.combine_forecasts(frame, guess, ["city"], "t", columns=["city", "t"])
    assert sorted((r.city, r.t, r.total_cases) for r in done.collect()) == [("a", 1, 2), ("a", 2, None), ("b", 1, None)]


def test_short_series_say_so(uneven):
    parts = decompose.stl(uneven, ["k"], "i", "v", 52).where("k = 'short'").toPandas()
    assert len(parts) == 8 and set(parts.status) == {"short"} and parts.season.isna().all()


def test_rank_trend_over_gaps(spark):
    rows = [("a", i, None if 60 <= i < 120 else 2.0 * i + 5) for i in range(200)]
    table = series_index(spark.createDataFrame(rows, "k string, h long, v double"), ["k"], "h", span=(0, 1000))
    found = trend.mann_kendall(table, ["k"], "i", "v").first()
    assert abs(found.slope - 2) < 1e-9 and abs(found.intercept - 5) < 1e-6
    left = trend.detrend_mk(table, ["k"], "i", "v")[0].where("detrended is not null").toPandas()
    assert np.abs(left.detrended).max() < 1e-6


def test_constant_series_is_not_differenced(uneven):
    _, report = difference_until_stationary(uneven.where("k = 'constant'"), ["k"], "i", "v")
    assert [r.n_diff for r in report.collect()] == [0]


def test_panel_where_no_column_is_easy_everywhere(spark):
    from loomcast.plans.prepare import impute_panel

    draw, rows = np.random.default_rng(5), []
    for name, gappy in (("p", "a"), ("q", "b")):
        for i in range(120):
            cell = {c: float(10 + np.sin(i / 9) + 0.05 * draw.normal()) for c in ("a", "b")}
            if i % 9 == 4 and 0 < i < 119:
                cell[gappy] = None
            rows.append((name, i, cell["a"], cell["b"]))
    table = series_index(spark.createDataFrame(rows, "k string, h long, a double, b double"), ["k"], "h", span=(0, 1000))
    grid = {"trees": [5], "depth": [3]}
    done, profile = impute_panel(table, ["k"], "i", ["a", "b"], grid=grid, n=10, folds=2)
    assert done.count() == 240 and done.where("a is null or b is null").count() == 0
    assert profile.where("not easy").count() == 2
    before = {(r.k, r.i): (r.a, r.b) for r in table.collect()}
    for r in done.collect():
        for old, new in zip(before[r.k, r.i], (r.a, r.b)):
            assert new == old if old is not None else abs(new - 10 - np.sin(r.i / 9)) < 0.5
