"""Sources and the three end-to-end plans on a small two-city panel."""

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from loomcast.functions.joins import match
from loomcast.operators import models
from loomcast.operators.models import load_trees, save_trees
from loomcast.operators.trees import BOOSTED_GRID, FOREST_GRID, expand_specs, predict_trees, train_trees
from loomcast.plans.boosting import lag_table, only_chosen, train_lag_forest
from loomcast.plans.forecasting import Setting, forecast_panel
from loomcast.plans.prepare import prepare_panel
from loomcast.sources import panel as S

COLUMNS = ["ndvi_ne", "station_avg_temp_c", "station_precip_mm"]
TINY = {"trees": [5], "depth": [3], "min_leaf": [2]}


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    rng = np.random.default_rng(11)
    parts = []
    for city in ("sj", "iq"):
        n = 300
        i = np.arange(n)
        day = pd.Timestamp("2000-01-03") + pd.to_timedelta(7 * i, unit="D")
        temp = 25 + 3 * np.sin(2 * np.pi * i / 52) + rng.normal(size=n) * 0.3
        rain = 20 + 5 * np.cos(2 * np.pi * i / 52) + rng.normal(size=n)
        ndvi = 0.2 + 0.01 * temp + rng.normal(size=n) * 0.01
        cases = np.maximum(0, np.round(20 + 10 * np.sin(2 * np.pi * (i - 4) / 52) + rng.normal(size=n) * 3))
        ndvi[i % 8 == 3] = np.nan
        rain[i == 100] = np.nan
        iso = day.isocalendar()
        parts.append(
            pd.DataFrame(
                {
                    "city": city,
                    "year": iso.year.to_numpy().astype(int),
                    "weekofyear": iso.week.to_numpy().astype(int),
                    "week_start_date": day.strftime("%Y-%m-%d"),
                    "ndvi_ne": ndvi,
                    "station_avg_temp_c": temp,
                    "station_precip_mm": rain,
                    "total_cases": cases,
                    "late": i >= 260,
                }
            )
        )
    pdf = pd.concat(parts)
    folder = tmp_path_factory.mktemp("panel")
    early, late = pdf[~pdf.late], pdf[pdf.late]
    early.drop(columns=["late", "total_cases"]).to_csv(folder / "features.csv", index=False)
    early[["city", "year", "weekofyear", "total_cases"]].sample(frac=1, random_state=1).to_csv(
        folder / "labels.csv", index=False
    )
    late.drop(columns=["late", "total_cases"]).to_csv(folder / "test.csv", index=False)
    return folder


@pytest.fixture(scope="module")
def raw(spark, files):
    return S.read_panel(
        spark, *[str(files / f"{n}.csv") for n in ("features", "labels", "test")], columns=COLUMNS
    ).cache()


def test_labels_join_by_key(raw):
    assert raw.count() == 600
    assert raw.where("type = 'train' and total_cases is null").count() == 0
    assert raw.where("type = 'test' and total_cases is not null").count() == 0
    assert S.overlapping_series(raw).count() == 0


def test_bad_labels_are_refused(raw):
    train = raw.where("type = 'train'").drop("total_cases", "type")
    labels = raw.where("type = 'train'").select(*S.ROW_KEY, "total_cases")
    with pytest.raises(ValueError, match="unique"):
        S.attach_labels(train, labels.unionByName(labels.limit(1)))
    with pytest.raises(ValueError, match="without"):
        S.attach_labels(train.where("city = 'sj'"), labels)


def test_prepare_then_forecast(spark, raw, tmp_path):
    done = prepare_panel(raw, ["city"], "week_start_date", COLUMNS, "total_cases", grid=TINY, folds=2)
    kept = done.panel.cache()
    assert kept.count() == 600
    assert {r.variable for r in done.profile.where("not easy").collect()} == {"ndvi_ne"}
    assert done.tests.where("p_value > 0.05").count() == 0
    assert done.target_test.count() == 2
    S.write_prepared(kept, str(tmp_path / "prepared"))
    back = S.read_prepared(spark, str(tmp_path / "prepared"))
    settings = {"sj": Setting((3, 1), 104, 2.5), "iq": Setting((1, 1), 52)}
    ahead = forecast_panel(back, settings=settings)
    rows = ahead.toPandas()
    assert len(rows) == 80 and list(rows.columns) == ["city", "year", "weekofyear", "total_cases"]
    assert rows["total_cases"].between(0, 60).all()
    S.write_forecast(ahead, str(tmp_path / "forecast"))
    assert S.read_forecast(spark, str(tmp_path / "forecast")).count() == 80


def test_lag_forest(spark, raw, tmp_path):
    full = raw.na.drop(subset=["ndvi_ne", "station_precip_mm"])
    done = train_lag_forest(full, ["city"], "week_start_date", COLUMNS, "total_cases", [52], 3, TINY, 2)
    assert done.model.best.where("score < 0").count() == 2
    assert done.predict().where("prediction is null").count() == 0
    save_trees(done.model, str(tmp_path / "model"))
    model = load_trees(spark, str(tmp_path / "model"), ["city"], done.model.features)
    rows = only_chosen(done.lagged, done.chosen, ["city"], model.features)
    both = match(predict_trees(rows, model, "again"), done.predict().select("city", "i", "prediction"), ["city", "i"])
    assert both.count() == done.lagged.count() and both.where("again <> prediction").count() == 0


def test_each_series_uses_its_own_lags(spark):
    draw, rows = np.random.default_rng(3), []
    for key, back in (("near", 0), (None, 4)):
        x = draw.normal(size=260)
        for i in range(260):
            y = 3 * x[i - back] + 0.1 * draw.normal() if i >= back else 0.0
            rows.append((key, i, float(x[i]), float(y)))
    table = spark.createDataFrame(rows, "k string, t long, x double, y double")
    found, lagged, names = lag_table(table, ["k"], "t", ["x"], "y", [26], 6)
    own = {r.k: r.sign_lag for r in found.collect()}
    assert own["near"] < own[None] and names == ["x", *[f"x_{h}" for h in range(1, own[None] + 1)]]
    for key, lag in own.items():
        mine = lagged.where(F.col("k").eqNullSafe(F.lit(key))).orderBy("t").toPandas()
        for h in range(1, own[None] + 1):
            column = mine[f"x_{h}"]
            assert column.isna().sum() == h and np.allclose(column[h:], mine["x"][:-h]) if h <= lag else (column == 0).all()
    done = train_lag_forest(table, ["k"], "t", ["x"], "y", [26], 6, TINY, 2)
    kept = {(r.k, r.feature) for r in done.chosen.collect()}
    assert ("near", "x") in kept and (None, "x_4") in kept and ("near", "x_4") not in kept
    assert done.predict().groupBy("k").count().count() == 2


def test_store_fits_changed_series_only(spark, tmp_path, monkeypatch):
    calls = []

    def counting(rows, *args, **kwargs):
        calls.append({r.k for r in rows.select("k").distinct().collect()})
        return train_trees(rows, *args, **kwargs)

    monkeypatch.setattr(models, "train_trees", counting)
    rows = [(k, i, float(i % 7), None if i == 5 else float(i % 7 > 3)) for k in ("a", "b", None) for i in range(30)]
    make = lambda rows: spark.createDataFrame(rows, "k string, t long, x double, y double")
    run = lambda rows, grid=TINY: models.impute_by_model(make(rows), ["k"], "t", "y", ["x"], grid, folds=2, store=str(tmp_path / "store"))
    first = sorted((str(r.k), r.t, r.prediction) for r in run(rows)[0].where("y is null").collect())
    again = sorted((str(r.k), r.t, r.prediction) for r in run(rows[::-1])[0].where("y is null").collect())
    assert first == again and len(first) == 3 and all(r[2] is not None for r in first)
    assert calls == [{"a", "b", None}]
    changed = [(k, t, x + 1 if k == "a" and t == 9 else x, y) for k, t, x, y in rows]
    assert run(changed)[1].count() == 3 and calls[1:] == [{"a"}]
    run(rows, {**TINY, "trees": [4]})
    assert calls[2:] == [{"a", "b", None}]
    run(changed)
    assert len(calls) == 3


def test_saved_model_is_not_trained_again(spark, raw, tmp_path):
    from loomcast.operators.models import forest, grid_train, load_or_train

    rows = raw.na.drop(subset=[*COLUMNS, "total_cases"])
    calls = []

    def train():
        calls.append(1)
        cols = ["station_avg_temp_c", "station_precip_mm"]
        return grid_train(forest, {"numTrees": [5], "maxDepth": [3]}, rows, cols, "total_cases", ["city"], "week_start_date", folds=2)["model"]

    for _ in range(2):
        model = load_or_train(spark, str(tmp_path / "cached"), train)
        assert model.transform(rows).where("prediction is null").count() == 0
    assert len(calls) == 1


def test_grid_sizes():
    assert len(expand_specs(FOREST_GRID)) == 200 and len(expand_specs(BOOSTED_GRID)) == 60
