"""Forests and boosted trees of every series: growth, grids, long series, prediction."""

import numpy as np
import pandas as pd
import pytest

from loomcast.functions.growing import draws, grow, sorted_rows
from loomcast.operators import trees as T

GRID = {"depth": [1, 3, 9], "min_leaf": [1, 4], "min_split": [2, 8], "trees": [6]}
BOOST = {"rate": [0.1, 0.5], "min_leaf": [1, 6], "trees": [4], "depth": [2]}


def cart(x, y, w, depth, split, leaf):
    """One tree by trying every cut of every node."""
    on = w > 0
    mean = (w * y).sum() / w.sum()
    node = {"value": mean, "rows": int(on.sum())}
    if depth == 0 or on.sum() < max(split, 2 * leaf) or (w * (y - mean) ** 2).sum() < 1e-9:
        return node
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[on, f])
        for a, b in zip(values, values[1:]):
            low = x[:, f] <= a
            if (on & low).sum() < leaf or (on & ~low).sum() < leaf:
                continue
            gain = sum((w * y)[s].sum() ** 2 / w[s].sum() for s in (low, ~low))
            if best is None or gain > best[0] * (1 + 1e-12):
                best = gain, f, (a + b) / 2, low
    if best:
        _, node["feature"], node["threshold"], low = best
        node["left"], node["right"] = cart(x, y, w * low, depth - 1, split, leaf), cart(x, y, w * ~low, depth - 1, split, leaf)
    return node


def told(node, x):
    while "feature" in node:
        node = node["left"] if x[node["feature"]] <= node["threshold"] else node["right"]
    return node["value"]


def same(trees, k, node):
    assert abs(trees.value[k] - node["value"]) < 1e-9 and trees.rows[k] == node["rows"]
    assert (trees.feature[k] >= 0) == ("feature" in node)
    if "feature" in node:
        assert trees.feature[k] == node["feature"] and abs(trees.threshold[k] - node["threshold"]) < 1e-12
        same(trees, trees.left[k], node["left"])
        same(trees, trees.right[k], node["right"])


@pytest.mark.parametrize("seed", range(6))
def test_slots_grow_as_if_alone(seed):
    draw = np.random.default_rng(seed)
    x, y = draw.integers(0, 12, (60, 3)).astype(float), draw.integers(0, 30, 60).astype(float)
    w = draws(np.arange(60), np.arange(6), seed)
    depth, split, leaf = np.array([1, 2, 3, 50, 50, 4]), np.array([2, 2, 5, 2, 10, 2]), np.array([1, 2, 1, 1, 3, 5])
    trees = grow(x, sorted_rows(x), np.tile(y, (6, 1)), w, depth, split, leaf)
    for s in range(6):
        same(trees, s, cart(x, y, w[s], depth[s], split[s], leaf[s]))


def test_draws_are_poisson_and_of_the_row_alone():
    whole = draws(np.arange(20_000), np.arange(5), 3)
    assert abs(whole.mean() - 1) < 0.02 and abs(whole.var() - 1) < 0.03
    assert np.array_equal(whole[2:4, 700:900], draws(np.arange(700, 900), np.arange(2, 4), 3))


def contiguous(n, k):
    return np.repeat(np.arange(k), [n // k + (f < n % k) for f in range(k)])


def segments(n, k):
    size = n // (k + 1)
    return np.maximum(0, (np.arange(n) - (n - size * k)) // max(size, 1) + 1) if size else np.zeros(n, int)


def brute(x, y, grid, kind, time_series, folds=3, seed=T.SEED):
    """(mean score of every setting, the best one's prediction of every row)."""
    specs, rows = T.expand_specs(grid), np.arange(len(y))
    part = segments(len(y), folds) if time_series else contiguous(len(y), folds)

    def guess(on, spec):
        xs, ys = x[on], y[on]
        if kind == "boosted":
            margin, out = np.full(len(ys), ys.mean()), np.full(len(y), ys.mean())
            for _ in range(spec["trees"]):
                tree = cart(xs, ys - margin, np.ones(len(ys)), spec["depth"], spec["min_split"], spec["min_leaf"])
                margin += spec["rate"] * np.array([told(tree, r) for r in xs])
                out += spec["rate"] * np.array([told(tree, r) for r in x])
            return out
        w = draws(rows[on], np.arange(spec["trees"]), seed)
        forest = [cart(xs, ys, own, spec["depth"], spec["min_split"], spec["min_leaf"]) for own in w if own.any()]
        return np.array([np.mean([told(t, r) for t in forest]) for r in x])

    scores = []
    for spec in specs:
        errors = []
        for f in range(folds):
            train, test = (part <= f, part == f + 1) if time_series else (part != f, part == f)
            if train.any() and test.any():
                errors.append(np.mean((y - guess(train, spec))[test] ** 2))
        scores.append(-np.mean(errors))
    best = int(np.flatnonzero(np.array(scores) >= max(scores) * (1 + 1e-12))[0])
    return scores, best, guess(np.ones(len(y), bool), specs[best])


@pytest.fixture(scope="module")
def panel(spark):
    draw = np.random.default_rng(4)
    parts = []
    for key, n in (("a", 60), (None, 41)):
        x = draw.integers(0, 9, (n, 2)).astype(float)
        y = np.round(5 * (x[:, 0] > 4) + x[:, 1] + draw.integers(0, 3, n))
        parts.append(pd.DataFrame({"k": key, "t": np.arange(n) * 3, "u": x[:, 0], "v": x[:, 1], "y": y}))
    pdf = pd.concat(parts, ignore_index=True)
    rows = [tuple(r) for r in pdf.itertuples(index=False)]
    return pdf, spark.createDataFrame(rows, "k string, t long, u double, v double, y double").repartition(3)


def held(found, pdf):
    got = {(r.k, r.t): r.prediction for r in found.collect()}
    return [got[k, t] for k, t in zip(pdf["k"].where(pdf["k"].notna(), None), pdf["t"])]


@pytest.mark.parametrize("kind,grid", [("forest", GRID), ("boosted", BOOST)])
@pytest.mark.parametrize("time_series", [False, True])
@pytest.mark.parametrize("long", [False, True])
def test_equals_brute_force(spark, panel, monkeypatch, kind, grid, time_series, long):
    if long:
        if kind == "forest" and time_series:
            pytest.skip("one way of folding is enough for the long form")
        monkeypatch.setattr(T, "LOCAL_ROWS", 45)  # the first series grows by levels, the second does not
        monkeypatch.setattr(T, "BLOCK_ROWS", 25)
        grid = {**grid, "trees": [2]} | ({"depth": [1, 9], "trees": [3]} if kind == "forest" else {"rate": [0.5]})
    pdf, table = panel
    model = T.train_trees(table, ["k"], "t", ["u", "v"], "y", grid, kind, time_series=time_series, folds=3)
    guesses = held(T.predict_trees(table, model), pdf)
    scores = {(r.k, r.spec): r.score for r in model.scores.collect()}
    best = {r.k: r.spec for r in model.best.collect()}
    for key in ("a", None):
        own = (pdf["k"] == key) if key else pdf["k"].isna()
        x, y = pdf.loc[own, ["u", "v"]].to_numpy(), pdf.loc[own, "y"].to_numpy()
        expected, top, guess = brute(x, y, grid, kind, time_series)
        assert np.allclose([scores[key, s] for s in range(len(expected))], expected, rtol=1e-9)
        assert best[key] == top
        assert np.allclose(np.array(guesses)[own.to_numpy()], guess, rtol=1e-9)


def test_one_tree_without_draws_is_group_means(spark, panel):
    pdf, table = panel
    table = table.selectExpr("k", "t", "case when u > 4 then 1 else 0 end as u", "y")
    model = T.train_trees(table, ["k"], "t", ["u"], "y", {"rate": [1.0], "trees": [1], "depth": [1]}, "boosted", folds=2)
    found = T.predict_trees(table, model).groupBy("k", "u").agg({"prediction": "min", "y": "avg"})
    assert all(abs(r[2] - r[3]) < 1e-9 for r in found.collect())


def test_rows_without_features_and_series_without_trees(spark, panel):
    _, table = panel
    model = T.train_trees(table, ["k"], "t", ["u", "v"], "y", {"trees": [3], "depth": [2]}, folds=2)
    more = spark.createDataFrame([("z", 1, 1.0, 1.0), ("a", 999, None, 1.0), ("a", 1000, 50.0, 1.0)], "k string, t long, u double, v double")
    found = {(r.k, r.t): r.prediction for r in T.predict_trees(more, model).collect()}
    assert found["z", 1] is None and found["a", 999] is None and found["a", 1000] > 0
    assert T.predict_trees(more.limit(0), model).count() == 0


def test_short_and_constant_series(spark):
    rows = [("one", 0, 1.0, 5.0), ("two", 0, 1.0, 5.0), ("two", 1, 2.0, 7.0)] + [("flat", i, float(i), 3.0) for i in range(20)]
    rows += [("none", i, None, 1.0) for i in range(5)]
    table = spark.createDataFrame(rows, "k string, t long, u double, y double")
    for kind in ("forest", "boosted"):
        model = T.train_trees(table, ["k"], "t", ["u"], "y", {"trees": [5]}, kind)
        found = {(r.k, r.t): r.prediction for r in T.predict_trees(table, model).collect()}
        assert all(found["flat", i] == pytest.approx(3) for i in range(20)) and found["none", 0] is None
        assert found["one", 0] == 5 and 5 <= found["two", 0] <= 7
        assert {r.k: r.score for r in model.best.collect()}["one"] is None


def test_no_keys(spark, panel):
    pdf, table = panel
    table = table.where("k = 'a'")
    model = T.train_trees(table, [], "t", ["u", "v"], "y", {"trees": [3], "depth": [2]}, folds=2)
    assert T.predict_trees(table, model).where("prediction is null").count() == 0



def test_no_condition_is_on_all_features_at_once(spark, monkeypatch):
    made = []

    def caught(df):
        made.append(df)
        raise InterruptedError

    monkeypatch.setattr(T, "settle", caught)
    names = [f"x{k}" for k in range(10)]
    table = spark.createDataFrame([("a", 0, *range(10), 1.0)], f"k string, i long, {', '.join(f'{c} long' for c in names)}, y double")
    with pytest.raises(InterruptedError):
        T.train_trees(table, ["k"], "i", names, "y")
    plan = made[0]._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "isnan" in plan and "atleastnnonnulls" not in plan


def test_rows_without_a_value_take_no_part(spark):
    rows = [(0, 1.0, 2.0), (1, None, 2.0), (2, float("nan"), 2.0), (3, 1.0, None), (4, 1.0, float("nan")), (5, 0.0, -1.0)]
    table = spark.createDataFrame(rows, "i long, x double, y double")
    assert sorted(r.i for r in T._complete(table, ["x", "y"]).collect()) == [0, 5]
