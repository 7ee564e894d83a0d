"""Exact ARMA likelihoods: against the normal density, in blocks, and their maximum."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomcast.functions.kalman import gains, joined, log_likelihood, product, stationary, summarised
from loomcast.operators import arma
from loomcast.operators import likelihood as L
from loomcast.operators.reshape import series_index


def autocovariances(phi, theta, n, terms=4000):
    psi, ma = np.zeros(terms), np.r_[1, theta, np.zeros(terms)]
    for k in range(terms):
        psi[k] = ma[k] + sum(phi[i] * psi[k - 1 - i] for i in range(min(k, len(phi))))
    return np.array([psi[: terms - h] @ psi[h:] for h in range(n)])


@pytest.mark.parametrize("p,q", [(0, 0), (1, 0), (0, 1), (2, 1), (3, 2), (1, 4)])
def test_equals_the_normal_density(p, q):
    draw = np.random.default_rng(p * 7 + q)
    phi, theta = stationary(0.8 * draw.normal(size=(4, p))), -stationary(0.8 * draw.normal(size=(4, q)))
    mean, y = 0.1 * draw.normal(size=4), draw.normal(size=50)
    found = gains(phi, theta)
    squares, logs, _ = joined([summarised(y, 0, mean, found)])
    for s in range(4):
        cov = autocovariances(phi[s], theta[s], 50)[np.abs(np.subtract.outer(np.arange(50), np.arange(50)))]
        rest = y - mean[s]
        assert np.isclose(rest @ np.linalg.solve(cov, rest), squares[s]) and np.isclose(np.linalg.slogdet(cov)[1], logs[s])
    for size in (1, 7, 13):
        parts = joined([summarised(y[k : k + size], k, mean, found) for k in range(0, 50, size)])
        assert np.allclose(parts[0], squares) and np.allclose(parts[1], logs)


def test_polynomials_are_multiplied():
    draw = np.random.default_rng(1)
    short, seasonal = draw.normal(size=(3, 2)), draw.normal(size=(3, 2))
    for sign in (1, -1):
        found = product(short, seasonal, 5, sign)
        for s in range(3):
            long = np.zeros(11)
            long[[0, 5, 10]] = [1, *(sign * seasonal[s])]
            assert np.allclose(np.r_[1, sign * found[s]], np.polymul(np.r_[1, sign * short[s]][::-1], long[::-1])[::-1])


def test_recovers_a_product_of_seasons(spark):
    draw, rows = np.random.default_rng(8), []
    phi = product(np.array([[0.5]]), np.array([[0.6]]), 12, -1)[0]
    theta = product(np.array([[0.3]]), np.array([[0.4]]), 12, 1)[0]
    e, y = draw.normal(size=1400), np.zeros(1400)
    for t in range(13, 1400):
        y[t] = phi @ y[t - 13 : t][::-1] + e[t] + theta @ e[t - 13 : t][::-1]
    rows = [("a", t, float(7 + 2 * v)) for t, v in enumerate(y[400:])]
    table = series_index(spark.createDataFrame(rows, "k string, h long, v double"), ["k"], "h", span=(0, 10_000))
    noise = arma.innovations(table, ["k"], "i", "v")
    found = {(r.sp, r.sq): r for r in L.likelihood_grid(noise, ["k"], [1], [1], [(0, 0, 0), (1, 1, 12)]).collect()}
    best = found[1, 1]
    terms = dict(zip(best.terms, best.coef))
    assert best.status == "ok" and best.aic < found[0, 0].aic - 100 and best.season == 12
    for name, value in (("ar_1", 0.5), ("ar_12", 0.6), ("ma_1", 0.3), ("ma_12", 0.4)):
        assert abs(terms[name] - value) < 0.13
    assert abs(terms["ar_13"] + terms["ar_1"] * terms["ar_12"]) < 1e-9 and abs(terms["ma_13"] - terms["ma_1"] * terms["ma_12"]) < 1e-9
    assert abs(np.sqrt(best.rss / best.n) - 2) < 0.15


@pytest.fixture(scope="module")
def shocks(spark):
    draw, rows = np.random.default_rng(2), []
    for key, n in (("a", 400), (None, 260)):
        e = draw.normal(size=n + 100)
        y = np.zeros(n + 100)
        for t in range(1, n + 100):
            y[t] = 0.7 * y[t - 1] + e[t] + 0.4 * e[t - 1]
        rows += [(key, t, float(50 + 3 * v)) for t, v in enumerate(y[100:])]
    rows += [("flat", t, 1.0) for t in range(30)] + [("tiny", t, float(t)) for t in range(3)]
    table = series_index(spark.createDataFrame(rows, "k string, h long, v double"), ["k"], "h", span=(0, 10_000))
    return arma.innovations(table, ["k"], "i", "v").cache()


def fitted(found):
    return {(r.k, r.p, r.q): r for r in found.collect()}


def test_finds_the_order_and_its_numbers(shocks):
    found = fitted(L.likelihood_grid(shocks, ["k"], [0, 1, 2], [0, 1]))
    assert len(found) == 4 * 6
    best = found["a", 1, 1]
    assert best.status == "ok" and abs(best.coef[1] - 0.7) < 0.12 and abs(best.coef[2] - 0.4) < 0.15
    assert best.aic < found["a", 0, 0].aic and best.aic < found["a", 1, 0].aic
    # a larger model never fits worse
    for k in ("a", None):
        for p, q in ((1, 0), (1, 1), (2, 0)):
            assert found[k, p + (p < 2), q].loglik >= found[k, p, q].loglik - 1e-3
    assert {found["flat", p, q].status for p in (0, 1) for q in (0, 1)} == {"not fitted"}
    assert found["tiny", 2, 1].status == "not fitted"


def test_white_noise_has_its_closed_form(shocks):
    row = fitted(L.likelihood_grid(shocks.where("k = 'a'"), ["k"], [0], [0]))["a", 0, 0]
    rows = shocks.where("k = 'a'").toPandas()
    y = rows["mean"] + rows["sd"] * rows["z"]
    assert abs(row.loglik + len(y) / 2 * (np.log(2 * np.pi * y.var(ddof=0)) + 1)) < 1e-5
    assert abs(row.aic + 2 * row.loglik - 4) < 1e-9


def test_long_series_find_the_same(shocks, monkeypatch):
    mine = shocks.where("k is null or k = 'a'")
    whole = fitted(L.likelihood_grid(mine, ["k"], [1], [0, 1], rounds=12))
    monkeypatch.setattr(L, "LOCAL_ROWS", 300)
    monkeypatch.setattr(L, "BLOCK_ROWS", 150)
    parts = fitted(L.likelihood_grid(mine, ["k"], [1], [0, 1], rounds=12))
    assert whole.keys() == parts.keys()
    for key, row in whole.items():
        assert abs(row.loglik - parts[key].loglik) < 1e-3 and np.allclose(row.coef, parts[key].coef, atol=1e-2)


@pytest.mark.parametrize("size", [20_000, 90, 37])
def test_given_parameters(spark, shocks, monkeypatch, size):
    monkeypatch.setattr(L, "BLOCK_ROWS", size)
    given = spark.createDataFrame([("a", [0.5, 0.1], [0.3], 0.1), (None, [0.5], [], 0.0)], "k string, phi array<double>, theta array<double>, mean double")
    found = {r.k: r for r in L.arma_log_likelihood(shocks, given, ["k"]).collect()}
    for key, phi, theta, mean in (("a", [0.5, 0.1], [0.3], 0.1), (None, [0.5], [], 0.0)):
        rows = shocks.where(F.col("k").eqNullSafe(F.lit(key))).orderBy("j").toPandas()
        squares, logs, n = joined([summarised(rows["z"].to_numpy(), 0, np.array([mean]), gains(np.array([phi]), np.array([theta]).reshape(1, -1)))])
        expected = log_likelihood(squares, logs, n)[0] - n * np.log(rows["sd"].iloc[0])
        assert found[key].n == n and abs(found[key].loglik - expected) < 1e-6


def test_fits_forecast(shocks):
    fits = L.likelihood_grid(shocks.where("k = 'a'"), ["k"], [1], [1])
    ahead = arma.arma_forecast(shocks, fits, ["k"], 40).toPandas()
    assert len(ahead) == 40 and abs(ahead["mean"].iloc[-1] - 50) < 6
    seen = arma.in_sample_predict(shocks, fits, ["k"], "i", 100)
    assert seen.where("k = 'a'").count() == 400
