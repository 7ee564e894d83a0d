"""Operators against pandas, numpy and plain restatements."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loomcast.functions import curves, tails
from loomcast.operators import (
    arma,
    decompose,
    forecast,
    harmonic,
    hypothesis,
    impute,
    profile,
    regression,
    reshape,
    selection,
    spectrum,
    stationarity,
    trend,
    windows,
)
from tests.conftest import table_of


def by_key(pdf, column, work):
    return np.concatenate([work(g[column].reset_index(drop=True)) for _, g in pdf.groupby("k")])


def close(got, want, **kw):
    np.testing.assert_allclose(np.asarray(got, float), np.asarray(want, float), **{"rtol": 1e-9, "atol": 1e-9, **kw})


def test_fills_match_pandas(frames):
    pdf, bounded, _ = frames
    got = table_of(windows.fill_candidates(bounded, ["k"], "i", "v"), "k", "i")
    close(got["ffill"], by_key(pdf, "v", lambda s: s.ffill()))
    close(got["bfill"], by_key(pdf, "v", lambda s: s.bfill()))
    close(got["linear"], by_key(pdf, "v", lambda s: s.interpolate("linear")))

    def near(s):
        out = s.copy()
        for i in np.flatnonzero(s.isna()):
            out[i] = s.iloc[max(0, i - 4) : i + 4].mean()
        return out

    close(got["knn"], by_key(pdf, "v", near))
    known = got["v"].notna()
    for c in ("ffill", "bfill", "linear", "knn"):
        assert (got.loc[known, c] == got.loc[known, "v"]).all()


def test_cubic_reproduces_a_cubic_and_keeps_ends_missing(frames):
    _, bounded, _ = frames
    x = F.col("i") / 50.0
    curve = bounded.withColumn("p", F.when(F.col("v").isNotNull(), x * x * x - 2 * x + 1))
    got = table_of(impute.fill_cubic(curve, ["k"], "i", "p"), "k", "i")
    inside = got["filled"].notna()
    t = got["i"] / 50.0
    close(got.loc[inside, "filled"], (t**3 - 2 * t + 1)[inside], atol=1e-7)


def test_difference_then_running_sum_restores(frames):
    pdf, bounded, _ = frames
    got = table_of(windows.difference(bounded, ["k"], "i", "wave"), "k", "i")
    back = got.groupby("k")["diff"].transform(lambda s: s.fillna(0).cumsum())
    first = got.groupby("k")["wave"].transform("first")
    close(back + first, got["wave"])


def test_moving_peaks_matches_a_loop(frames):
    pdf, bounded, _ = frames
    got = table_of(windows.moving_peaks(bounded, ["k"], "i", "wave", 30, 1.2), "k", "i")

    def loop(s):
        y, out = s.to_numpy(), np.zeros(len(s))
        for i in range(30, len(y)):
            out[i] = abs(y[i] - y[i - 30 : i].mean()) > 1.2 * y[i - 30 : i].std()
        return out

    want = by_key(pdf, "wave", loop)
    assert (got["signal"] == want).all() and want.sum() > 0


@pytest.mark.parametrize("column", ["x", "ties"])
def test_winsorize_caps_the_top(frames, column):
    pdf, bounded, _ = frames
    got = table_of(windows.winsorize_upper(bounded, ["k"], column, 2.5), "k", "i")

    def cap(s):
        k = int(len(s) * 0.025)
        return np.minimum(s, np.sort(s)[len(s) - k - 1])

    close(got["capped"], by_key(pdf, column, cap))


def test_forecast_rounding_is_half_to_even(spark):
    df = spark.createDataFrame([(-0.4,), (0.5,), (1.5,), (2.5,), (None,)], "v double")
    got = windows.round_forecast(windows.clip_negative(df, "v"), "v").collect()
    assert [r.v for r in got] == [0, 0, 2, 2, None]


def test_target_lag_selection():
    assert windows.leading_target_lags("y", 3) == ["y_1", "y_2", "y_3"]
    assert windows.longest_lag(["a_2", "b", "y_10"]) == 10
    assert reshape.columns_except(["c", "a", "b"], ["a"]) == ["c", "b"]
    assert reshape.columns_with_prefix(["y_1", "x", "y_2"], "y_") == ["y_1", "y_2"]


def test_nrmse_is_missing_where_a_guess_is(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 3.0, None), ("b", 1.0, 2.0), ("b", 3.0, 3.0)], "k string, y double, g double")
    got = {r.k: r.nrmse for r in profile.nrmse(df, ["k"], "y", "g", 1).collect()}
    assert got == {"a": None, "b": 0.5}


def test_choice_puts_missing_scores_last_and_breaks_ties_in_order(spark):
    rows = [("a", "knn", 0.1), ("a", "ffill", 0.1), ("a", "bfill", None), ("b", "bfill", None), ("b", "linear", 0.9)]
    scores = spark.createDataFrame(rows, "k string, method string, nrmse double")
    got = {r.k: r.method for r in impute.choose_imputer(scores, ["k"]).collect()}
    assert got == {"a": "ffill", "b": "linear"}
    only = {r.k: r.method for r in impute.choose_imputer(scores, ["k"], ["ffill"]).collect()}
    assert only["a"] == "knn"


def test_impute_easy_fills_everything_and_changes_nothing_known(frames):
    _, bounded, _ = frames
    got = table_of(impute.impute_easy(bounded, ["k"], "i", "v", 30), "k", "i")
    assert got["filled"].notna().all()
    known = got["v"].notna()
    assert (got.loc[known, "v"] == got.loc[known, "filled"]).all()


def test_assert_complete_names_the_column(frames):
    with pytest.raises(ValueError, match="'v'"):
        profile.assert_complete(frames[1], ["x", "v"])
    profile.assert_complete(frames[1], ["x"])


def test_constant_columns_scale_to_zero(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 2.0)], "k string, x double")
    assert [r.x for r in profile.standardize(df, ["k"], ["x"]).collect()] == [0.0, 0.0]
    assert [r.x for r in profile.minmax_scale(df, ["k"], ["x"]).collect()] == [0.0, 0.0]


def test_spectrum_matches_numpy(frames):
    pdf, bounded, _ = frames
    got = table_of(spectrum.power_spectrum(bounded, ["k"], "i", "wave"), "k", "m")

    def power(s):
        return np.abs(np.fft.fft(s))[1 : (len(s) - 1) // 2 + 1]

    close(got["power"], by_key(pdf, "wave", power))
    found = table_of(spectrum.dominant_period(spectrum.power_spectrum(bounded, ["k"], "i", "wave"), ["k"]), "k")
    assert found["period"].between(25, 30).all()


def test_prominence_and_peaks_on_a_hand_made_spectrum():
    power = np.array([0.0, 5, 1, 3, 3, 1, 9, 2, 4, 2, 0])
    peaks = spectrum._local_peaks(power)
    assert peaks.tolist() == [1, 3, 6, 8]
    assert [spectrum._prominence(power, p) for p in peaks] == [4.0, 2.0, 9.0, 2.0]


def test_acf_and_pacf(frames):
    pdf, bounded, _ = frames
    got = table_of(spectrum.acf(bounded, ["k"], "i", "y", 12), "k", "lag")
    y = pdf.loc[pdf.k == "a", "y"].to_numpy()
    e = y - y.mean()
    close(got.loc[got.k == "a", "acf"], [(e[h:] * e[: len(e) - h]).sum() / (e * e).sum() for h in range(13)])
    part = table_of(spectrum.pacf(bounded, ["k"], "i", "y", 12), "k", "lag")
    r = got.loc[got.k == "a", "acf"].to_numpy() * len(y) / (len(y) - np.arange(13))
    for k in (1, 2, 5):
        toeplitz = r[np.abs(np.subtract.outer(np.arange(k), np.arange(k)))]
        want = np.linalg.solve(toeplitz, r[1 : k + 1])[-1]
        close(part.loc[(part.k == "a") & (part.lag == k), "pacf"], [want])


def test_loess_parts_of_a_pure_series():
    i = np.arange(200)
    season = 4 * np.sin(2 * np.pi * i / 13)
    got, line, rest = curves.loess_decompose(5 + 0.1 * i + season, 13)
    close(got, season, atol=1e-8)
    close(line, 5 + 0.1 * i, atol=1e-8)
    close(rest, 0 * i, atol=1e-8)
    noise = np.random.default_rng(1).normal(size=200) * 0.1
    spiked = np.where(i == 77, 40.0, 0.0)
    got, line, rest = curves.loess_decompose(5 + 0.1 * i + season + noise + spiked, 13, True)
    close(got, season, atol=0.4)
    close(got + line + rest, 5 + 0.1 * i + season + noise + spiked)
    assert rest[77] > 39


def test_moving_average_season_sums_to_zero(frames):
    _, bounded, _ = frames
    got = table_of(decompose.seasonal_decompose(bounded, ["k"], "i", "wave", 26), "k", "i")
    close(got[got.i < 26].groupby("k")["season"].sum(), [0, 0, 0])


@pytest.mark.parametrize("column", ["wave", "ties"])
def test_mann_kendall_against_all_pairs(frames, column):
    pdf, bounded, _ = frames
    got = table_of(trend.mann_kendall(bounded, ["k"], "i", column), "k")
    for row, (_, g) in zip(got.itertuples(), pdf.groupby("k")):
        y = g[column].to_numpy()
        i, j = np.triu_indices(len(y), 1)
        assert row.s == np.sign(y[j] - y[i]).sum()
        close(row.slope, np.median((y[j] - y[i]) / (j - i)))
        close(row.intercept, np.median(y) - row.slope * (len(y) - 1) / 2)


def test_detrending_removes_the_slope(frames):
    _, bounded, _ = frames
    changed, report = trend.detrend_mk(bounded, ["k"], "i", "wave")
    after = table_of(trend.mann_kendall(changed, ["k"], "i", "detrended"), "k")
    trended = table_of(report, "k")["pre_trend"] != "no trend"
    assert trended.sum() >= 2
    close(after["slope"][trended], 0 * after["slope"][trended], atol=1e-6)
    assert set(table_of(report, "k")["pre_trend"]) <= {"increasing", "decreasing", "no trend"}


def test_unit_root_is_found_and_differenced_away(frames):
    _, bounded, _ = frames
    changed, report = stationarity.difference_until_stationary(bounded, ["k"], "i", "walk")
    got = table_of(report, "k")
    assert (got["p_value"] <= 0.05).all() and (got["n_diff"] >= 1).any()
    rows = table_of(changed, "k", "i")
    for key, d in zip(got["k"], got["n_diff"]):
        part = rows[rows.k == key]
        close(part["stationary"].to_numpy()[d:], np.diff(part["walk"], d))


def test_adf_against_least_squares(frames):
    pdf, bounded, _ = frames
    y = pdf.loc[pdf.k == "a", "walk"].to_numpy()
    got = table_of(stationarity.adf_test(bounded, ["k"], "i", "walk", lag=2), "k").iloc[0]
    dy = np.diff(y)
    x = np.column_stack([np.ones(len(dy) - 2), y[2:-1], dy[1:-1], dy[:-2]])
    coef, *_ = np.linalg.lstsq(x, dy[2:], rcond=None)
    e = dy[2:] - x @ coef
    se = np.sqrt(e @ e / (len(e) - 4) * np.linalg.inv(x.T @ x)[1, 1])
    close(got.adf_stat, coef[1] / se)
    close(tails.adf_p([-3.43, -2.86, -2.57]), [0.01, 0.05, 0.1], atol=1e-3)


def test_granger_finds_the_planted_lag(frames):
    pdf, bounded, _ = frames
    tests = selection.granger(bounded, ["k"], "i", "y", "x", 5)
    got = table_of(tests, "k", "lag")
    assert (got[got.lag >= 3]["p_value"] < 1e-6).all()
    g = pdf[pdf.k == "a"]
    y, x, L = g["y"].to_numpy(), g["x"].to_numpy(), 3
    short = np.column_stack([np.ones(len(y) - L), *[y[L - h : len(y) - h] for h in range(1, L + 1)]])
    full = np.column_stack([short, *[x[L - h : len(x) - h] for h in range(1, L + 1)]])
    rss = lambda m: ((y[L:] - m @ np.linalg.lstsq(m, y[L:], rcond=None)[0]) ** 2).sum()
    want = (rss(short) - rss(full)) / L / (rss(full) / (len(y) - L - 2 * L - 1))
    close(got[(got.k == "a") & (got.lag == L)]["f"], [want], rtol=1e-7)
    assert (table_of(selection.significant_lags(tests, ["k"]), "k")["sign_lag"] >= 3).all()


def test_tails():
    close(tails.f_sf(4.0, 1, 20), 0.05926554, atol=1e-7)
    close(tails.chi2_sf([3.841458820694124, 18.307038053275146], [1, 10]), [0.05, 0.05])
    close(tails.normal_quantile([0.025, 0.5, 0.975]), [-1.959963984540054, 0, 1.959963984540054], atol=1e-9)


def test_anova_and_ks_p_values(frames):
    _, bounded, _ = frames
    halves = bounded.withColumn("half", F.when(F.col("i") < 100, "p").otherwise("q")).where("k <> 'c'")
    far = halves.withColumn("x", F.when(F.col("half") == "p", F.col("x") + 5).otherwise(F.col("x")))
    for op, args in ((hypothesis.ks_two_sample, ("half", "x", "p", "q")), (hypothesis.anova_oneway, ("half", "x"))):
        assert all(r.p_value > 1e-4 for r in op(halves, ["k"], *args).collect())
        assert all(r.p_value < 1e-10 for r in op(far, ["k"], *args).collect())


def test_folds(spark):
    df = spark.createDataFrame([("a", i) for i in range(13)], "k string, i long")
    folds = [r.fold for r in regression.kfold_contiguous(df, ["k"], "i").orderBy("i").collect()]
    assert folds == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 4, 4]
    segments = [r.segment for r in regression.time_segments(df, ["k"], "i").orderBy("i").collect()]
    assert segments == [0, 0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    split = table_of(regression.time_series_folds(df, ["k"], "i"), "fold", "i")
    for f in range(5):
        part = split[split.fold == f]
        assert part[part.role == "test"]["i"].tolist() == list(range(13 - (5 - f) * 2, 13 - (4 - f) * 2))
        assert part[part.role == "train"]["i"].tolist() == list(range(13 - (5 - f) * 2))


def test_lasso_equals_spark_ml_and_wide_path_equals_narrow(frames, monkeypatch):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from loomcast.functions import gram

    pdf, bounded, _ = frames
    one = bounded.where("k = 'a'")
    cols = ["x", "wave", "ties"]
    got = regression.penalised_cv(one, ["k"], "i", cols, "y", alphas=[0.05]).first()
    g = pdf[pdf.k == "a"]
    z = (g[cols] - g[cols].mean()) / g[cols].std(ddof=0)
    train = VectorAssembler(inputCols=cols, outputCol="features").transform(
        one.sparkSession.createDataFrame(z.assign(y=g["y"]))
    )
    model = LinearRegression(
        elasticNetParam=1.0, regParam=0.05, standardization=False, labelCol="y", tol=1e-12, maxIter=2000
    ).fit(train)
    close(got["coef"], model.coefficients.toArray(), atol=1e-6)
    monkeypatch.setattr(gram, "NARROW", 1)
    wide = regression.penalised_cv(one, ["k"], "i", cols, "y", alphas=[0.05]).first()
    close(wide["coef"], got["coef"])
    close(wide["score"], got["score"])


def test_arma_recovers_its_coefficients(spark):
    rng = np.random.default_rng(3)
    n = 4000
    e, y = rng.normal(size=n), np.zeros(n)
    for t in range(1, n):
        y[t] = 0.6 * y[t - 1] + e[t] + 0.4 * e[t - 1]
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "h": np.arange(n), "y": y}))
    series = reshape.series_index(df, ["k"], "h", span=(0, n))
    shocks = arma.innovations(series, ["k"], "i", "y").cache()
    grid = arma.arma_grid(shocks, ["k"], [1, 2], [0, 1])
    best = arma.best_spec(grid, ["k"]).first()
    assert best.q == 1 and best.lb_p > 0.05
    fit = {r.term: r.coef for r in arma.fit_summary(grid.where("p = 1 and q = 1"), ["k"]).collect()}
    assert abs(fit["ar_1"] - 0.6) < 0.05 and abs(fit["ma_1"] - 0.4) < 0.06
    ahead = table_of(arma.arma_forecast(shocks, grid.where("p = 1 and q = 1"), ["k"], 40), "step")
    assert abs(ahead["mean"].iloc[-1] - y.mean()) < 0.2
    assert (np.diff(ahead["upper"] - ahead["lower"]) > -1e-9).all()
    seen = arma.in_sample_predict(shocks, grid.where("p = 1 and q = 1"), ["k"], "i", 260)
    got = table_of(seen, "i")
    assert len(got) == n and (got.actual - got["mean"])[100:-260].std() < 1.05
    close(got["actual"], y, atol=1e-7)


def test_harmonic_season_is_recovered(spark):
    i = np.arange(400)
    y = 7 + 3 * np.sin(2 * np.pi * i / 52) - np.cos(4 * np.pi * i / 52)
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "h": i, "y": y}))
    series = reshape.series_index(df, ["k"], "h", span=(0, 1000))
    got = table_of(harmonic.harmonic_deseasonalize(series, ["k"], "i", "y", [52], 2), "i")
    close(got["adjusted"], 0 * i + 7, atol=1e-9)
    noisy = series.withColumn("y", F.col("y") + F.randn(5) * 0.1)
    scores, ahead = harmonic.harmonic_forecast(noisy, ["k"], "i", "y", 20)
    assert {r.set for r in ahead.select("set").distinct().collect()} <= {"Yearly", "Both"}
    t = 400 + np.arange(20)
    want = 7 + 3 * np.sin(2 * np.pi * t / 52) - np.cos(4 * np.pi * t / 52)
    full = table_of(ahead.where("span = 'full'"), "step")
    close(full["mean"], want, atol=0.3)
    assert scores.count() == 8


def test_seasonal_forecast_continues_a_pure_season(spark):
    i = np.arange(312)
    y = 50 + 10 * np.sin(2 * np.pi * i / 52) + np.random.default_rng(2).normal(size=312) * 0.01
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "h": i, "y": y}))
    series = reshape.series_index(df, ["k"], "h", span=(0, 1000))
    got = table_of(forecast.seasonal_arma_forecast(series, ["k"], "i", "y", (1, 1), 52, 60), "step")
    close(got["mean"], 50 + 10 * np.sin(2 * np.pi * (312 + np.arange(60)) / 52), atol=0.5)


def test_season_repeat(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(10)], "k string, i long, y double")
    got = table_of(forecast.season_repeat_forecast(df, ["k"], "i", "y", 4, 6), "step")
    assert got["mean"].tolist() == [6.0, 7.0, 8.0, 9.0, 6.0, 7.0]


def test_combined_forecast_is_whole_and_not_negative(spark):
    df = spark.createDataFrame(
        [("a", 1, 5.0), ("a", 2, None), ("a", 3, None), ("b", 1, None)], "city string, t long, total_cases double"
    )
    guess = spark.createDataFrame([("a", 1, -2.0), ("a", 2, 3.5), ("b", 1, 2.5)], "city string, step int, mean double")
    got = forecast.combine_forecasts(df, guess, ["city"], "t", columns=["city", "t"])
    assert sorted(map(tuple, got.collect())) == [("a", 2, 0), ("a", 3, 4), ("b", 1, 2)]


@pytest.mark.parametrize("n,p", [(200, 12), (60, 30), (50, 80)])
def test_lasso_gap_certifies_the_fit(n, p):
    from loomcast.operators.regression import _lasso

    draw = np.random.default_rng(n)
    z = draw.normal(size=(n, p))
    x = 0.7 * z[:, :1] + z
    x[:, 1] = x[:, 0]  # two equal columns
    x = (x - x.mean(0)) / x.std(0)
    x[:, 2] = 0
    y = x[:, :5] @ np.array([1, 0, 0, -2, 0.5]) + draw.normal(size=n)
    gram, cross, square, w = x.T @ x / n, x.T @ y / n, y @ y / n, np.zeros(p)
    for alpha in (10.0, 1.0, 0.1, 1e-2, 1e-3, 1e-5, 1e-8):
        w, gap = _lasso(gram, cross, square, alpha, w)
        assert gap <= 1e-8 * square / 2 and w[2] == 0
        value = lambda v, a=alpha: ((y - x @ v) ** 2).mean() / 2 + a * np.abs(v).sum()
        best = min(value(w + step) for step in 1e-3 * draw.normal(size=(50, p)))
        assert best >= value(w) - 1e-12


@pytest.mark.parametrize("n1,n2", [(1, 1), (3, 3), (4, 7), (8, 5), (8, 8)])
def test_exact_two_sample_p_equals_enumeration(n1, n2):
    from itertools import combinations

    from loomcast.functions.tails import ks_exact

    gaps = []
    for own in combinations(range(n1 + n2), n1):
        step = np.array([1 / n1 if k in own else -1 / n2 for k in range(n1 + n2)])
        gaps.append(np.abs(np.cumsum(step)).max())
    for d in sorted({round(g, 12) for g in gaps}):
        assert abs(ks_exact(n1, n2, d) - np.mean(np.array(gaps) >= d - 1e-9)) < 1e-12
    assert ks_exact(n1, n2, 0.0) == 1.0


def test_exact_two_sample_p_nears_the_asymptotic_one(spark):
    from math import comb

    from loomcast.functions.tails import ks_exact

    # equal sizes have a closed form
    n, k = 172, 19
    closed = 2 * sum((-1) ** (j - 1) * comb(2 * n, n - j * k) / comb(2 * n, n) for j in range(1, n // k + 1))
    assert abs(ks_exact(n, n, k / n) - closed) < 1e-12
    rows = [(key, side, float(v)) for key in ("a", None) for side, shift in (("p", 0), ("q", 3)) for v in (np.arange(40) * 1.37 + shift + (side == "q") * 0.01)]
    table = spark.createDataFrame(rows, "k string, half string, x double")
    found = hypothesis.ks_two_sample(table, ["k"], "half", "x", "p", "q", exact=True).collect()
    assert len(found) == 2 and {r.method for r in found} == {"exact"}
    assert all(abs(r.p_value - ks_exact(40, 40, r.statistic)) < 1e-12 for r in found)
