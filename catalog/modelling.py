"""Queries for stationarity, selection, model and forecast operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.frames import FEATURES, GAPPY, PANEL, WEEKLY, gappy_panel, lines_by_week, panel, rounded, weekly
from catalog.registry import query
from catalog.statistics import wave
from loomcast.operators import arma as A
from loomcast.operators import forecast as C
from loomcast.operators import harmonic as N
from loomcast.operators import likelihood as K
from loomcast.operators import models as M
from loomcast.operators import regression as L
from loomcast.operators import selection as G
from loomcast.operators import stationarity as U
from loomcast.plans.boosting import train_lag_forest
from loomcast.plans.forecasting import Setting, forecast_panel, order_search
from loomcast.plans.prepare import prepare_panel
from loomcast.session import settle

# ---- stationarity ----------------------------------------------------------------------


@query(
    "adf_without_lags",
    f"""WITH {WEEKLY}, r AS (SELECT k, y - lag(y) OVER w AS dy, lag(y) OVER w - avg(y) OVER (PARTITION BY k) AS x FROM s WINDOW w AS (PARTITION BY k ORDER BY i)),
g AS (SELECT k, count(*) AS n, regr_slope(dy, x) AS b, regr_sxx(dy, x) AS sxx, regr_syy(dy, x) AS syy, regr_sxy(dy, x) AS sxy FROM r WHERE x IS NOT NULL GROUP BY k)
SELECT k, CAST(n AS BIGINT) AS n, 0::INTEGER AS lag, round(b / sqrt((syy - b * sxy) / (n - 2) / sxx), 6) AS adf_stat FROM g""",
)
def _(spark, sf):
    found = U.adf_test(weekly(spark, sf), ["k"], "i", "y", lag=0)
    return rounded(found.drop("p_value"), 6, "adf_stat")


@query(
    "adf_with_one_lag",
    f"""WITH {WEEKLY}, d AS (SELECT k, i, y - lag(y) OVER w AS dy, lag(y) OVER w AS l FROM s WINDOW w AS (PARTITION BY k ORDER BY i)),
r AS (SELECT k, dy AS y, l AS a, lag(dy) OVER (PARTITION BY k ORDER BY i) AS b FROM d),
g AS (SELECT k, count(*) AS n, count(*) * covar_pop(a, a) AS aa, count(*) * covar_pop(b, b) AS bb, count(*) * covar_pop(a, b) AS ab,
  count(*) * covar_pop(a, y) AS ay, count(*) * covar_pop(b, y) AS byy, count(*) * covar_pop(y, y) AS yy FROM r WHERE b IS NOT NULL GROUP BY k),
f AS (SELECT *, (ay * bb - byy * ab) / (aa * bb - ab * ab) AS ca, (byy * aa - ay * ab) / (aa * bb - ab * ab) AS cb FROM g)
SELECT k, CAST(n AS BIGINT) AS n, 1::INTEGER AS lag, round(ca / sqrt((yy - ca * ay - cb * byy) / (n - 3) * bb / (aa * bb - ab * ab)), 6) AS adf_stat FROM f""",
)
def _(spark, sf):
    found = U.adf_test(weekly(spark, sf), ["k"], "i", "y", lag=1)
    return rounded(found.drop("p_value"), 6, "adf_stat")


@query("adf_test")
def _(spark, sf):
    return rounded(U.adf_test(weekly(spark, sf), ["k"], "i", "y"), 8, "adf_stat", "p_value")


def _walk(spark, sf):
    """The running sum of the centred weekly value: a series with a unit root."""
    from pyspark.sql import Window

    frame = weekly(spark, sf)
    by_key = Window.partitionBy("k")
    centred = frame.withColumn("c", F.col("y") - F.avg("y").over(by_key))
    return centred.withColumn("walk", F.sum("c").over(by_key.orderBy("i")))


@query("difference_until_stationary")
def _(spark, sf):
    _, report = U.difference_until_stationary(_walk(spark, sf), ["k"], "i", "walk")
    return rounded(report, 6, "adf_stat", "p_value")


@query("stationary_series")
def _(spark, sf):
    changed, _ = U.difference_until_stationary(_walk(spark, sf), ["k"], "i", "walk")
    return rounded(changed.select("k", "t", "stationary"), 4, "stationary")


# ---- selection -------------------------------------------------------------------------


@query(
    "granger_one_lag",
    f"""WITH {PANEL}, r AS (SELECT k, cases AS y, lag(cases) OVER w AS a, lag(qty) OVER w AS b FROM p WINDOW w AS (PARTITION BY k ORDER BY i)),
g AS (SELECT k, count(*) AS n, count(*) * covar_pop(a, a) AS aa, count(*) * covar_pop(b, b) AS bb, count(*) * covar_pop(a, b) AS ab,
  count(*) * covar_pop(a, y) AS ay, count(*) * covar_pop(b, y) AS byy, count(*) * covar_pop(y, y) AS yy FROM r WHERE a IS NOT NULL GROUP BY k),
f AS (SELECT *, (ay * bb - byy * ab) / (aa * bb - ab * ab) AS ca, (byy * aa - ay * ab) / (aa * bb - ab * ab) AS cb FROM g),
z AS (SELECT k, n, yy - ay * ay / aa AS short, yy - ca * ay - cb * byy AS ful FROM f)
SELECT k, 1::INTEGER AS lag, CAST(n AS BIGINT) AS n, round((short - ful) / (ful / (n - 3)), 6) AS f FROM z""",
)
def _(spark, sf):
    found = G.granger(panel(spark, sf), ["k"], "i", "cases", "qty", 1)
    return rounded(found.drop("p_value"), 6, "f")


@query("granger")
def _(spark, sf):
    found = G.granger(panel(spark, sf), ["k"], "i", "cases", "qty", 52)
    return rounded(found, 8, "f", "p_value")


@query("granger_features")
def _(spark, sf):
    return G.granger_features(panel(spark, sf), ["k"], "i", "cases", FEATURES, 52)


@query("lasso_select")
def _(spark, sf):
    found = L.lasso_select(panel(spark, sf), ["k"], "i", "price", FEATURES)
    return rounded(found, 6, "coef")


@query(
    "lasso_one_feature",
    # one standardised feature: the covariance, moved towards zero by the penalty
    f"WITH {PANEL}, g AS (SELECT k, covar_pop(price, qty) / stddev_pop(qty) AS c FROM p GROUP BY k) "
    "SELECT k, 'qty' AS feature, round(sign(c) * (abs(c) - 0.01), 6) AS coef FROM g WHERE abs(c) > 0.01",
)
def _(spark, sf):
    found = L.lasso_select(panel(spark, sf), ["k"], "i", "price", ["qty"], alphas=[0.01])
    return rounded(found, 6, "coef")


@query("lasso_cv")
def _(spark, sf):
    fits = L.penalised_cv(panel(spark, sf), ["k"], "i", FEATURES, "cases")
    return rounded(fits.select("k", "alpha", "score"), 6, "score")


@query("ridge_cv")
def _(spark, sf):
    fits = L.penalised_cv(
        panel(spark, sf), ["k"], "i", FEATURES, "cases", kind="ridge", time_series=False, scoring="mse"
    )
    return rounded(fits.select("k", "alpha", "score"), 6, "score")


@query(
    "ridge_fit",
    f"WITH {PANEL}, g AS (SELECT k, regr_sxy(cases, qty) / (regr_sxx(cases, qty) + 3) AS b, avg(cases) AS my, avg(qty) AS mx FROM p GROUP BY k) "
    "SELECT k, round(my - b * mx, 6) AS intercept, round(b, 8) AS coef FROM g",
)
def _(spark, sf):
    fits = L.ridge_fit(panel(spark, sf), ["k"], "i", "cases", ["qty"], 3.0)
    one = fits.select("k", "intercept", F.element_at("coef", 1).alias("coef"))
    return rounded(rounded(one, 6, "intercept"), 8, "coef")


@query(
    "kfold_contiguous",
    f"WITH {WEEKLY}, c AS (SELECT k, t, i, count(*) OVER (PARTITION BY k) AS n FROM s) "
    "SELECT k, t, CAST(CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1) "
    "ELSE (i - (n % 5) * (n // 5 + 1)) // (n // 5) + n % 5 END AS INTEGER) AS fold FROM c",
)
def _(spark, sf):
    return L.kfold_contiguous(weekly(spark, sf), ["k"], "i").select("k", "t", "fold")


@query(
    "time_series_folds",
    f"WITH {WEEKLY}, c AS (SELECT k, t, i, count(*) OVER (PARTITION BY k) AS n FROM s), "
    "f AS (SELECT unnest(generate_series(0, 4)) AS fold), "
    "r AS (SELECT k, t, i, CAST(fold AS INTEGER) AS fold, n - (5 - fold) * (n // 6) AS a, n - (4 - fold) * (n // 6) AS b FROM c, f) "
    "SELECT k, t, fold, CASE WHEN i < a THEN 'train' ELSE 'test' END AS role FROM r WHERE i < b",
)
def _(spark, sf):
    return L.time_series_folds(weekly(spark, sf), ["k"], "i").select("k", "t", "fold", "role")


# ---- ARMA ------------------------------------------------------------------------------


@query(
    "spec_grid",
    f"WITH {WEEKLY} SELECT DISTINCT k, season, p, q FROM s, (SELECT unnest([52, 104])::INTEGER AS season), "
    "(SELECT unnest(generate_series(0, 3))::INTEGER AS p), (SELECT unnest(generate_series(0, 10))::INTEGER AS q)",
)
def _(spark, sf):
    return A.spec_grid(weekly(spark, sf), ["k"], range(4), range(11), [52, 104])


def _shocks(spark, sf):
    return A.innovations(weekly(spark, sf), ["k"], "i", "y")


def _grid(spark, sf, p, q, seasons=(0,)):
    return A.arma_grid(_shocks(spark, sf), ["k"], p, q, seasons)


def _scores(table):
    kept = table.select("k", "season", "p", "q", "n", "aic", "bic", "lb_q", "lb_p")
    return rounded(kept, 5, "aic", "bic", "lb_q", "lb_p")


@query("innovations")
def _(spark, sf):
    return rounded(_shocks(spark, sf).select("k", "i", "z", "e"), 8, "z", "e")


@query("arma_grid")
def _(spark, sf):
    return _scores(_grid(spark, sf, range(1, 7), range(1, 11)))


@query("seasonal_arx_grid")
def _(spark, sf):
    frame = panel(spark, sf)
    shocks = A.innovations(frame, ["k"], "i", "cases", ["qty", "price"])
    table = A.arma_grid(shocks, ["k"], range(4), range(11), [52, 104], ["qty", "price"])
    return _scores(table)


@query("best_spec")
def _(spark, sf):
    return _scores(A.best_spec(_grid(spark, sf, range(0, 4), range(0, 4), [0, 52]), ["k"]))


@query(
    "arma_likelihood_ar1",
    # the first value and the one-step errors, each weighted by its own variance
    f"""WITH {WEEKLY}, z AS (SELECT k, i, stddev_pop(y) OVER w AS sd, (y - avg(y) OVER w) / stddev_pop(y) OVER w AS z FROM s WINDOW w AS (PARTITION BY k)),
l AS (SELECT *, lag(z) OVER (PARTITION BY k ORDER BY i) AS x FROM z),
g AS (SELECT k, count(*) AS n, any_value(sd) AS sd, sum(CASE WHEN x IS NULL THEN 0.75 * z * z ELSE (z - 0.5 * x) * (z - 0.5 * x) END) AS q FROM l GROUP BY k)
SELECT k, CAST(n AS BIGINT) AS n, round(-n / 2.0 * (ln(2 * pi() * q / n) + 1) + ln(0.75) / 2 - n * ln(sd), 5) AS loglik FROM g""",
)
def _(spark, sf):
    shocks = settle(_shocks(spark, sf))
    given = shocks.select("k").distinct().select(
        "k", F.array(F.lit(0.5)).alias("phi"), F.array().cast("array<double>").alias("theta"), F.lit(0.0).alias("mean")
    )
    return rounded(K.arma_log_likelihood(shocks, given, ["k"]), 5, "loglik")


@query(
    "arma_likelihood_noise",
    # order (0, 0): the normal density of a constant with its own variance
    f"WITH {WEEKLY} SELECT k, CAST(count(*) AS BIGINT) AS n, round(-count(*) / 2.0 * (ln(2 * pi() * var_pop(y)) + 1), 4) AS loglik, "
    "round(count(*) * (ln(2 * pi() * var_pop(y)) + 1) + 4, 4) AS aic FROM s GROUP BY k",
)
def _(spark, sf):
    found = K.likelihood_grid(_shocks(spark, sf), ["k"], [0], [0])
    return rounded(found.select("k", "n", "loglik", "aic"), 4, "loglik", "aic")


@query(
    "arma_likelihood_season",
    # a coefficient at lag 52 alone: 52 interleaved first-order series
    f"""WITH {WEEKLY}, z AS (SELECT k, i, stddev_pop(y) OVER w AS sd, (y - avg(y) OVER w) / stddev_pop(y) OVER w AS z FROM s WINDOW w AS (PARTITION BY k)),
l AS (SELECT *, lag(z, 52) OVER (PARTITION BY k ORDER BY i) AS x FROM z),
g AS (SELECT k, count(*) AS n, any_value(sd) AS sd, sum(CASE WHEN x IS NULL THEN 0.84 * z * z ELSE (z - 0.4 * x) * (z - 0.4 * x) END) AS q FROM l GROUP BY k)
SELECT k, CAST(n AS BIGINT) AS n, round(-n / 2.0 * (ln(2 * pi() * q / n) + 1) + 52 * ln(0.84) / 2 - n * ln(sd), 5) AS loglik FROM g""",
)
def _(spark, sf):
    shocks = settle(_shocks(spark, sf))
    phi = F.concat(F.array_repeat(F.lit(0.0), 51), F.array(F.lit(0.4)))
    given = shocks.select("k").distinct().select(
        "k", phi.alias("phi"), F.array().cast("array<double>").alias("theta"), F.lit(0.0).alias("mean")
    )
    return rounded(K.arma_log_likelihood(shocks, given, ["k"]), 5, "loglik")


@query("seasonal_product_grid")
def _(spark, sf):
    found = K.likelihood_grid(_shocks(spark, sf), ["k"], [0, 1], [0, 1], [(0, 0, 0), (1, 0, 52), (0, 1, 52), (1, 1, 52)])
    kept = found.select("k", "season", "p", "q", "sp", "sq", "n", "loglik", "aic", "bic", "status")
    return rounded(kept, 3, "loglik", "aic", "bic")


@query("arma_likelihood_grid")
def _(spark, sf):
    found = K.likelihood_grid(_shocks(spark, sf), ["k"], range(1, 7), range(1, 11))
    return rounded(found.select("k", "p", "q", "n", "loglik", "aic", "bic", "status"), 3, "loglik", "aic", "bic")


@query("seasonal_likelihood_forecast")
def _(spark, sf):
    found = C.seasonal_arma_forecast(weekly(spark, sf), ["k"], "i", "y", (3, 1), 52, 60, likelihood=True)
    return rounded(found, 2, "mean", "lower", "upper")


@query("fit_summary")
def _(spark, sf):
    table = A.fit_summary(_grid(spark, sf, [1], [1]), ["k"])
    return rounded(table, 5, "rss", "aic", "bic", "coef", "se", "t_value")


@query(
    "fit_summary_ar1",
    f"""WITH {WEEKLY}, z AS (SELECT k, i, (y - avg(y) OVER w) / stddev_pop(y) OVER w AS z, count(*) OVER w AS n FROM s WINDOW w AS (PARTITION BY k)),
l AS (SELECT k, i, n, z, lag(z) OVER (PARTITION BY k ORDER BY i) AS x FROM z),
g AS (SELECT k, count(*) AS n, regr_slope(z, x) AS b, regr_sxx(z, x) AS sxx, regr_syy(z, x) AS syy, regr_sxy(z, x) AS sxy
  FROM l WHERE i >= ceil(10 * log10(n)) + 1 GROUP BY k)
SELECT k, CAST(n AS BIGINT) AS n, round(b, 6) AS coef, round(sqrt((syy - b * sxy) / (n - 2) / sxx), 6) AS se FROM g""",
)
def _(spark, sf):
    table = A.fit_summary(_grid(spark, sf, [1], [0]), ["k"]).where("term = 'ar_1'")
    return rounded(table.select("k", "n", "coef", "se"), 6, "coef", "se")


@query("arma_forecast")
def _(spark, sf):
    shocks = _shocks(spark, sf)
    fits = A.arma_grid(shocks, ["k"], [3], [1])
    return rounded(A.arma_forecast(shocks, fits, ["k"], 52), 3, "mean", "lower", "upper")


# a first-order fit on the common sample, as two numbers per series
_AR1 = f"""{WEEKLY}, z AS (SELECT k, i, avg(y) OVER w AS m, stddev_pop(y) OVER w AS sd, (y - avg(y) OVER w) / stddev_pop(y) OVER w AS z,
  count(*) OVER w AS n FROM s WINDOW w AS (PARTITION BY k)),
l AS (SELECT *, lag(z) OVER (PARTITION BY k ORDER BY i) AS x FROM z),
g AS (SELECT k, regr_slope(z, x) AS b, regr_intercept(z, x) AS c FROM l WHERE i >= ceil(10 * log10(n)) + 1 GROUP BY k)"""


@query(
    "arma_forecast_ar1",
    f"WITH {_AR1}, e AS (SELECT k, m, sd, z, b, c FROM z JOIN g USING (k) WHERE i = n - 1) "
    "SELECT k, h::INTEGER AS step, round(m + sd * (c * (1 - b ** h) / (1 - b) + b ** h * z), 2) AS mean "
    "FROM e, (SELECT unnest(generate_series(1, 30)) AS h)",
)
def _(spark, sf):
    shocks = _shocks(spark, sf)
    fits = A.arma_grid(shocks, ["k"], [1], [0])
    return rounded(A.arma_forecast(shocks, fits, ["k"], 30).select("k", "step", "mean"), 2, "mean")


@query(
    "in_sample_predict_ar1",
    f"WITH {_AR1}, a AS (SELECT z.*, b, c, lag(z) OVER (PARTITION BY k ORDER BY i) AS x FROM z JOIN g USING (k)), "
    "o AS (SELECT k, z AS last FROM a WHERE i = n - 101) "
    "SELECT k, i, round(m + sd * CASE WHEN i < n - 100 THEN c + b * coalesce(x, 0) "
    "ELSE c * (1 - b ** (i - n + 101)) / (1 - b) + b ** (i - n + 101) * last END, 2) AS mean FROM a JOIN o USING (k)",
)
def _(spark, sf):
    shocks = settle(_shocks(spark, sf))
    fits = A.arma_grid(shocks, ["k"], [1], [0])
    found = A.in_sample_predict(shocks, fits, ["k"], "i", 100)
    return rounded(found.select("k", "i", "mean"), 2, "mean")


@query("in_sample_predict")
def _(spark, sf):
    shocks = settle(_shocks(spark, sf))
    fits = A.arma_grid(shocks, ["k"], [3], [1])
    found = A.in_sample_predict(shocks, fits, ["k"], "i", 100)
    return rounded(found, 3, "actual", "mean", "lower", "upper")


@query("order_search")
def _(spark, sf):
    found = order_search(
        weekly(spark, sf), "k", "t", "y", Setting((1, 1), 52, 2.5), range(1, 4), range(1, 10)
    )
    return _scores(found)


@query("seasonal_arma_forecast")
def _(spark, sf):
    found = C.seasonal_arma_forecast(weekly(spark, sf), ["k"], "i", "y", (3, 1), 52, 60)
    return rounded(found, 3, "mean", "lower", "upper")


# ---- harmonic --------------------------------------------------------------------------


@query("harmonic_deseasonalize")
def _(spark, sf):
    found = N.harmonic_deseasonalize(wave(spark, sf), ["k"], "i", "x", [26], 2)
    return rounded(found.select("k", "t", "season", "adjusted"), 3, "season", "adjusted")


@query(
    "harmonic_one_wave",
    # normal equations of (1, sin, cos), centred, solved by Cramer's rule
    f"""WITH {WEEKLY}, r AS (SELECT k, t, i, y, sin(2 * pi() * (i % 52) / 52) AS a, cos(2 * pi() * (i % 52) / 52) AS b FROM s),
g AS (SELECT k, covar_pop(a, a) AS aa, covar_pop(b, b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS byy FROM r GROUP BY k)
SELECT r.k, t, round(a * (ay * bb - byy * ab) / (aa * bb - ab * ab) + b * (byy * aa - ay * ab) / (aa * bb - ab * ab), 3) AS season
FROM r JOIN g ON g.k = r.k""",
)
def _(spark, sf):
    found = N.harmonic_deseasonalize(weekly(spark, sf), ["k"], "i", "y", [52], 1)
    return rounded(found.select("k", "t", "season"), 3, "season")


@query("harmonic_scores")
def _(spark, sf):
    scores, _ = N.harmonic_forecast(weekly(spark, sf), ["k"], "i", "y", 12)
    return rounded(scores, 4, "aic")


@query("harmonic_forecast")
def _(spark, sf):
    _, ahead = N.harmonic_forecast(weekly(spark, sf), ["k"], "i", "y", 60)
    return rounded(ahead, 3, "mean", "lower", "upper")


# ---- comparison and combination -----------------------------------------------------------


@query(
    "compare_models",
    f"""WITH {WEEKLY}, h AS (SELECT k, i, y, n, floor(0.8 * count(*) OVER (PARTITION BY k)) AS cut FROM s),
l AS (SELECT a.k, a.y, b.y AS g, 'season' AS model FROM h a JOIN h b ON a.k = b.k AND a.i >= a.cut AND b.i = a.i - 52 * CAST(floor((a.i - a.cut) / 52) + 1 AS BIGINT)
  UNION ALL SELECT k, y, (SELECT avg(q.y) FROM h q WHERE q.k = h.k AND q.i < q.cut), 'mean' FROM h WHERE i >= cut),
m AS (SELECT k, model, avg(abs(y - g)) AS mae FROM l GROUP BY 1, 2)
SELECT k, model, round(mae, 3) AS mae, row_number() OVER (PARTITION BY k ORDER BY mae, model) = 1 AS best FROM m""",
)
def _(spark, sf):
    train, test = C.holdout_frame(weekly(spark, sf), ["k"], "i", "y", 0.8)
    repeated = C.season_repeat_forecast(train, ["k"], "i", "y", 52, 400)
    flat = train.groupBy("k").agg(F.avg("y").alias("mean"))
    truth = test.select("k", "step", "y")
    both = truth.join(repeated, ["k", "step"]).withColumn("model", F.lit("season")).unionByName(
        truth.join(flat, "k").withColumn("model", F.lit("mean"))
    )
    return rounded(C.compare_models(both, ["k"], "model", "y", "mean"), 3, "mae")


@query("compare_forecasts")
def _(spark, sf):
    train, test = C.holdout_frame(settle(weekly(spark, sf)), ["k"], "i", "y", 0.8)
    truth = test.select("k", "step", "y")
    horizon = truth.groupBy("k").agg(F.max("step").alias("horizon"))
    shocks = A.innovations(train, ["k"], "i", "y")
    fits = A.best_spec(A.arma_grid(shocks, ["k"], range(0, 4), range(0, 4), [0, 52]), ["k"])
    arma = A.arma_forecast(shocks, fits, ["k"], horizon).withColumn("model", F.lit("arma"))
    _, ahead = N.harmonic_forecast(train, ["k"], "i", "y", horizon)
    waves = ahead.withColumn("model", F.concat(F.lit("harmonic "), "span"))
    guesses = arma.select("k", "model", "step", "mean").unionByName(
        waves.select("k", "model", "step", "mean")
    )
    scored = C.compare_models(truth.join(guesses, ["k", "step"]), ["k"], "model", "y", "mean")
    return rounded(scored, 3, "mae")


@query(
    "combine_forecasts",
    f"""WITH {GAPPY}, f AS (SELECT k, avg(cases) AS a FROM g GROUP BY k),
m AS (SELECT k, t, row_number() OVER (PARTITION BY k ORDER BY t) AS step FROM g WHERE cases IS NULL)
SELECT k, t, CAST(round_even(greatest(a - 1.7 * step, 0), 0) AS INTEGER) AS cases FROM m JOIN f USING (k)""",
)
def _(spark, sf):
    frame = gappy_panel(spark, sf)
    means = frame.groupBy("k").agg(F.avg("cases").alias("a"))
    steps = C.missing_steps(frame, ["k"], "t", "cases").select("k", "step")
    guesses = steps.join(means, "k").select("k", "step", (F.col("a") - F.lit(1.7) * F.col("step")).alias("mean"))
    return C.combine_forecasts(frame, guesses, ["k"], "t", "cases", ["k", "t"])


@query("forecast_panel")
def _(spark, sf):
    frame = gappy_panel(spark, sf).drop("i")
    settings = {"A": Setting((3, 1), 104, 2.5)}
    return forecast_panel(frame, "k", "t", "cases", ["k", "t"], settings)


# ---- trees -----------------------------------------------------------------------------


@query("forest_grid")
def _(spark, sf):
    frame = panel(spark, sf)
    model = M.train_trees(frame, ["k"], "i", FEATURES, "cases")
    return rounded(M.predict_trees(frame, model).select("k", "t", "cases", "prediction"), 6, "prediction")


@query("boosted_grid")
def _(spark, sf):
    frame = panel(spark, sf)
    model = M.train_trees(
        frame, ["k"], "i", FEATURES, "cases", kind="boosted", scoring="neg_mean_absolute_error", time_series=True
    )
    return rounded(M.predict_trees(frame, model).select("k", "t", "cases", "prediction"), 6, "prediction")


@query(
    "boosted_stump",
    # one round of one cut on one feature: the cut whose two group means leave least, the lowest of equals
    f"""WITH {PANEL}, v AS (SELECT DISTINCT k, qty FROM p),
c AS (SELECT k, qty AS a, lead(qty) OVER (PARTITION BY k ORDER BY qty) AS b FROM v),
g AS (SELECT c.k, c.a, c.b, sum(CASE WHEN p.qty <= c.a THEN cases END) AS y1, count(*) FILTER (WHERE p.qty <= c.a) AS n1,
  sum(CASE WHEN p.qty > c.a THEN cases END) AS y2, count(*) FILTER (WHERE p.qty > c.a) AS n2 FROM c JOIN p ON p.k = c.k WHERE c.b IS NOT NULL GROUP BY 1, 2, 3),
s AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(y1 * y1 / n1 + y2 * y2 / n2, 6) DESC, a) AS r FROM g WHERE n1 >= 5 AND n2 >= 5)
SELECT p.k, p.t, round(CASE WHEN p.qty <= s.a THEN y1 / n1 ELSE y2 / n2 END, 6) AS prediction FROM p JOIN s ON s.k = p.k AND s.r = 1""",
)
def _(spark, sf):
    frame = panel(spark, sf)
    grid = {"rate": [1.0], "trees": [1], "depth": [1], "min_leaf": [5]}
    model = M.train_trees(frame, ["k"], "i", ["qty"], "cases", grid, "boosted", folds=2)
    return rounded(M.predict_trees(frame, model).select("k", "t", "prediction"), 6, "prediction")


@query("impute_by_model")
def _(spark, sf):
    filled, _, _ = M.impute_by_model(gappy_panel(spark, sf), ["k"], "i", "price", ["disc", "tax"])
    return rounded(filled.select("k", "t", "price", "prediction"), 6, "prediction")


@query("impute_difficult")
def _(spark, sf):
    filled, _ = M.impute_difficult(gappy_panel(spark, sf), ["k"], "i", "price", ["disc", "tax"])
    return rounded(filled.select("k", "t", "price", "method"), 6, "price")


@query("impute_chained")
def _(spark, sf):
    filled, _ = M.impute_chained(gappy_panel(spark, sf), ["k"], "i", ["price", "qty"], ["disc", "tax"])
    return rounded(filled.select("k", "t", "price", "qty"), 6, "price", "qty")


@query("impute_scores_report")
def _(spark, sf):
    _, report = M.impute_chained(gappy_panel(spark, sf), ["k"], "i", ["price", "qty"], ["disc", "tax"])
    return rounded(report, 6, "nrmsd")


@query("prepared_panel")
def _(spark, sf):
    frame = gappy_panel(spark, sf).drop("i")
    done = prepare_panel(frame, ["k"], "t", FEATURES, "cases")
    return rounded(done.panel.select("k", "t", "cases", *FEATURES), 6, *FEATURES)


@query("lag_forest")
def _(spark, sf):
    done = train_lag_forest(lines_by_week(spark, sf), ["k"], "t", FEATURES, "cases")
    return rounded(done.predict().select("k", "t", "adjusted", "prediction"), 6, "adjusted", "prediction")
