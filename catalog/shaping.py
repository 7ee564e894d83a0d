"""Queries for the reshape, profile and window operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.frames import (
    DAILY,
    FEATURES,
    GAPPY,
    HOURLY,
    PANEL,
    WEEKLY,
    daily,
    gappy_panel,
    hourly,
    lines_by_week,
    orders_by_week,
    panel,
    rounded,
    table,
    weekly,
)
from catalog.registry import query
from loomcast.operators import profile as P
from loomcast.operators import reshape as R
from loomcast.operators import windows as W

# ---- reshape ---------------------------------------------------------------------------


@query("series_index", f"WITH {WEEKLY} SELECT k, t, i, y FROM s")
def _(spark, sf):
    return R.series_index(orders_by_week(spark, sf), ["k"], "t").select("k", "t", "i", "y")


@query("only_series", f"WITH {WEEKLY} SELECT k, t, y FROM wk WHERE k IN ('1-URGENT', '5-LOW')")
def _(spark, sf):
    return R.only_series(orders_by_week(spark, sf), "k", "1-URGENT", "5-LOW").select("k", "t", "y")


@query("series_names", "SELECT DISTINCT o_orderpriority AS k FROM orders")
def _(spark, sf):
    return R.series_names(table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "k"), "k")


@query(
    "complete_cases",
    f"WITH {GAPPY} SELECT k, t, qty, price, cases FROM g "
    "WHERE qty IS NOT NULL AND price IS NOT NULL AND cases IS NOT NULL",
)
def _(spark, sf):
    return R.complete_cases(gappy_panel(spark, sf).select("k", "t", "qty", "price", "cases"))


@query("complete_cases_subset", f"WITH {GAPPY} SELECT k, t, qty, price FROM g WHERE price IS NOT NULL")
def _(spark, sf):
    return R.complete_cases(gappy_panel(spark, sf).select("k", "t", "qty", "price"), ["price"])


@query(
    "to_long",
    f"WITH {PANEL} "
    + " UNION ALL ".join(f"SELECT k, t, '{c}' AS variable, {c} AS value FROM p" for c in FEATURES),
)
def _(spark, sf):
    return R.to_long(lines_by_week(spark, sf), ["k", "t"], FEATURES)


@query(
    "to_matrix",
    "SELECT o_orderstatus AS status, "
    + ", ".join(
        f"round(sum(o_totalprice) FILTER (o_orderpriority = '{c}'), 2) AS \"{c}\""
        for c in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    )
    + " FROM orders GROUP BY 1",
)
def _(spark, sf):
    scores = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderstatus").alias("status"), "o_orderpriority")
        .agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
    )
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return R.to_matrix(scores, ["status"], "o_orderpriority", "value", names)


@query("project", f"WITH {PANEL} SELECT cases AS total_cases, k AS city, t AS week_start_date, qty FROM p")
def _(spark, sf):
    return R.project(
        lines_by_week(spark, sf),
        ["cases", "k", "t", "qty"],
        {"cases": "total_cases", "k": "city", "t": "week_start_date"},
    )


@query("columns_except", f"WITH {PANEL} SELECT k, t, qty, disc FROM p")
def _(spark, sf):
    frame = lines_by_week(spark, sf)
    return frame.select(*R.columns_except(frame.columns, ["price", "tax", "cases"]))


@query(
    "split_fraction",
    f"WITH {WEEKLY} SELECT k, t, y, CASE WHEN i < floor(0.8 * count(*) OVER (PARTITION BY k)) "
    "THEN 'train' ELSE 'test' END AS part FROM s",
)
def _(spark, sf):
    return R.split_fraction(weekly(spark, sf), ["k"], "i", 0.8).select("k", "t", "y", "part")


@query(
    "split_at",
    f"WITH {WEEKLY} SELECT k, t, y, CASE WHEN i < 75 THEN 'first' ELSE 'second' END AS part FROM s",
)
def _(spark, sf):
    return R.split_at(weekly(spark, sf), "i", 75).select("k", "t", "y", "part")


@query(
    "split_half",
    f"WITH {WEEKLY} SELECT k, t, y, CASE WHEN i < floor(count(*) OVER (PARTITION BY k) / 2) "
    "THEN 'first' ELSE 'second' END AS part FROM s",
)
def _(spark, sf):
    return R.split_half(weekly(spark, sf), ["k"], "i").select("k", "t", "y", "part")


@query("fill_missing_only", f"WITH {WEEKLY} SELECT k, t, coalesce(v, n) AS v FROM s")
def _(spark, sf):
    return R.fill_missing_only(weekly(spark, sf), "v", "n").select("k", "t", "v")


@query(
    "forecast_horizon",
    f"WITH {GAPPY} SELECT k, CAST(count(*) FILTER (cases IS NULL) AS BIGINT) AS horizon FROM g GROUP BY k",
)
def _(spark, sf):
    return R.forecast_horizon(gappy_panel(spark, sf), ["k"], "cases")


@query(
    "calendar_features",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(month(o_orderdate) AS INTEGER) AS month, "
    "dayname(o_orderdate) AS weekday FROM orders",
)
def _(spark, sf):
    days = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return R.calendar_features(days, "d")


# ---- profile ---------------------------------------------------------------------------

_PCT = " UNION ALL ".join(
    f"SELECT {{key}}'{c}' AS variable, 100.0 * count(*) FILTER ({c} IS NULL) / count(*) AS pct_missing "
    "FROM g{group}"
    for c in [*FEATURES, "cases"]
)


@query(
    "missing_profile",
    f"WITH {GAPPY}, r AS ({_PCT.format(key='', group='')}) "
    "SELECT variable, round(CAST(pct_missing AS DOUBLE), 8) AS pct_missing FROM r",
)
def _(spark, sf):
    return rounded(P.missing_profile(gappy_panel(spark, sf), [*FEATURES, "cases"]), 8, "pct_missing")


@query(
    "missing_profile_by_series",
    f"WITH {GAPPY}, r AS ({_PCT.format(key='k, ', group=' GROUP BY k')}) "
    "SELECT k, variable, round(CAST(pct_missing AS DOUBLE), 8) AS pct_missing FROM r",
)
def _(spark, sf):
    return rounded(
        P.missing_profile(gappy_panel(spark, sf), [*FEATURES, "cases"], ["k"]), 8, "pct_missing"
    )


@query(
    "split_easy_difficult",
    f"WITH {GAPPY}, r AS ({_PCT.format(key='k, ', group=' GROUP BY k')}) "
    "SELECT k, variable, pct_missing < 1 AS easy FROM r",
)
def _(spark, sf):
    profile = P.missing_profile(gappy_panel(spark, sf), [*FEATURES, "cases"], ["k"])
    return P.split_easy_difficult(profile, 1).select("k", "variable", "easy")


@query(
    "nrmse",
    f"WITH {WEEKLY} SELECT k, round(sqrt(sum(power(y - n * 190000, 2)) / 50) / (max(y) - min(y)), 8) "
    "AS nrmse FROM s GROUP BY k",
)
def _(spark, sf):
    guesses = weekly(spark, sf).withColumn("guess", F.col("n") * 190000)
    return rounded(P.nrmse(guesses, ["k"], "y", "guess", 50), 8, "nrmse")


@query(
    "mae",
    f"WITH {WEEKLY} SELECT k, round(avg(abs(y - n * 190000)), 4) AS mae FROM s GROUP BY k",
)
def _(spark, sf):
    guesses = weekly(spark, sf).withColumn("guess", F.col("n") * 190000)
    return rounded(P.mae(guesses, ["k"], "y", "guess"), 4, "mae")


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, "
        + ("1.0::DOUBLE" if a == b else f"round(corr({a}, {b}), 8)")
        + " AS corr FROM "
        + ("(SELECT 1)" if a == b else "lineitem")
        for a in _NUM
        for b in _NUM
    ),
)
def _(spark, sf):
    return rounded(P.corr_matrix(table(spark, sf, "lineitem"), _NUM), 8, "corr")


@query(
    "top_correlated",
    f"WITH {PANEL}, r AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, round(abs(corr({c}, cases)), 8) AS corr FROM p" for c in FEATURES
    )
    + ") SELECT * FROM r ORDER BY corr DESC, variable LIMIT 3",
)
def _(spark, sf):
    return rounded(
        P.top_correlated(lines_by_week(spark, sf), "cases", FEATURES, 3), 8, "corr"
    )


@query(
    "correlation_ends",
    f"WITH {PANEL}, r AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, round(corr({c}, cases), 8) AS corr FROM p" for c in FEATURES
    )
    + ") SELECT * FROM ((SELECT * FROM r ORDER BY corr LIMIT 1) UNION ALL "
    "(SELECT * FROM r ORDER BY corr DESC LIMIT 1))",
)
def _(spark, sf):
    return rounded(
        P.top_correlated(lines_by_week(spark, sf), "cases", FEATURES, 1, "ends"), 8, "corr"
    )


@query(
    "mean_encode",
    "WITH m AS (SELECT CAST(weekofyear(o_orderdate) AS INTEGER) AS w, avg(o_totalprice) AS e FROM orders GROUP BY 1) "
    "SELECT o_orderkey, m.w AS week, round(e, 4) AS week_enc FROM orders JOIN m ON m.w = weekofyear(o_orderdate)",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.weekofyear("o_orderdate").alias("week"), "o_totalprice"
    )
    encoded = P.mean_encode(orders, "week", "o_totalprice", out="week_enc")
    return rounded(encoded, 4, "week_enc").select("o_orderkey", "week", "week_enc")


@query(
    "skewness",
    "WITH r AS ("
    + " UNION ALL ".join(
        f"SELECT l_returnflag AS k, '{c}' AS variable, "
        f"(avg(power({c}, 3)) - 3 * avg({c}) * avg(power({c}, 2)) + 2 * power(avg({c}), 3)) / power(var_pop({c}), 1.5) AS s "
        "FROM lineitem GROUP BY 1"
        for c in ("l_quantity", "l_extendedprice")
    )
    + ") SELECT k, variable, round(s, 5) AS skewness, abs(s) > 1 AS skewed FROM r",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "k")
    return rounded(P.skewness(lines, ["l_quantity", "l_extendedprice"], ["k"]), 5, "skewness")


@query(
    "log_shift",
    "SELECT c_custkey, round(ln(c_acctbal + abs(min(c_acctbal) OVER (PARTITION BY c_mktsegment)) + 1), 8) "
    "AS logged FROM customer",
)
def _(spark, sf):
    logged = P.log_shift(table(spark, sf, "customer"), ["c_mktsegment"], "c_acctbal")
    return rounded(logged.select("c_custkey", "logged"), 8, "logged")


@query(
    "log_shift_if_skewed",
    "WITH m AS (SELECT event_type, min(value) AS lo, (avg(power(value, 3)) - 3 * avg(value) * avg(power(value, 2)) "
    "+ 2 * power(avg(value), 3)) / power(var_pop(value), 1.5) AS sk, avg(value) AS a FROM events GROUP BY 1) "
    "SELECT event_id, round(CASE WHEN abs(sk) > 1 AND lo - a <= 0 THEN ln(value - a + abs(lo - a) + 1) "
    "ELSE value - a END, 6) AS logged FROM events JOIN m USING (event_type)",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    means = events.groupBy("event_type").agg(F.avg("value").alias("_a"))
    centred = events.join(means, "event_type").withColumn("value", F.col("value") - F.col("_a"))
    logged = P.log_shift_if_skewed(centred, ["event_type"], "value")
    return rounded(logged.select("event_id", "logged"), 6, "logged")


@query(
    "standardize",
    f"WITH {PANEL} SELECT k, t, round((qty - avg(qty) OVER w) / stddev_pop(qty) OVER w, 6) AS qty, "
    "round((price - avg(price) OVER w) / stddev_pop(price) OVER w, 6) AS price FROM p WINDOW w AS (PARTITION BY k)",
)
def _(spark, sf):
    scaled = P.standardize(lines_by_week(spark, sf), ["k"], ["qty", "price"])
    return rounded(scaled.select("k", "t", "qty", "price"), 6, "qty", "price")


@query(
    "apply_scaler",
    f"WITH {PANEL}, f AS (SELECT k, avg(qty) AS m, stddev_pop(qty) AS d FROM p WHERE i < 200 GROUP BY k) "
    "SELECT k, t, round((qty - m) / d, 6) AS qty FROM p JOIN f USING (k)",
)
def _(spark, sf):
    frame = panel(spark, sf)
    scaler = P.fit_scaler(frame.where("i < 200"), ["k"], ["qty"])
    return rounded(P.apply_scaler(frame, scaler, ["k"], ["qty"]).select("k", "t", "qty"), 6, "qty")


@query(
    "minmax_scale",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS price, round((l_quantity - min(l_quantity) OVER w) / "
    "(max(l_quantity) OVER w - min(l_quantity) OVER w), 8) AS qty FROM lineitem WINDOW w AS (PARTITION BY l_returnflag)",
)
def _(spark, sf):
    scaled = P.minmax_scale(table(spark, sf, "lineitem"), ["l_returnflag"], ["l_quantity"])
    return rounded(
        scaled.select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").alias("qty"),
        ),
        8,
        "qty",
    )


@query(
    "max_scale",
    f"WITH {WEEKLY} SELECT k, t, round(y / max(y) OVER (PARTITION BY k), 8) AS scaled FROM s",
)
def _(spark, sf):
    return rounded(
        P.max_scale(orders_by_week(spark, sf), ["k"], "y").select("k", "t", "scaled"), 8, "scaled"
    )


@query(
    "missing_counts",
    f"WITH {GAPPY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS missing FROM g"
        for c in [*FEATURES, "cases"]
    ),
)
def _(spark, sf):
    return P.missing_counts(gappy_panel(spark, sf), [*FEATURES, "cases"])


@query(
    "ecdf",
    "WITH c AS (SELECT l_returnflag AS k, l_extendedprice AS v, count(*) AS n FROM lineitem GROUP BY 1, 2) "
    "SELECT k, v, CAST(n AS BIGINT) AS n, round(CAST(sum(n) OVER (PARTITION BY k ORDER BY v) AS DOUBLE) / "
    "CAST(sum(n) OVER (PARTITION BY k) AS DOUBLE), 10) AS share FROM c",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("k"), F.col("l_extendedprice").alias("v")
    )
    return rounded(P.ecdf(lines, ["k"], "v"), 10, "share")


@query(
    "histogram",
    "WITH r AS (SELECT o_orderpriority AS k, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1), "
    "b AS (SELECT k, lo, hi, CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 20.0)), 19) AS INTEGER) AS bin "
    "FROM orders JOIN r ON k = o_orderpriority) "
    "SELECT k, bin, round(lo + bin * ((hi - lo) / 20.0), 4) AS bin_start, CAST(count(*) AS BIGINT) AS n "
    "FROM b GROUP BY k, bin, lo, hi",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "k")
    return rounded(P.histogram(orders, ["k"], "o_totalprice", 20), 4, "bin_start")


@query(
    "boxplot_stats",
    "WITH q AS (SELECT o_orderpriority AS k, quantile_cont(o_totalprice, 0.25) AS q1, median(o_totalprice) AS median, "
    "quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1) "
    "SELECT k, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, "
    "min(o_totalprice) FILTER (o_totalprice >= q1 - 1.5 * (q3 - q1)) AS whisker_low, "
    "max(o_totalprice) FILTER (o_totalprice <= q3 + 1.5 * (q3 - q1)) AS whisker_high "
    "FROM orders JOIN q ON k = o_orderpriority GROUP BY k, q1, median, q3",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "k")
    return rounded(P.boxplot_stats(orders, ["k"], "o_totalprice"), 4, "q1", "median", "q3")


# ---- windows ---------------------------------------------------------------------------

_NEAR = """
f AS (SELECT k, h, i, v,
  last_value(v IGNORE NULLS) OVER a AS pv, last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER a AS pi,
  first_value(v IGNORE NULLS) OVER b AS nv, first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER b AS ni
  FROM e WINDOW a AS (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  b AS (PARTITION BY k ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
_LINEAR = (
    "CASE WHEN v IS NOT NULL THEN v WHEN pi IS NULL THEN NULL WHEN ni IS NULL THEN pv "
    "ELSE pv + (nv - pv) * (i - pi) / (ni - pi) END"
)


@query("fill_forward", f"WITH {HOURLY}, {_NEAR} SELECT k, h, pv AS filled FROM f")
def _(spark, sf):
    return W.fill_forward(hourly(spark, sf), ["k"], "i", "v").select("k", "h", "filled")


@query("fill_backward", f"WITH {HOURLY}, {_NEAR} SELECT k, h, nv AS filled FROM f")
def _(spark, sf):
    return W.fill_backward(hourly(spark, sf), ["k"], "i", "v").select("k", "h", "filled")


@query("fill_linear", f"WITH {HOURLY}, {_NEAR} SELECT k, h, round({_LINEAR}, 8) AS filled FROM f")
def _(spark, sf):
    filled = W.fill_linear(hourly(spark, sf), ["k"], "i", "v")
    return rounded(filled.select("k", "h", "filled"), 8, "filled")


@query(
    "fill_neighbour_mean",
    f"WITH {HOURLY} SELECT k, h, round(coalesce(v, avg(v) OVER (PARTITION BY k ORDER BY i "
    "ROWS BETWEEN 4 PRECEDING AND 3 FOLLOWING)), 8) AS filled FROM e",
)
def _(spark, sf):
    filled = W.fill_neighbour_mean(hourly(spark, sf), ["k"], "i", "v", 8)
    return rounded(filled.select("k", "h", "filled"), 8, "filled")


@query(
    "fill_candidates",
    f"WITH {HOURLY}, {_NEAR}, m AS (SELECT k, h, avg(v) OVER (PARTITION BY k ORDER BY i "
    "ROWS BETWEEN 4 PRECEDING AND 3 FOLLOWING) AS mv FROM e) SELECT k, h, pv AS ffill, nv AS bfill, "
    f"round({_LINEAR}, 8) AS linear, round(coalesce(v, mv), 8) AS knn FROM f JOIN m USING (k, h)",
)
def _(spark, sf):
    filled = W.fill_candidates(hourly(spark, sf), ["k"], "i", "v", 8)
    return rounded(
        filled.select("k", "h", "ffill", "bfill", "linear", "knn"), 8, "linear", "knn"
    )


@query(
    "lag_features",
    f"WITH {PANEL} SELECT k, t, "
    + ", ".join(f"lag({c}, {h}) OVER w AS {c}_{h}" for c, L in (("qty", 3), ("price", 2)) for h in range(1, L + 1))
    + " FROM p WINDOW w AS (PARTITION BY k ORDER BY i)",
)
def _(spark, sf):
    lagged = W.lag_features(panel(spark, sf), ["k"], "i", {"qty": 3, "price": 2})
    return lagged.drop("i", "qty", "price", "disc", "tax", "cases")


@query(
    "select_target_lags",
    f"WITH {PANEL} SELECT k, t, qty, lag(qty, 1) OVER w AS qty_1, lag(cases, 2) OVER w AS cases_2, "
    "lag(cases, 4) OVER w AS cases_4 FROM p WINDOW w AS (PARTITION BY k ORDER BY i)",
)
def _(spark, sf):
    lagged = W.lag_features(
        panel(spark, sf).select("k", "t", "i", "qty", "cases"), ["k"], "i", {"qty": 1, "cases": 5}
    )
    return W.select_target_lags(lagged, "cases", [2, 4]).drop("i", "cases")


@query(
    "difference",
    f"WITH {WEEKLY} SELECT k, t, round(y - lag(y) OVER w, 4) AS diff FROM s WINDOW w AS (PARTITION BY k ORDER BY i)",
)
def _(spark, sf):
    return rounded(
        W.difference(weekly(spark, sf), ["k"], "i", "y").select("k", "t", "diff"), 4, "diff"
    )


@query(
    "difference_twice",
    f"WITH {WEEKLY}, d1 AS (SELECT k, t, i, y - lag(y) OVER (PARTITION BY k ORDER BY i) AS x FROM s) "
    "SELECT k, t, round(x - lag(x) OVER (PARTITION BY k ORDER BY i), 4) AS diff FROM d1",
)
def _(spark, sf):
    return rounded(
        W.difference(weekly(spark, sf), ["k"], "i", "y", 2).select("k", "t", "diff"), 4, "diff"
    )


@query(
    "moving_peaks",
    f"WITH {WEEKLY} SELECT k, t, CASE WHEN i >= 104 THEN round(avg(y) OVER w, 5) END AS trail_mean, CASE WHEN i >= 104 THEN round(stddev_pop(y) OVER w, 3) END AS trail_std, "
    "CAST(CASE WHEN i >= 104 AND abs(y - avg(y) OVER w) > 3 * stddev_pop(y) OVER w THEN 1 ELSE 0 END AS INTEGER) "
    "AS signal FROM s WINDOW w AS (PARTITION BY k ORDER BY i ROWS BETWEEN 104 PRECEDING AND 1 PRECEDING)",
)
def _(spark, sf):
    peaks = W.moving_peaks(weekly(spark, sf), ["k"], "i", "y", 104, 3)
    kept = peaks.select("k", "t", "trail_mean", "trail_std", "signal")
    return rounded(rounded(kept, 5, "trail_mean"), 3, "trail_std")


@query(
    "winsorize_upper",
    f"WITH {DAILY}, r AS (SELECT k, t, c, row_number() OVER (PARTITION BY k ORDER BY c, i) - 1 AS r, "
    "count(*) OVER (PARTITION BY k) AS n FROM d), "
    "cap AS (SELECT k, c AS top FROM r WHERE r = n - floor(n * 2.5 / 100) - 1) "
    "SELECT k, t, c, least(c, top) AS capped FROM d JOIN cap USING (k)",
)
def _(spark, sf):
    return W.winsorize_upper(daily(spark, sf), ["k"], "c", 2.5).select("k", "t", "c", "capped")


@query(
    "clip_negative",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer",
)
def _(spark, sf):
    return W.clip_negative(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


@query(
    "round_forecast",
    f"WITH {DAILY} SELECT k, t, CAST(round_even(c / 2.0, 0) AS INTEGER) AS half FROM d",
)
def _(spark, sf):
    halves = daily(spark, sf).select("k", "t", (F.col("c") / 2).alias("half"))
    return W.round_forecast(halves, "half")
