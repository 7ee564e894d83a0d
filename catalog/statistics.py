"""Queries for spectrum, autocorrelation, decomposition, trend and test operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.frames import DAILY, HOURLY, WEEKLY, daily, hourly, rounded, table, weekly
from catalog.registry import query
from loomcast.operators import decompose as D
from loomcast.operators import hypothesis as H
from loomcast.operators import spectrum as S
from loomcast.operators import trend as T
from loomcast.operators.reshape import split_half

# ---- spectrum --------------------------------------------------------------------------

# the weekly series with a planted 26-week wave
_WAVE = f"""{WEEKLY},
wv AS (SELECT k, t, i, y + 2000000 * cos(2 * pi() * i / 26) AS x, count(*) OVER (PARTITION BY k) AS n FROM s)"""


def wave(spark, sf):
    angle = F.col("i") * F.lit(2 * 3.141592653589793) / F.lit(26)
    return weekly(spark, sf).withColumn("x", F.col("y") + F.lit(2e6) * F.cos(angle))


def _dft(source: str, value: str, zero: bool = False) -> str:
    return f"""bn AS (SELECT k, count(*) AS n, unnest(generate_series({0 if zero else 1}, CAST(floor((count(*) - 1) / 2) AS BIGINT))) AS m
  FROM {source} GROUP BY k),
pw AS (SELECT bn.k, m, bn.n, sqrt(power(sum({value} * cos(2 * pi() * ((m * i) % bn.n) / bn.n)), 2)
  + power(sum({value} * sin(2 * pi() * ((m * i) % bn.n) / bn.n)), 2)) AS power FROM bn JOIN {source} q ON q.k = bn.k GROUP BY bn.k, m, bn.n)"""


# prominence: height over the higher of the two lowest points on the way to higher ground
_PROMINENCE = """nb AS (SELECT *, lag(power) OVER w AS lf, lead(power) OVER w AS rt FROM {bins} WINDOW w AS (PARTITION BY k ORDER BY m)),
pk AS (SELECT * FROM nb WHERE power > lf AND power > rt),
ed AS (SELECT pk.k, pk.m, coalesce((SELECT max(q.m) FROM {bins} q WHERE q.k = pk.k AND q.m < pk.m AND q.power > pk.power), -1) AS a,
  coalesce((SELECT min(q.m) FROM {bins} q WHERE q.k = pk.k AND q.m > pk.m AND q.power > pk.power), 1000000000) AS b FROM pk),
pr AS (SELECT pk.k, pk.m, pk.n, pk.power, pk.lf, pk.rt, pk.power - greatest(
  (SELECT min(q.power) FROM {bins} q WHERE q.k = pk.k AND q.m > ed.a AND q.m <= pk.m),
  (SELECT min(q.power) FROM {bins} q WHERE q.k = pk.k AND q.m < ed.b AND q.m >= pk.m)) AS prom
  FROM pk JOIN ed ON ed.k = pk.k AND ed.m = pk.m)"""


@query(
    "power_spectrum",
    f"WITH {WEEKLY}, {_dft('s', 'y')} SELECT k, CAST(m AS BIGINT) AS m, CAST(n AS BIGINT) AS n, "
    "round(CAST(m AS DOUBLE) / n, 10) AS freq, round(power, 2) AS power FROM pw",
)
def _(spark, sf):
    spectrum = S.power_spectrum(weekly(spark, sf), ["k"], "i", "y")
    return rounded(rounded(spectrum, 10, "freq"), 2, "power")


@query(
    "spectral_peaks",
    f"WITH {_WAVE}, {_dft('wv', 'x')}, ql AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY k) AS bins FROM pw) "
    f"WHERE m <= floor(bins / 4)), {_PROMINENCE.format(bins='ql')}, "
    "lv AS (SELECT k, avg(power) AS mean, stddev_pop(power) AS sd FROM ql GROUP BY k) "
    "SELECT lv.k, round(min_by(CAST(n AS DOUBLE) / m, m), 8) AS period FROM lv LEFT JOIN pr ON pr.k = lv.k AND prom >= 5 * mean "
    "AND least(power - lf, power - rt) >= mean + 3 * sd GROUP BY lv.k",
)
def _(spark, sf):
    spectrum = S.power_spectrum(wave(spark, sf), ["k"], "i", "x")
    return rounded(S.spectral_peaks(spectrum, ["k"]), 8, "period")


@query(
    "spectral_peaks_median",
    f"WITH {_WAVE}, {_dft('wv', 'x', True)}, ql AS (SELECT * FROM pw WHERE CAST(m AS DOUBLE) / n <= 0.25), "
    f"{_PROMINENCE.format(bins='ql')}, lv AS (SELECT k, median(power) AS mid FROM pw GROUP BY k) "
    "SELECT pr.k, CAST(m AS BIGINT) AS m, round(CAST(n AS DOUBLE) / m, 8) AS period, round(power, 2) AS power "
    "FROM pr JOIN lv ON lv.k = pr.k WHERE prom >= 3 * mid",
)
def _(spark, sf):
    spectrum = S.power_spectrum(wave(spark, sf), ["k"], "i", "x", zero=True)
    return rounded(rounded(S.spectral_peaks_median(spectrum, ["k"], 3.0), 8, "period"), 2, "power")


@query(
    "dominant_period",
    f"WITH {_WAVE}, {_dft('wv', 'x')} SELECT k, CAST(round_even(max_by(CAST(n AS DOUBLE) / m, power), 0) AS INTEGER) AS period "
    "FROM pw GROUP BY k",
)
def _(spark, sf):
    return S.dominant_period(S.power_spectrum(wave(spark, sf), ["k"], "i", "x"), ["k"])


def _acf(source: str, value: str, lags: int) -> str:
    return f"""ce AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS j, {value} - avg({value}) OVER (PARTITION BY k) AS e,
  count(*) OVER (PARTITION BY k) AS n FROM {source} WHERE {value} IS NOT NULL),
lg AS (SELECT unnest(generate_series(0, {lags})) AS h),
sm AS (SELECT a.k, h, a.n, sum(a.e * b.e) AS s FROM ce a JOIN lg ON true JOIN ce b ON a.k = b.k AND a.j = b.j + h GROUP BY a.k, h, a.n),
ac AS (SELECT k, h, n, s / first_value(s) OVER (PARTITION BY k ORDER BY h) AS r FROM sm),
bd AS (SELECT k, h, n, r, CASE WHEN h = 0 THEN 0.0 ELSE 1.959963984540054 * sqrt((1 + 2 * coalesce(sum(CASE WHEN h > 0 THEN r * r END)
  OVER (PARTITION BY k ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END AS hw FROM ac)"""


@query(
    "acf",
    f"WITH {HOURLY}, {_acf('e', 'v', 52)} SELECT k, CAST(h AS INTEGER) AS lag, CAST(n AS BIGINT) AS n, round(r, 8) AS acf, "
    "round(hw, 8) AS half_width FROM bd",
)
def _(spark, sf):
    return rounded(S.acf(hourly(spark, sf), ["k"], "i", "v", 52), 8, "acf", "half_width")


@query(
    "pacf_two_lags",
    f"WITH {WEEKLY}, {_acf('s', 'y', 2)}, aj AS (SELECT k, h, n, r * n / (n - h) AS r FROM bd), "
    "w AS (SELECT k, n, max(r) FILTER (h = 1) AS r1, max(r) FILTER (h = 2) AS r2 FROM aj GROUP BY k, n) "
    "SELECT k, 1::INTEGER AS lag, CAST(n AS BIGINT) AS n, round(r1, 8) AS pacf, round(1.959963984540054 / sqrt(n), 8) AS half_width FROM w "
    "UNION ALL SELECT k, 2::INTEGER, CAST(n AS BIGINT), round((r2 - r1 * r1) / (1 - r1 * r1), 8), round(1.959963984540054 / sqrt(n), 8) FROM w",
)
def _(spark, sf):
    partial = S.pacf(weekly(spark, sf), ["k"], "i", "y", 2).where("lag > 0")
    return rounded(partial, 8, "pacf", "half_width")


@query("pacf")
def _(spark, sf):
    return rounded(S.pacf(weekly(spark, sf), ["k"], "i", "y", 52), 8, "pacf", "half_width")


@query(
    "first_insignificant_of_two",
    f"WITH {WEEKLY}, {_acf('s', 'y', 2)}, aj AS (SELECT k, h, n, r * n / (n - h) AS r FROM bd), "
    "w AS (SELECT k, n, max(r) FILTER (h = 1) AS r1, max(r) FILTER (h = 2) AS r2 FROM aj GROUP BY k, n) "
    "SELECT k, CASE WHEN abs(r1) < 1.959963984540054 / sqrt(n) THEN 1 "
    "WHEN abs((r2 - r1 * r1) / (1 - r1 * r1)) < 1.959963984540054 / sqrt(n) THEN 2 END::INTEGER AS lag FROM w",
)
def _(spark, sf):
    return S.first_insignificant_lag(S.pacf(weekly(spark, sf), ["k"], "i", "y", 2), ["k"])


@query("first_insignificant_lag")
def _(spark, sf):
    return S.first_insignificant_lag(S.pacf(weekly(spark, sf), ["k"], "i", "n", 52), ["k"])


@query("significant_auto_lags")
def _(spark, sf):
    lags = S.significant_auto_lags(weekly(spark, sf), ["k"], "i", "y", 60, 52)
    return rounded(lags, 8, "acf", "pacf")


# ---- decomposition ---------------------------------------------------------------------

_MA = f"""{_WAVE},
tr AS (SELECT k, t, i, x, CASE WHEN count(x) OVER w = 27 THEN (sum(x) OVER w - (lag(x, 13) OVER o + lead(x, 13) OVER o) / 2) / 26 END AS trend
  FROM wv WINDOW w AS (PARTITION BY k ORDER BY i ROWS BETWEEN 13 PRECEDING AND 13 FOLLOWING), o AS (PARTITION BY k ORDER BY i)),
ph AS (SELECT k, i % 26 AS p, avg(x - trend) AS m FROM tr GROUP BY 1, 2),
se AS (SELECT k, p, m - avg(m) OVER (PARTITION BY k) AS season FROM ph)"""


@query(
    "seasonal_decompose",
    f"WITH {_MA} SELECT tr.k, t, round(trend, 5) AS trend, round(season, 3) AS season, round(x - trend - season, 3) AS resid "
    "FROM tr JOIN se ON se.k = tr.k AND p = i % 26",
)
def _(spark, sf):
    parts = D.seasonal_decompose(wave(spark, sf), ["k"], "i", "x", 26)
    kept = parts.select("k", "t", "trend", "season", "resid")
    return rounded(rounded(kept, 5, "trend"), 3, "season", "resid")


@query(
    "additive_adjust",
    f"WITH {_MA} SELECT tr.k, t, round(x - season, 3) AS adjusted FROM tr JOIN se ON se.k = tr.k AND p = i % 26",
)
def _(spark, sf):
    parts = D.seasonal_decompose(wave(spark, sf), ["k"], "i", "x", 26)
    return rounded(D.additive_adjust(parts, "x").select("k", "t", "adjusted"), 3, "adjusted")


@query("stl")
def _(spark, sf):
    parts = D.stl(weekly(spark, sf), ["k"], "i", "y", 52)
    return rounded(parts, 4, "y", "season", "trend", "resid")


@query("stl_robust")
def _(spark, sf):
    parts = D.stl(weekly(spark, sf), ["k"], "i", "y", 104, robust=True)
    return rounded(parts, 4, "y", "season", "trend", "resid")


@query(
    "stl_known_parts",
    # a straight line plus a pattern that sums to zero: both come back exactly
    f"WITH {WEEKLY}, a AS (SELECT k, round(avg(n), 2) AS level FROM s GROUP BY k) "
    "SELECT s.k, i, CAST(i * 37 % 52 - 25.5 AS DOUBLE) AS season, round(CAST(level + 0.25 * i AS DOUBLE), 3) AS trend, 0.0::DOUBLE AS resid FROM s JOIN a ON a.k = s.k",
)
def _(spark, sf):
    frame = weekly(spark, sf)
    level = frame.groupBy("k").agg(F.round(F.avg("n"), 2).alias("level"))
    made = frame.join(level, "k").withColumn("x", F.col("level") + 0.25 * F.col("i") + F.col("i") * 37 % 52 - 25.5)
    parts = D.stl(made, ["k"], "i", "x", 52)
    return rounded(parts.select("k", "i", "season", "trend", "resid"), 3, "season", "trend", "resid")


@query(
    "stl_restores_series",
    f"WITH {WEEKLY} SELECT k, i, round(y, 2) AS total FROM s",
)
def _(spark, sf):
    parts = D.stl(weekly(spark, sf), ["k"], "i", "y", 52)
    total = F.col("season") + F.col("trend") + F.col("resid")
    return rounded(parts.select("k", "i", total.alias("total")), 2, "total")


@query("deseasonalize")
def _(spark, sf):
    frame = wave(spark, sf)
    periods = S.spectral_peaks(S.power_spectrum(frame, ["k"], "i", "x"), ["k"])
    adjusted = D.deseasonalize(frame, ["k"], "i", "x", periods)
    return rounded(adjusted.select("k", "i", "adjusted"), 4, "adjusted")


# ---- trend -----------------------------------------------------------------------------


def _mk(source: str, value: str) -> str:
    return f"""pr AS (SELECT a.k, CAST(sum(sign(b.{value} - a.{value})) AS BIGINT) AS s, median((b.{value} - a.{value}) / (b.i - a.i)) AS slope
  FROM {source} a JOIN {source} b ON a.k = b.k AND b.i > a.i GROUP BY a.k),
ti AS (SELECT k, sum(c * (c - 1) * (2 * c + 5)) AS tie FROM (SELECT k, count(*)::DOUBLE AS c FROM {source} GROUP BY k, {value}) GROUP BY k),
si AS (SELECT k, count(*)::DOUBLE AS n, median({value}) AS mid, median(i) AS middle FROM {source} GROUP BY k),
va AS (SELECT k, n, s, slope, mid - slope * middle AS intercept, (n * (n - 1) * (2 * n + 5) - tie) / 18 AS var_s FROM pr JOIN ti USING (k) JOIN si USING (k)),
mk AS (SELECT *, CASE WHEN var_s = 0 THEN 0 ELSE (s - sign(s)) / sqrt(var_s) END AS z FROM va),
tr AS (SELECT *, CASE WHEN abs(z) <= 1.959963984540054 THEN 'no trend' WHEN z > 0 THEN 'increasing' ELSE 'decreasing' END AS trend FROM mk)"""


_RISING = f"{DAILY}, r AS (SELECT k, t, i, c + floor(i / 400) AS c FROM d)"


def rising(spark, sf):
    return daily(spark, sf).withColumn("c", F.col("c") + F.floor(F.col("i") / 400))


@query(
    "mann_kendall",
    f"WITH {WEEKLY}, {_mk('s', 'y')} SELECT k, CAST(n AS BIGINT) AS n, s, round(var_s, 4) AS var_s, round(z, 8) AS z, trend, "
    "round(slope, 4) AS slope, round(intercept, 2) AS intercept FROM tr",
)
def _(spark, sf):
    found = T.mann_kendall(weekly(spark, sf), ["k"], "i", "y").drop("p_value")
    found = rounded(rounded(found, 4, "var_s", "slope"), 8, "z")
    return rounded(found, 2, "intercept")


@query(
    "mann_kendall_ties",
    f"WITH {_RISING}, {_mk('r', 'c')} SELECT k, CAST(n AS BIGINT) AS n, s, round(var_s, 4) AS var_s, round(z, 8) AS z, trend, "
    "round(slope, 8) AS slope, round(intercept, 6) AS intercept FROM tr",
)
def _(spark, sf):
    found = T.mann_kendall(rising(spark, sf), ["k"], "i", "c").drop("p_value")
    found = rounded(rounded(found, 4, "var_s"), 8, "z", "slope")
    return rounded(found, 6, "intercept")


@query(
    "detrend_mk",
    f"WITH {_RISING}, {_mk('r', 'c')} SELECT r.k, t, round(CASE WHEN trend = 'no trend' THEN c ELSE c - (intercept + slope * i) END, 6) "
    "AS detrended FROM r JOIN tr ON tr.k = r.k",
)
def _(spark, sf):
    changed, _report = T.detrend_mk(rising(spark, sf), ["k"], "i", "c")
    return rounded(changed.select("k", "t", "detrended"), 6, "detrended")


@query(
    "detrend_mk_report",
    f"WITH {_RISING}, {_mk('r', 'c')}, q AS (SELECT r.k, i, CASE WHEN trend = 'no trend' THEN c ELSE c - (intercept + slope * i) END AS c "
    "FROM r JOIN tr ON tr.k = r.k), "
    "pa AS (SELECT a.k, sum(sign(round(b.c - a.c, 9))) AS s FROM q a JOIN q b ON a.k = b.k AND b.i > a.i GROUP BY a.k), "
    "tb AS (SELECT k, sum(n * (n - 1) * (2 * n + 5)) AS tie, sum(n) AS n FROM (SELECT k, count(*)::DOUBLE AS n FROM q GROUP BY k, c) GROUP BY k), "
    "zz AS (SELECT k, (s - sign(s)) / sqrt((n * (n - 1) * (2 * n + 5) - tie) / 18) AS z FROM pa JOIN tb USING (k)) "
    "SELECT tr.k, trend AS pre_trend, CASE WHEN trend <> 'no trend' THEN round(slope, 6) END AS slope, "
    "CASE WHEN trend <> 'no trend' THEN round(intercept, 6) END AS intercept, CASE WHEN trend <> 'no trend' THEN "
    "CASE WHEN abs(zz.z) <= 1.959963984540054 THEN 'no trend' WHEN zz.z > 0 THEN 'increasing' ELSE 'decreasing' END END AS post_trend "
    "FROM tr JOIN zz ON zz.k = tr.k",
)
def _(spark, sf):
    _changed, report = T.detrend_mk(rising(spark, sf), ["k"], "i", "c")
    return rounded(report, 6, "slope", "intercept")


_KNOWN = f"{WEEKLY}, g AS (SELECT k, i, v FROM s WHERE v IS NOT NULL AND i % 11 < 7)"


def gappy(spark, sf):
    """The weekly series without a third of their weeks, in runs."""
    return weekly(spark, sf).withColumn("v", F.when(F.col("i") % 11 < 7, F.col("v")))


@query(
    "mann_kendall_gaps",
    f"WITH {_KNOWN}, {_mk('g', 'v')} SELECT k, CAST(n AS BIGINT) AS n, s, round(z, 8) AS z, trend, "
    "round(slope, 4) AS slope, round(intercept, 2) AS intercept FROM tr",
)
def _(spark, sf):
    found = T.mann_kendall(gappy(spark, sf), ["k"], "i", "v").drop("p_value", "var_s")
    return rounded(rounded(rounded(found, 4, "slope"), 8, "z"), 2, "intercept")


@query(
    "detrend_mk_gaps",
    f"WITH {WEEKLY}, g AS (SELECT k, i, v FROM (SELECT k, i, v + 1000.0 * i AS v FROM s) WHERE v IS NOT NULL AND i % 11 < 7), {_mk('g', 'v')} "
    "SELECT g.k, g.i, round(CASE WHEN trend = 'no trend' THEN v ELSE v - (intercept + slope * i) END, 1) AS detrended FROM g JOIN tr ON tr.k = g.k",
)
def _(spark, sf):
    rising_ = gappy(spark, sf).withColumn("v", F.col("v") + F.lit(1000.0) * F.col("i"))
    changed, _report = T.detrend_mk(rising_, ["k"], "i", "v")
    return rounded(changed.where("v is not null").select("k", "i", "detrended"), 1, "detrended")


_OLS = """ls AS (SELECT k, count(v) AS n, regr_slope(v, i + 1) AS slope, regr_intercept(v, i + 1) AS intercept,
  regr_slope(v, i + 1) / sqrt((regr_syy(v, i + 1) - regr_slope(v, i + 1) * regr_sxy(v, i + 1)) / (count(v) - 2) / regr_sxx(v, i + 1)) AS t_value
  FROM {source} GROUP BY k)"""


@query(
    "ols_trend",
    f"WITH {WEEKLY}, {_OLS.format(source='s')} SELECT k, CAST(n AS BIGINT) AS n, round(slope, 4) AS slope, round(intercept, 2) AS intercept, "
    "round(t_value, 6) AS t_value FROM ls",
)
def _(spark, sf):
    fit = T.ols_trend(weekly(spark, sf), ["k"], "i", "v")
    return rounded(rounded(rounded(fit, 4, "slope"), 2, "intercept"), 6, "t_value")


@query(
    "detrend_ols",
    f"WITH {_RISING}, w AS (SELECT k, t, i, c AS v FROM r), {_OLS.format(source='w')} SELECT w.k, t, "
    "round(CASE WHEN abs(t_value) > 1.959963984540054 THEN v - (intercept + slope * (i + 1)) ELSE v END, 6) AS detrended, "
    "abs(t_value) > 1.959963984540054 AS d_trend FROM w JOIN ls ON ls.k = w.k",
)
def _(spark, sf):
    changed = T.detrend_ols(rising(spark, sf), ["k"], "i", "c")
    return rounded(changed.select("k", "t", "detrended", "d_trend"), 6, "detrended")


# ---- tests -----------------------------------------------------------------------------


# two-sample test of the rows of v (k, x, a: from the first sample)
_KS = (
    "c AS (SELECT k, x, sum(a::INT) AS na, sum((NOT a)::INT) AS nb FROM v GROUP BY k, x), "
    "r AS (SELECT k, sum(na) OVER w AS ca, sum(nb) OVER w AS cb, sum(na) OVER (PARTITION BY k) AS ta, sum(nb) OVER (PARTITION BY k) AS tb "
    "FROM c WINDOW w AS (PARTITION BY k ORDER BY x))"
    ", d AS (SELECT k, CAST(ta AS BIGINT) AS n1, CAST(tb AS BIGINT) AS n2, max(abs(CAST(ca AS DOUBLE) / ta - CAST(cb AS DOUBLE) / tb)) AS d "
    "FROM r GROUP BY k, ta, tb), e AS (SELECT *, d * sqrt(n1 * n2 / (n1 + n2)::DOUBLE) AS u FROM d) "
    "SELECT k, n1, n2, round(d, 10) AS statistic, round(CASE WHEN u < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, "
    "list_sum(list_transform(generate_series(1, 100), lambda j: (CASE WHEN j % 2 = 1 THEN 2 ELSE -2 END) * exp(-2.0 * j * j * u * u))))) END, 8) AS p_value FROM e"
)


@query(
    "ks_two_sample",
    "WITH v AS (SELECT l_linestatus AS k, l_extendedprice AS x, l_returnflag = 'A' AS a FROM lineitem WHERE l_returnflag IN ('A', 'N')), " + _KS,
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_linestatus", "k")
    found = H.ks_two_sample(lines, ["k"], "l_returnflag", "l_extendedprice", "A", "N")
    return rounded(rounded(found, 10, "statistic"), 8, "p_value")


@query(
    "ks_two_halves",
    f"WITH {WEEKLY}, v AS (SELECT k, y AS x, i < count(*) OVER (PARTITION BY k) // 2 AS a FROM s), " + _KS.replace("round(d, 10)", "round(d, 8)"),
)
def _(spark, sf):
    halves = split_half(weekly(spark, sf), ["k"], "i")
    found = H.ks_two_sample(halves, ["k"], "part", "y", "first", "second")
    return rounded(found, 8, "statistic", "p_value")


@query("ks_exact_halves")
def _(spark, sf):
    halves = split_half(weekly(spark, sf), ["k"], "i")
    found = H.ks_two_sample(halves, ["k"], "part", "y", "first", "second", exact=True)
    return rounded(found, 8, "statistic", "p_value")


@query(
    "anova_oneway",
    "WITH g AS (SELECT l_linestatus AS k, l_returnflag AS g, count(*)::DOUBLE AS n, avg(l_extendedprice) AS m, var_pop(l_extendedprice) AS v "
    "FROM lineitem GROUP BY 1, 2), a AS (SELECT k, count(*) AS groups, sum(n) AS n, sum(n * v) AS within, sum(n * m * m) - power(sum(n * m), 2) / sum(n) AS between "
    "FROM g GROUP BY k) SELECT k, CAST(groups AS BIGINT) AS groups, CAST(n AS BIGINT) AS n, round((between / (groups - 1)) / (within / (n - groups)), 4) AS f FROM a",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_linestatus", "k")
    return rounded(H.anova_oneway(lines, ["k"], "l_returnflag", "l_extendedprice").drop("p_value"), 4, "f")


@query(
    "anova_p_value",  # with three groups the tail has a closed form
    "WITH g AS (SELECT l_shipdate IS NOT NULL AS k, l_returnflag AS g, count(*)::DOUBLE AS n, avg(l_quantity) AS m, var_pop(l_quantity) AS v "
    "FROM lineitem GROUP BY 1, 2), a AS (SELECT k, count(*) AS groups, sum(n) AS n, sum(n * v) AS within, sum(n * m * m) - power(sum(n * m), 2) / sum(n) AS between "
    "FROM g GROUP BY k), f AS (SELECT k, CAST(groups AS BIGINT) AS groups, CAST(n AS BIGINT) AS n, (between / (groups - 1)) / (within / (n - groups)) AS f FROM a) "
    "SELECT k, groups, n, round(f, 4) AS f, round(power(1 + 2 * f / (n - 3), -(n - 3) / 2.0), 4) AS p_value FROM f WHERE groups = 3",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("k", F.col("l_shipdate").isNotNull())
    return rounded(H.anova_oneway(lines, ["k"], "l_returnflag", "l_quantity"), 4, "f", "p_value")


@query(
    "ljung_box",
    f"WITH {WEEKLY}, {_acf('s', 'y', 4)} SELECT k, CAST(n AS BIGINT) AS n, round(n * (n + 2) * sum(r * r / (n - h)), 8) AS q FROM bd WHERE h > 0 GROUP BY k, n",
)
def _(spark, sf):
    return rounded(H.ljung_box(weekly(spark, sf), ["k"], "i", "y", 4).drop("p_value"), 8, "q")


@query(
    "ljung_box_p_value",
    f"WITH {WEEKLY}, {_acf('s', 'y', 2)}, q AS (SELECT k, CAST(n AS BIGINT) AS n, n * (n + 2) * sum(r * r / (n - h)) AS q FROM bd WHERE h > 0 GROUP BY k, n) "
    "SELECT k, n, round(q, 8) AS q, round(exp(-q / 2), 8) AS p_value FROM q",
)
def _(spark, sf):
    return rounded(H.ljung_box(weekly(spark, sf), ["k"], "i", "y", 2), 8, "q", "p_value")


@query(
    "standardized_residuals",
    f"WITH {WEEKLY}, c AS (SELECT k, t, y - avg(y) OVER (PARTITION BY k) AS e FROM s) "
    "SELECT k, t, round(e / stddev_pop(e) OVER (PARTITION BY k), 6) AS std_resid FROM c",
)
def _(spark, sf):
    frame = weekly(spark, sf)
    means = frame.groupBy("k").agg(F.avg("y").alias("_m"))
    resid = frame.join(means, "k").withColumn("e", F.col("y") - F.col("_m"))
    scaled = H.standardized_residuals(resid, ["k"], "e")
    return rounded(scaled.select("k", "t", "std_resid"), 6, "std_resid")


@query("quantile_pairs")
def _(spark, sf):
    return rounded(H.quantile_pairs(weekly(spark, sf), ["k"], "y"), 8, "theory")
