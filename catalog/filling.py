"""Queries for scoring, choosing and applying imputation methods."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.frames import FEATURES, GAPPY, HOURLY, WEEKLY, gappy_panel, hourly, rounded, weekly
from catalog.registry import query
from loomcast.operators import impute as I
from loomcast.operators.reshape import to_long
from loomcast.session import settle

# known hours re-indexed, the 50 lowest hashes blanked
_MASK = """kn AS (SELECT k, v, CAST(row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS BIGINT) AS j FROM e WHERE v IS NOT NULL),
rk AS (SELECT k, j, v, row_number() OVER (PARTITION BY k ORDER BY md5(concat_ws('/', k, j, 42)), j) <= 50 AS hidden FROM kn),
mk AS (SELECT k, j, v, hidden, CASE WHEN hidden THEN NULL ELSE v END AS masked FROM rk)"""

_TRIED = """nb AS (SELECT k, j, v, masked,
  last_value(masked IGNORE NULLS) OVER a AS pv, last_value(CASE WHEN masked IS NOT NULL THEN j END IGNORE NULLS) OVER a AS pi,
  first_value(masked IGNORE NULLS) OVER b AS nv, first_value(CASE WHEN masked IS NOT NULL THEN j END IGNORE NULLS) OVER b AS ni,
  coalesce(masked, avg(masked) OVER (PARTITION BY k ORDER BY j ROWS BETWEEN 4 PRECEDING AND 3 FOLLOWING)) AS knn
  FROM mk WINDOW a AS (PARTITION BY k ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  b AS (PARTITION BY k ORDER BY j ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
tr AS (SELECT k, j, v, pv AS ffill, nv AS bfill, knn, CASE WHEN masked IS NOT NULL THEN masked WHEN pi IS NULL THEN NULL
  WHEN ni IS NULL THEN pv ELSE pv + (nv - pv) * (j - pi) / (ni - pi) END AS linear FROM nb)"""

_SCORES = "sc AS (" + " UNION ALL ".join(
    f"SELECT k, '{m}' AS method, {o} AS ord, CASE WHEN count(*) FILTER ({m} IS NULL) = 0 THEN "
    f"sqrt(sum(power(v - {m}, 2)) / 50) / (max(v) - min(v)) END AS nrmse FROM tr GROUP BY k"
    for o, m in enumerate(("ffill", "bfill", "linear", "knn"))
) + ")"


@query("holdout_mask", f"WITH {HOURLY}, {_MASK} SELECT k, j, v, hidden, masked FROM mk")
def _(spark, sf):
    return I.holdout_mask(hourly(spark, sf), ["k"], "i", "v")


@query(
    "score_imputers",
    f"WITH {HOURLY}, {_MASK}, {_TRIED}, {_SCORES} SELECT k, method, round(nrmse, 8) AS nrmse FROM sc",
)
def _(spark, sf):
    scores = I.score_imputers(hourly(spark, sf), ["k"], "i", "v", cubic=False)
    return rounded(scores, 8, "nrmse")


@query("score_imputers_with_cubic")
def _(spark, sf):
    return rounded(I.score_imputers(hourly(spark, sf), ["k"], "i", "v"), 8, "nrmse")


@query(
    "choose_imputer",
    f"WITH {HOURLY}, {_MASK}, {_TRIED}, {_SCORES} SELECT k, method, round(nrmse, 8) AS nrmse FROM "
    "(SELECT *, row_number() OVER (PARTITION BY k ORDER BY nrmse NULLS LAST, ord) AS r FROM sc) WHERE r = 1",
)
def _(spark, sf):
    scores = I.score_imputers(hourly(spark, sf), ["k"], "i", "v", cubic=False)
    return rounded(I.choose_imputer(scores, ["k"]), 8, "nrmse")


@query(
    "choose_imputer_difficult",
    f"WITH {HOURLY}, {_MASK}, {_TRIED}, {_SCORES} SELECT k, method, round(nrmse, 8) AS nrmse FROM "
    "(SELECT *, row_number() OVER (PARTITION BY k ORDER BY nrmse NULLS LAST, ord) AS r FROM sc "
    "WHERE method <> 'knn') WHERE r = 1",
)
def _(spark, sf):
    scores = I.score_imputers(hourly(spark, sf), ["k"], "i", "v", cubic=False)
    return rounded(I.choose_imputer(scores, ["k"], exclude=["knn"]), 8, "nrmse")


@query(
    "impute_chosen",
    f"WITH {HOURLY}, {_MASK}, {_TRIED}, {_SCORES}, ch AS (SELECT k, method FROM "
    "(SELECT *, row_number() OVER (PARTITION BY k ORDER BY nrmse NULLS LAST, ord) AS r FROM sc) WHERE r = 1), "
    """fe AS (SELECT k, h, i, v,
  last_value(v IGNORE NULLS) OVER a AS pv, last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER a AS pi,
  first_value(v IGNORE NULLS) OVER b AS nv, first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER b AS ni,
  coalesce(v, avg(v) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 4 PRECEDING AND 3 FOLLOWING)) AS knn
  FROM e WINDOW a AS (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  b AS (PARTITION BY k ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
li AS (SELECT *, CASE WHEN v IS NOT NULL THEN v WHEN pi IS NULL THEN NULL WHEN ni IS NULL THEN pv
  ELSE pv + (nv - pv) * (i - pi) / (ni - pi) END AS linear FROM fe) """
    "SELECT k, h, method, round(coalesce(CASE method WHEN 'ffill' THEN pv WHEN 'bfill' THEN nv WHEN 'linear' THEN linear "
    "ELSE knn END, linear, pv, nv), 8) AS filled FROM li JOIN ch USING (k)",
)
def _(spark, sf):
    frame = settle(hourly(spark, sf))
    choice = I.choose_imputer(I.score_imputers(frame, ["k"], "i", "v", cubic=False), ["k"])
    filled = I.impute_chosen(frame, ["k"], "i", "v", choice)
    return rounded(filled.select("k", "h", "method", "filled"), 8, "filled")


@query("imputed_series")
def _(spark, sf):
    filled = I.impute_easy(weekly(spark, sf), ["k"], "i", "v")
    return rounded(filled.select("k", "t", "method", "filled"), 4, "filled")


@query("imputed_panel")
def _(spark, sf):
    long = to_long(gappy_panel(spark, sf), ["k", "i"], FEATURES)
    filled = I.impute_easy(long, ["k", "variable"], "i", "value")
    return rounded(filled.select("k", "variable", "i", "method", "filled"), 6, "filled")


@query("fill_cubic")
def _(spark, sf):
    filled = I.fill_cubic(weekly(spark, sf), ["k"], "i", "v")
    return rounded(filled.select("k", "t", "filled"), 4, "filled")


@query(
    "fill_cubic_polynomial",
    f"WITH {WEEKLY}, r AS (SELECT k, t, i, CAST(i AS DOUBLE) AS x, CASE WHEN i % 7 = 3 THEN NULL ELSE 1 END AS kn FROM s) "
    "SELECT k, t, CASE WHEN kn IS NULL AND i > max(i) FILTER (kn IS NOT NULL) OVER (PARTITION BY k) THEN NULL "
    "ELSE round(2 + x / 50 - power(x / 100, 2) + power(x / 100, 3), 6) END AS filled FROM r",
)
def _(spark, sf):
    x = F.col("i") / F.lit(100.0)
    curve = weekly(spark, sf).withColumn(
        "p", F.when(F.col("v").isNotNull(), 2 + x * 2 - x * x + x * x * x)
    )
    return rounded(I.fill_cubic(curve, ["k"], "i", "p").select("k", "t", "filled"), 6, "filled")


@query(
    "usable_features",
    f"WITH {GAPPY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST(count(*) FILTER (price IS NULL AND {c} IS NULL) AS BIGINT) AS gaps_where_missing, "
        f"CAST(count(*) FILTER (price IS NOT NULL AND {c} IS NULL) AS BIGINT) AS gaps_where_known, "
        f"count(*) FILTER (price IS NULL AND {c} IS NULL) = 0 AS usable FROM g"
        for c in ("qty", "disc", "tax", "cases")
    ),
)
def _(spark, sf):
    return I.usable_features(gappy_panel(spark, sf), "price", [*FEATURES, "cases"])
