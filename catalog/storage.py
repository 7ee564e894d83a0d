"""Queries for sources and sinks: tables are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.frames import FEATURES, PANEL, lines_by_week, panel, rounded
from catalog.registry import query
from loomcast.operators import models as M
from loomcast.session import scratch_path
from loomcast.sources import panel as S

# the weekly line item panel in the shape of the expected inputs
_CITY = f"""{PANEL}, c AS (SELECT k AS city, CAST(isoyear(t) AS INTEGER) AS year, CAST(weekofyear(t) AS INTEGER) AS weekofyear,
  t AS week_start_date, qty, price, disc, tax, cases AS total_cases FROM p)"""
_SPLIT = "DATE '2000-06-05'"


def _city(spark, sf):
    return lines_by_week(spark, sf).select(
        F.col("k").alias("city"),
        F.expr("extract(YEAROFWEEK FROM t)").cast("int").alias("year"),
        F.weekofyear("t").alias("weekofyear"),
        F.col("t").alias("week_start_date"),
        *FEATURES,
        F.col("cases").alias("total_cases"),
    )


def _parts(spark, sf):
    city = _city(spark, sf)
    early = F.col("week_start_date") < F.lit("2000-06-05").cast("date")
    features = city.drop("total_cases")
    labels = city.where(early).select(*S.ROW_KEY, "total_cases")
    return features.where(early), labels, features.where(~early)


@query(
    "attach_labels",
    f"WITH {_CITY} SELECT city, year, weekofyear, qty, total_cases FROM c WHERE week_start_date < {_SPLIT}",
)
def _(spark, sf):
    train, labels, _ = _parts(spark, sf)
    joined = S.attach_labels(train, labels)
    return joined.select("city", "year", "weekofyear", "qty", "total_cases")


@query(
    "stack_train_test",
    f"WITH {_CITY} SELECT city, year, weekofyear, week_start_date, qty, price, disc, tax, "
    f"CASE WHEN week_start_date < {_SPLIT} THEN total_cases END AS total_cases, "
    f"CASE WHEN week_start_date < {_SPLIT} THEN 'train' ELSE 'test' END AS type FROM c",
)
def _(spark, sf):
    train, labels, test = _parts(spark, sf)
    return S.stack_train_test(S.attach_labels(train, labels, check=False), test)


@query(
    "read_panel",
    f"WITH {_CITY} SELECT city, year, weekofyear, week_start_date, qty, price, disc, tax, "
    f"CASE WHEN week_start_date < {_SPLIT} THEN total_cases END AS total_cases, "
    f"CASE WHEN week_start_date < {_SPLIT} THEN 'train' ELSE 'test' END AS type FROM c",
)
def _(spark, sf):
    train, labels, test = _parts(spark, sf)
    paths = [scratch_path(spark, name) for name in ("features", "labels", "test")]
    for frame, path in zip((train, labels, test), paths):
        S.write_prepared_csv(frame, path)
    return S.read_panel(spark, *paths, columns=FEATURES)


@query(
    "overlapping_series",
    "SELECT k AS city, max(d) FILTER (early) AS last_train, min(d) FILTER (NOT early) AS first_test FROM "
    "(SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS d, o_orderstatus = 'F' AS early FROM orders) GROUP BY k "
    "HAVING max(d) FILTER (early) >= min(d) FILTER (NOT early)",
)
def _(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderpriority").alias("city"),
        F.to_date("o_orderdate").alias("week_start_date"),
        F.when(F.col("o_orderstatus") == "F", "train").otherwise("test").alias("type"),
    )
    return S.overlapping_series(orders)


@query(
    "prepared_round_trip",
    f"WITH {_CITY} SELECT city, year, weekofyear, week_start_date, qty, total_cases FROM c WHERE city = 'A'",
)
def _(spark, sf):
    path = scratch_path(spark, "prepared")
    S.write_prepared(_city(spark, sf), path)
    kept = S.read_prepared(spark, path).where("city = 'A'")
    return kept.select("city", "year", "weekofyear", "week_start_date", "qty", "total_cases")


@query(
    "forecast_round_trip",
    f"WITH {_CITY} SELECT city, year, weekofyear, CAST(total_cases AS INTEGER) AS total_cases FROM c",
)
def _(spark, sf):
    path = scratch_path(spark, "forecast")
    rows = _city(spark, sf).withColumn("total_cases", F.col("total_cases").cast("int"))
    S.write_forecast(rows, path)
    return S.read_forecast(spark, path)


@query("model_round_trip")
def _(spark, sf):
    frame = panel(spark, sf)
    path = scratch_path(spark, "model")
    M.save_trees(M.train_trees(frame, ["k"], "i", FEATURES, "cases"), path)
    model = M.load_trees(spark, path, ["k"], FEATURES)
    return rounded(M.predict_trees(frame, model).select("k", "t", "prediction"), 6, "prediction")
