"""Series built from the driver tables, once in Spark and once as SQL text.

Sums and means are rounded so that both engines start from equal doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomcast.operators.reshape import series_index


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def monday(col: str) -> Column:
    day = F.to_date(F.col(col))
    return F.date_sub(day, F.weekday(day))


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Round for comparison; adding zero turns -0.0 into 0.0."""
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in cols})


# -- weekly order value per priority: y complete, v with every 7th value missing --------

WEEKLY = """wk AS (SELECT o_orderpriority AS k, CAST(date_trunc('week', o_orderdate) AS DATE) AS t,
  round(sum(o_totalprice), 2) AS y, CAST(count(*) AS DOUBLE) AS n FROM orders GROUP BY 1, 2),
s0 AS (SELECT k, t, CAST(row_number() OVER (PARTITION BY k ORDER BY t) - 1 AS BIGINT) AS i, y, n FROM wk),
s AS (SELECT k, t, i, y, n, CASE WHEN i % 7 = 3 THEN NULL ELSE y END AS v FROM s0)"""


def orders_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("k"), monday("o_orderdate").alias("t"))
        .agg(
            F.round(F.sum("o_totalprice"), 2).alias("y"),
            F.count(F.lit(1)).cast("double").alias("n"),
        )
    )


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, t, y, n, i, v"""
    indexed = series_index(orders_by_week(spark, sf_dir), ["k"], "t")
    return indexed.withColumn("v", F.when(F.col("i") % 7 != 3, F.col("y")))


# -- weekly line item means per return flag: a panel of four features and a target -------

PANEL = """pw AS (SELECT l_returnflag AS k, CAST(date_trunc('week', l_shipdate) AS DATE) AS t,
  round(avg(l_quantity), 10) AS qty, round(avg(l_extendedprice), 8) AS price,
  round(avg(l_discount), 10) AS disc, round(avg(l_tax), 10) AS tax,
  CAST(count(*) AS DOUBLE) AS cases FROM lineitem GROUP BY 1, 2),
p AS (SELECT k, t, CAST(row_number() OVER (PARTITION BY k ORDER BY t) - 1 AS BIGINT) AS i,
  qty, price, disc, tax, cases FROM pw)"""

FEATURES = ["qty", "price", "disc", "tax"]


def lines_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_returnflag").alias("k"), monday("l_shipdate").alias("t"))
        .agg(
            F.round(F.avg("l_quantity"), 10).alias("qty"),
            F.round(F.avg("l_extendedprice"), 8).alias("price"),
            F.round(F.avg("l_discount"), 10).alias("disc"),
            F.round(F.avg("l_tax"), 10).alias("tax"),
            F.count(F.lit(1)).cast("double").alias("cases"),
        )
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, t, qty, price, disc, tax, cases, i"""
    return series_index(lines_by_week(spark, sf_dir), ["k"], "t")


# -- the panel with gaps: qty 1 in 151 missing, price 1 in 11, cases missing at the end --

GAPPY = (
    PANEL
    + """,
g AS (SELECT k, t, i, CASE WHEN i % 151 = 40 THEN NULL ELSE qty END AS qty,
  CASE WHEN i % 11 = 5 THEN NULL ELSE price END AS price, disc, tax,
  CASE WHEN t >= DATE '2000-06-05' THEN NULL ELSE cases END AS cases FROM p)"""
)


def gappy_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel(spark, sf_dir).select(
        "k",
        "t",
        "i",
        F.when(F.col("i") % 151 != 40, F.col("qty")).alias("qty"),
        F.when(F.col("i") % 11 != 5, F.col("price")).alias("price"),
        "disc",
        "tax",
        F.when(F.col("t") < F.lit("2000-06-05").cast("date"), F.col("cases")).alias("cases"),
    )


# -- hourly event means on a complete spine: hours without events are really missing -----

HOURLY = """eh AS (SELECT event_type AS k,
  CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 24 + extract('hour' FROM ts) AS BIGINT) AS h,
  round(avg(value), 10) AS v, CAST(count(*) AS DOUBLE) AS n FROM events GROUP BY 1, 2),
sp AS (SELECT k, unnest(generate_series(lo, hi)) AS h FROM
  (SELECT k, min(h) AS lo, max(h) AS hi FROM eh GROUP BY k)),
e AS (SELECT sp.k, CAST(sp.h AS BIGINT) AS h, eh.v, coalesce(eh.n, 0.0) AS n,
  CAST(row_number() OVER (PARTITION BY sp.k ORDER BY sp.h) - 1 AS BIGINT) AS i
  FROM sp LEFT JOIN eh ON sp.k = eh.k AND sp.h = eh.h)"""


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, h, v (missing where no event), n, i"""
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    seen = (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("event_type").alias("k"), (day * 24 + F.hour("ts")).cast("long").alias("h")
        )
        .agg(F.round(F.avg("value"), 10).alias("v"), F.count(F.lit(1)).cast("double").alias("n"))
    )
    # each hour seen also stands for the empty hours up to the next one: one pass, no spine join
    upcoming = F.lead("h").over(Window.partitionBy("k").orderBy("h"))
    slots = seen.withColumn("next", upcoming).withColumn(
        "slot", F.explode(F.sequence("h", F.coalesce(F.col("next") - 1, "h")))
    )
    here = F.col("slot") == F.col("h")
    full = slots.select(
        "k",
        F.col("slot").alias("h"),
        F.when(here, F.col("v")).alias("v"),
        F.when(here, F.col("n")).otherwise(F.lit(0.0)).alias("n"),
    )
    return series_index(full, ["k"], "h", span=(0, 1_000_000))


# -- orders per day and status: integers with many ties -----------------------------------

DAILY = """dw AS (SELECT o_orderstatus AS k, CAST(o_orderdate AS DATE) AS t,
  CAST(count(*) AS DOUBLE) AS c FROM orders GROUP BY 1, 2),
d AS (SELECT k, t, c, CAST(row_number() OVER (PARTITION BY k ORDER BY t) - 1 AS BIGINT) AS i FROM dw)"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, t, c, i"""
    counts = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("k"), F.to_date("o_orderdate").alias("t"))
        .agg(F.count(F.lit(1)).cast("double").alias("c"))
    )
    return series_index(counts, ["k"], "t")
