"""Panels in and out: features, labels, prepared tables and forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The feature columns of the weekly panel.
FEATURES = [
    "ndvi_ne",
    "ndvi_nw",
    "ndvi_se",
    "ndvi_sw",
    "precipitation_amt_mm",
    "reanalysis_air_temp_k",
    "reanalysis_avg_temp_k",
    "reanalysis_dew_point_temp_k",
    "reanalysis_max_air_temp_k",
    "reanalysis_min_air_temp_k",
    "reanalysis_precip_amt_kg_per_m2",
    "reanalysis_relative_humidity_percent",
    "reanalysis_sat_precip_amt_mm",
    "reanalysis_specific_humidity_g_per_kg",
    "reanalysis_tdtr_k",
    "station_avg_temp_c",
    "station_diur_temp_rng_c",
    "station_max_temp_c",
    "station_min_temp_c",
    "station_precip_mm",
]
TARGET = "total_cases"
ROW_KEY = ["city", "year", "weekofyear"]


def feature_schema(features: Sequence[str] = FEATURES) -> T.StructType:
    return T.StructType(
        [
            T.StructField("city", T.StringType()),
            T.StructField("year", T.IntegerType()),
            T.StructField("weekofyear", T.IntegerType()),
            T.StructField("week_start_date", T.DateType()),
            *[T.StructField(c, T.DoubleType()) for c in features],
        ]
    )


LABEL_SCHEMA = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("weekofyear", T.IntegerType()),
        T.StructField(TARGET, T.DoubleType()),
    ]
)


def nan_to_null(df: DataFrame) -> DataFrame:
    """From the loader on, only NULL means missing."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema, or parquet by its suffix."""
    if path.rstrip("/").endswith(".parquet"):
        return nan_to_null(spark.read.schema(schema).parquet(path))
    return nan_to_null(
        spark.read.schema(schema).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    )


def attach_labels(
    features: DataFrame,
    labels: DataFrame,
    on: Sequence[str] = ROW_KEY,
    target: str = TARGET,
    check: bool = True,
) -> DataFrame:
    """Left equi join on the row key.

    With ``check`` one small job verifies that the key is unique on the label side
    and that every label finds its row.
    """
    on = list(on)
    if check:
        twice = labels.groupBy(*on).count().where("count > 1").limit(1).count()
        if twice:
            raise ValueError(f"label key {on} is not unique")
        lost = labels.join(features.select(*on), on, "left_anti").limit(1).count()
        if lost:
            raise ValueError(f"labels without a feature row on {on}")
    return features.join(labels.select(*on, target), on, "left")


def stack_train_test(train: DataFrame, test: DataFrame, flag: str = "type") -> DataFrame:
    """Tag and stack; columns one side lacks become missing."""
    return train.withColumn(flag, F.lit("train")).unionByName(
        test.withColumn(flag, F.lit("test")), allowMissingColumns=True
    )


def read_panel(
    spark: SparkSession,
    features: str,
    labels: str,
    test: str,
    columns: Sequence[str] = FEATURES,
    check: bool = True,
) -> DataFrame:
    """Train features with labels on top of test features without, in the fixed schema."""
    schema = feature_schema(columns)
    train = attach_labels(
        read_table(spark, features, schema), read_table(spark, labels, LABEL_SCHEMA), check=check
    )
    return stack_train_test(train, read_table(spark, test, schema))


def overlapping_series(df: DataFrame, key: str = "city", order: str = "week_start_date") -> DataFrame:
    """Keys whose test rows do not all come after their train rows."""
    ends = df.groupBy(key).agg(
        F.max(F.when(F.col("type") == "train", F.col(order))).alias("last_train"),
        F.min(F.when(F.col("type") == "test", F.col(order))).alias("first_test"),
    )
    return ends.where(F.col("last_train") >= F.col("first_test"))


def write_prepared(df: DataFrame, path: str, by: str = "city") -> None:
    """Parquet by series key, so later reads prune to the series they name.

    The rebalance hint gathers a key's rows into few files, while adaptive execution
    splits a key that is too large for one task.
    """
    df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(path)


def write_prepared_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_prepared(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_forecast(
    df: DataFrame, path: str, columns: Sequence[str] = (*ROW_KEY, TARGET)
) -> None:
    """CSV with a header: key columns and the whole-number forecast."""
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def read_forecast(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("city string, year int, weekofyear int, total_cases int").option(
        "header", True
    ).csv(path)
