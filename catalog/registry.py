"""Collects (name, Spark callable, SQL text)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomcast.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(run):
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return run(spark, sf_dir)

        if name in QUERIES:
            raise KeyError(name)
        QUERIES[name] = call
        if sql is not None:
            ORACLES[name] = sql
        return call

    return keep
