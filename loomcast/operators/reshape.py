"""Index, filter, reshape and split operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.functions.blocks import position, with_totals


def series_index(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    out: str = "i",
    span: tuple[int, int] | None = None,
) -> DataFrame:
    """0-based position per key, in ``order``.  ``span`` declares the range of a number order."""
    return position(df, keys, order, out, span)


def only_series(df: DataFrame, key: str, *names) -> DataFrame:
    """Rows of the named series; reaches the scan as a pushed filter or partition prune."""
    return df.where(F.col(key).isin(*names))


def series_names(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def complete_cases(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows without a missing value in ``cols`` (default: all columns)."""
    return df.na.drop(subset=list(cols) if cols else None)


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    cols: Sequence[str],
    variable: str = "variable",
    value: str = "value",
) -> DataFrame:
    """One row per (id, column)."""
    return df.select(*ids, *[F.col(c).cast("double") for c in cols]).unpivot(
        list(ids), list(cols), variable, value
    )


def to_matrix(
    df: DataFrame, ids: Sequence[str], variable: str, value: str, names: Sequence[str]
) -> DataFrame:
    """Back to one column per name; naming the columns saves a scan for the distinct ones."""
    return df.groupBy(*ids).pivot(variable, list(names)).agg(F.first(value))


def project(
    df: DataFrame,
    columns: Sequence[str],
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """Select, order and rename columns."""
    rename = rename or {}
    return df.select(*[F.col(c).alias(rename.get(c, c)) for c in columns])


def columns_except(columns: Sequence[str], drop: Sequence[str]) -> list[str]:
    """``columns`` without ``drop``, in their given order."""
    gone = set(drop)
    return [c for c in columns if c not in gone]


def columns_with_prefix(columns: Sequence[str], prefix: str) -> list[str]:
    return [c for c in columns if c.startswith(prefix)]


def row_totals(df: DataFrame, keys: Sequence[str], pos: str | None = None, out: str = "n") -> DataFrame:
    """Attach the row count of each key."""
    return with_totals(df, keys, pos, {out: F.count(F.lit(1))})


def split_fraction(
    df: DataFrame, keys: Sequence[str], pos: str, frac: float = 0.8, out: str = "part"
) -> DataFrame:
    """Tag the first ``floor(frac * n)`` rows of each key ``train``, the others ``test``."""
    limit = F.floor(F.col("_rows") * F.lit(float(frac)))
    part = F.when(F.col(pos) < limit, F.lit("train")).otherwise(F.lit("test"))
    return row_totals(df, keys, pos, "_rows").withColumn(out, part).drop("_rows")


def split_at(df: DataFrame, pos: str, cutoff: int, out: str = "part") -> DataFrame:
    """Tag rows before position ``cutoff`` ``first``, the others ``second``."""
    return df.withColumn(
        out, F.when(F.col(pos) < cutoff, F.lit("first")).otherwise(F.lit("second"))
    )


def split_half(df: DataFrame, keys: Sequence[str], pos: str, out: str = "part") -> DataFrame:
    """``split_at`` with each key's half-way point."""
    half = F.floor(F.col("_rows") / F.lit(2))
    part = F.when(F.col(pos) < half, F.lit("first")).otherwise(F.lit("second"))
    return row_totals(df, keys, pos, "_rows").withColumn(out, part).drop("_rows")


def fill_missing_only(df: DataFrame, value: str, prediction: str, out: str | None = None) -> DataFrame:
    """Take the prediction only where the value is missing."""
    return df.withColumn(out or value, F.coalesce(F.col(value), F.col(prediction)))


def forecast_horizon(df: DataFrame, keys: Sequence[str], target: str = "total_cases") -> DataFrame:
    """Number of rows per key whose target is missing."""
    return df.groupBy(*keys).agg(F.count_if(F.col(target).isNull()).alias("horizon"))


def calendar_features(df: DataFrame, date: str = "week_start_date") -> DataFrame:
    """``month`` number and ``weekday`` name."""
    day = F.to_date(F.col(date))
    return df.withColumns({"month": F.month(day), "weekday": F.date_format(day, "EEEE")})
