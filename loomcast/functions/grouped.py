"""Glue for per-series tasks: schemas and grouped pandas calls."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomcast.functions.blocks import MAX_POINTS, bounded_position, spread


def key_schema(df: DataFrame, keys: Sequence[str], extra: str) -> T.StructType:
    """The key fields of ``df`` followed by the fields of the DDL string ``extra``."""
    fields = [df.schema[k] for k in keys]
    return T.StructType(fields + list(T._parse_datatype_string(extra).fields))


def per_group(
    df: DataFrame,
    groups: Sequence[str],
    keys: Sequence[str],
    extra: str,
    work: Callable[[pd.DataFrame], pd.DataFrame],
) -> DataFrame:
    """``applyInPandas`` over ``groups``; ``work`` returns the ``extra`` columns, keys are put back."""
    keys = list(keys)
    schema = key_schema(df, keys, extra)
    names = [f.name for f in schema.fields]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = work(pdf)
        for k in keys:
            out[k] = pd.Series([pdf[k].iloc[0]] * len(out), index=out.index, dtype=object)
        return out[names]

    return df.groupBy(*groups).applyInPandas(run, schema)


def per_series(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    columns: Sequence[str],
    extra: str,
    work: Callable[[pd.DataFrame], pd.DataFrame],
    limit: int = MAX_POINTS,
) -> DataFrame:
    """One task per series, for methods that need a whole series at once.

    The length is bounded before the shuffle: a row past ``limit`` raises in the
    map stage.  ``work`` gets the rows in position order.
    """
    slim = df.select(*keys, bounded_position(pos, limit).alias(pos), *columns)
    return per_group(
        spread(slim, keys), keys, keys, extra, lambda pdf: work(pdf.sort_values(pos, ignore_index=True))
    )


def to_null(df: DataFrame, *columns: str) -> DataFrame:
    """NaN out of numeric code becomes NULL again."""
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in columns})
