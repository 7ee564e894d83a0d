"""Helpers shared by the corpus operators: tables, kept results, bounded text batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.session import scratch_path, ship_package

#: Text bytes that Python code looks at together; one longer text is looked at alone.
PIECE_BYTES = 1 << 20

#: Runs of white space that are not one plain space.
ODD_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it from there.

    What follows no longer depends on the executors that made it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name made from ``name`` that ``df`` does not have."""
    while name in df.columns:
        name = f"_{name}"
    return name


def python_ready(df: DataFrame) -> DataFrame:
    """Let the Python workers import this package, then return ``df``."""
    ship_package(df.sparkSession)
    return df


def one_space(text: Column) -> Column:
    """Null as empty; each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), ODD_SPACE, " ")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for row, size in enumerate(sizes):
            size = 0 if size != size or size is None else int(size)
            if row > start and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)
