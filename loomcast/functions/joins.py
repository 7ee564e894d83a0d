"""Attaching per-key results to rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.session import settle

#: Bytes up to which a per-key table is broadcast.
BROADCAST_BYTES = 8 << 20


def measured_bytes(facts: DataFrame) -> int:
    """Rows times fixed widths, plus the real length of strings and binaries."""
    texts = [f.name for f in facts.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    length = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0))
    row = facts.agg(F.count(F.lit(1)).alias("n"), F.sum(length).alias("b")).first()
    return row["n"] * (16 + 8 * len(facts.columns)) + (row["b"] or 0)


def attach(df: DataFrame, facts: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``df`` with the other columns of ``facts``, which has one row per key.

    A null key is a key like any other, and without keys the single row of ``facts`` goes
    to every row.  ``facts`` is computed once and measured: a table of up to
    ``BROADCAST_BYTES`` is broadcast, so that rows stay where they are; a larger one is
    joined by a shuffle, whose hot keys adaptive execution splits.
    """
    keys = list(keys)
    facts = settle(facts)
    if not keys:
        return df.crossJoin(F.broadcast(facts))
    named = facts.withColumnsRenamed({k: f"_on_{k}" for k in keys})
    if measured_bytes(facts) <= BROADCAST_BYTES:
        named = F.broadcast(named)
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(named[f"_on_{k}"]) for k in keys])
    return df.join(named, same, how).drop(*[f"_on_{k}" for k in keys])


def match(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which a null key is a key like any other; key columns come once, from the left."""
    named = right.withColumnsRenamed({k: f"_on_{k}" for k in on})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(named[f"_on_{k}"]) for k in on])
    return left.join(named, same, how).drop(*[f"_on_{k}" for k in on])
