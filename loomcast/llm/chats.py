"""Rendering logged chats after dropping snapshots that longer ones contain.

A chat that is logged again after each turn appears as several conversations, each a
prefix of the next. Every prefix gets a rolling hash of its turns; a conversation whose
whole hash is a prefix hash of a longer one is dropped by an anti-join, equal ones leave
one, and the maximal conversations are rendered.

One conversation may hold any share of the rows: turns are sorted over all tasks, and
what a task hands on to the next (turn count and hash of the conversation so far) is
carried over a small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.llm.common import keep

#: Turns of one rendered row; longer conversations get several rows.
SEGMENT = 64
#: How a turn is written; marks within a text are broken up so that none can be forged.
MARK, BROKEN = "<|", "< |"


def rendered_turn(role: Column, text: Column) -> Column:
    clean = lambda c: F.replace(c, F.lit(MARK), F.lit(BROKEN))
    return F.concat(F.lit("<|"), clean(role), F.lit("|>\n"), clean(text), F.lit("\n<|end|>\n"))


def _before(shares: DataFrame, columns: list[str], join) -> DataFrame:
    """For conversations that lie in several tasks' shares: the earlier shares' sums, as _<column>."""
    line = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    several = shares.groupBy("conv_id").agg(F.count(F.lit(1)).alias("parts")).filter("parts > 1").select("conv_id")
    own = shares.join(several, "conv_id")
    return own.select("part", "conv_id", *[join(F.col(c)).over(line).alias(f"_{c}") for c in columns])


def prefixes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns with their place, prefix hashes): conv_id, place from 1, role, text; conv_id, place, p1, p2."""
    clean = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    # a turn that is logged twice counts once; repeats are dropped before rows are sorted
    ordered = clean.distinct().withColumn("_k", F.xxhash64("role", "text")).repartitionByRange("conv_id", "turn", "_k")
    ordered = keep(ordered.withColumn("part", F.spark_partition_id()), "turns")
    shares = ordered.groupBy("part", "conv_id").agg(F.count(F.lit(1)).alias("n"))
    earlier = _before(shares, ["n"], F.sum)
    line = Window.partitionBy("part", "conv_id").orderBy(F.col("turn").asc_nulls_first(), "_k", "role", "text")
    placed = ordered.withColumn("_p", F.row_number().over(line).cast("long")).join(earlier, ["part", "conv_id"], "left")
    placed = placed.withColumn("place", F.col("_p") + F.coalesce("_n", F.lit(0)))
    for k in (1, 2):
        placed = placed.withColumn(f"h{k}", F.xxhash64(F.lit(k), "place", "role", "text"))
    placed = keep(placed.select("part", "conv_id", "place", "role", "text", "h1", "h2"), "placed")
    # each turn's hash holds its place, so a prefix is the xor of its turns' hashes
    sums = placed.groupBy("part", "conv_id").agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    carried = _before(sums, ["h1", "h2"], F.bit_xor)
    upto = Window.partitionBy("part", "conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rolling = placed.select("part", "conv_id", "place", *[F.bit_xor(f"h{k}").over(upto).alias(f"x{k}") for k in (1, 2)])
    rolling = rolling.join(carried, ["part", "conv_id"], "left")
    hashes = [F.col(f"x{k}").bitwiseXOR(F.coalesce(f"_h{k}", F.lit(0).cast("long"))).alias(f"p{k}") for k in (1, 2)]
    return placed, keep(rolling.select("conv_id", "place", *hashes), "prefixes")


def maximal(hashes: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of conversations that are no proper prefix of another; of equal ones the smallest id."""
    lengths = hashes.groupBy("conv_id").agg(F.max("place").alias("n_turns"))
    rows = hashes.join(keep(lengths, "lengths"), "conv_id")
    whole = rows.filter("place = n_turns").select("conv_id", "n_turns", "p1", "p2")
    longer = rows.filter("place < n_turns").select(F.col("place").alias("n_turns"), "p1", "p2").distinct()
    rest = whole.join(longer, ["n_turns", "p1", "p2"], "left_anti")
    return rest.groupBy("n_turns", "p1", "p2").agg(F.min("conv_id").alias("conv_id")).select("conv_id", "n_turns")


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per segment of 64 turns of each maximal conversation: conv_id, segment, n_turns, rendered.

    ``turns`` holds conv_id, turn, role, text. Turns are ordered by turn number (null first),
    then by a hash of role and text; a turn that comes twice with all of conv_id, turn,
    role and text counts once. Null role or text counts as empty. Rows without a conv_id
    belong to no conversation and take no part. Other columns are ignored, whatever
    their names. An empty table gives an empty result.
    """
    placed, hashes = prefixes(turns)
    stays = keep(maximal(hashes), "maximal")
    segment = F.floor((F.col("place") - 1) / SEGMENT).cast("long")
    lines = placed.join(stays, "conv_id").select(
        "conv_id", "n_turns", segment.alias("segment"), F.struct("place", rendered_turn(F.col("role"), F.col("text")).alias("t")).alias("line")
    )
    parts = lines.groupBy("conv_id", "segment", "n_turns").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    return parts.select("conv_id", "segment", "n_turns", F.array_join(F.transform("lines", lambda x: x["t"]), "").alias("rendered"))
