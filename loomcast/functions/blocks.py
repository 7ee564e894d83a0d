"""Ordered work cut into bounded pieces.

A window over ``partitionBy(key)`` puts a whole series into one task.  That is
fine, and needs only one shuffle for a chain of operators, where the length of a
series has a proven bound; otherwise the series is cut into blocks.

* :func:`position` gives each row a dense 0-based index per key.  Where the order
  column proves a bound (a date, or a number checked against a span) the index
  column carries it as metadata.
* :class:`Cut` picks per-series windows for bounded positions; for others it cuts
  the index into blocks and copies the few rows a fixed frame reaches across a
  block border.
* :func:`running_totals` carries sums over an order from block to block.
* :func:`bounded_position` fails in the map stage, before any shuffle, when an
  operator that needs a whole series in one task meets one that is too long.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomcast.functions.joins import attach, match
from loomcast.session import settle

BLOCK = 65_536
#: Distinct values of one block where rows are ordered by value.
BLOCK_VALUES = 1_000_000
MAX_POINTS = 4_000_000  # more than a date order can ever hold
BLK = "_blk"
BOUND = "series_bound"
DAYS_IN_DATE_TYPE = 3_652_059


def block_of(pos: str | Column, size: int = BLOCK) -> Column:
    pos = F.col(pos) if isinstance(pos, str) else pos
    return F.floor(pos / F.lit(size)).cast("long")


def known_bound(df: DataFrame, order: str) -> int | None:
    """Most rows one series can have, if its order column proves a bound."""
    field = df.schema[order]
    if BOUND in field.metadata:
        return field.metadata[BOUND]
    return DAYS_IN_DATE_TYPE if isinstance(field.dataType, T.DateType) else None


def _coarse_order(df: DataFrame, order: str) -> Column:
    """A monotone, deterministic cut of an unbounded order column."""
    if isinstance(df.schema[order].dataType, (T.TimestampType, T.TimestampNTZType)):
        day = F.to_date(F.col(order))
        return F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long")
    return block_of(order)


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hash rows by key into a fixed number of partitions.

    Windows per series need this shuffle anyway.  Asking for it keeps adaptive
    execution from merging its partitions by bytes: numeric work per series is
    heavy for its bytes, and whatever follows on the same keys stays spread.
    """
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(count, *keys)


def position(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    out: str = "i",
    span: tuple[int, int] | None = None,
) -> DataFrame:
    """Dense 0-based index of each row within its key, in ``order`` (unique per key).

    A date order, or a whole number inside ``span`` (others raise in the map
    stage), bounds the series: one window per key does it.  Otherwise rows are
    numbered inside (key, day or number block), and the start of a block is the
    running count of the blocks before it, so no task sees a whole long series.
    """
    keys = list(keys)
    bound = known_bound(df, order)
    if bound is None and span is not None:
        low, high = span
        inside = (F.col(order) >= low) & (F.col(order) < high)
        kind = df.schema[order].dataType
        checked = F.when(inside, F.col(order)).otherwise(
            F.raise_error(F.lit(f"{order} outside {low} to {high}")).cast(kind)
        )
        df = df.withColumn(order, checked)
        bound = high - low
    if bound is not None:
        df = spread(df, keys)
        line = Window.partitionBy(*keys).orderBy(order)
        return df.withColumn(out, _numbered(order, line)).withMetadata(out, {BOUND: bound})
    tagged = df.withColumn("_ob", _coarse_order(df, order))
    sizes = tagged.groupBy(*keys, "_ob").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_ob").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *keys, "_ob", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy(*keys, "_ob").orderBy(order)
    return (
        attach(tagged, starts, [*keys, "_ob"])
        .withColumn(out, _numbered(order, within) + F.col("_start"))
        .drop("_ob", "_start")
    )


def _numbered(order: str, line) -> Column:
    """0, 1, … in ``order``; raises where a key holds a value of it twice, as its bound counts each once."""
    twice = F.col(order) == F.lag(order).over(line)
    number = (F.row_number().over(line) - 1).cast("long")
    error = F.raise_error(F.concat(F.lit(f"{order} is not unique: "), F.col(order).cast("string"))).cast("long")
    return F.when(F.coalesce(twice, F.lit(False)), error).otherwise(number)


def keep_bound(df: DataFrame, source: DataFrame, pos: str) -> DataFrame:
    """Hand the proven bound of ``source``'s position on to a result of a grouped task."""
    bound = known_bound(source, pos)
    return df if bound is None else df.withMetadata(pos, {BOUND: bound})


class Cut:
    """A series table cut for work whose frame reaches ``before`` and ``after`` rows.

    ``rows`` is the table to work on, ``groups`` its grouping, ``window`` the
    matching window.  ``own`` drops the copied rows again.  A row at ``p`` is
    needed by every block that holds a row in ``p - after … p + before``.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        pos: str,
        before: int = 0,
        after: int = 0,
        size: int | None = None,
    ):
        self.pos, self.size = pos, size or BLOCK
        self.whole = size is None and known_bound(df, pos) is not None
        if self.whole:
            self.rows, self.groups = df, list(keys)
        else:
            self.groups = [*keys, BLK]
            block = block_of(pos, self.size)
            if before or after:
                first = F.greatest(
                    block_of(F.col(pos) - F.lit(after), self.size), F.lit(0).cast("long")
                )
                last = block_of(F.col(pos) + F.lit(before), self.size)
                block = F.explode(F.sequence(first, last))
            self.rows = df.withColumn(BLK, block)
        self.window = Window.partitionBy(*self.groups).orderBy(pos)
        self.backward = Window.partitionBy(*self.groups).orderBy(F.col(pos).desc())

    def own(self, df: DataFrame) -> DataFrame:
        if self.whole:
            return df
        return df.where(F.col(BLK) == block_of(self.pos, self.size)).drop(BLK)


def with_totals(
    df: DataFrame, keys: Sequence[str], pos: str | None, totals: dict[str, Column]
) -> DataFrame:
    """Attach per-key aggregates to every row.

    A bounded series takes them from a window on its own partition, in the same
    pass.  Otherwise they are aggregated, measured and joined back.
    """
    keys = list(keys)
    if pos is not None and known_bound(df, pos) is not None:
        span = Window.partitionBy(*keys)
        return df.withColumns({name: total.over(span) for name, total in totals.items()})
    found = df.groupBy(*keys).agg(*[total.alias(name) for name, total in totals.items()])
    return attach(df, found, keys)


def bounded_position(pos: str, limit: int = MAX_POINTS) -> Column:
    """The position itself, or an error raised row by row in the map stage."""
    col = F.col(pos)
    return F.when(col < limit, col).otherwise(
        F.raise_error(F.lit(f"series longer than {limit} points: use a coarser step")).cast("long")
    )


def value_splits(counts: DataFrame, value: str, max_rows: int) -> list[float]:
    """Quantiles of the distinct values such that no block holds many more than ``max_rows`` of them.

    ``counts`` has one row per (key, value) and is already written, so that neither its
    size nor its quantiles read the raw rows again.
    """
    blocks = -(-2 * counts.count() // max_rows)
    if blocks < 3:
        return []
    probs = [k / blocks for k in range(1, blocks)]
    return sorted(set(counts.approxQuantile(value, probs, 0.5 / blocks)))


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    totals: Sequence[str],
    splits: Sequence[float] = (),
) -> DataFrame:
    """Add ``{c}_below``, the exclusive running sum of each count column, and ``{c}_total``.

    ``df`` has one row per (key, order value).  With ``splits`` the order is cut
    into blocks; block sums are carried over in a small second step.
    """
    keys = list(keys)
    if not splits:
        cut = df.withColumn(BLK, F.lit(0.0))
    else:
        edges = [float("-inf"), *splits, float("inf")]
        numeric = df.withColumn("_o", F.col(order).cast("double"))
        cut = Bucketizer(splits=edges, inputCol="_o", outputCol=BLK).transform(numeric).drop("_o")
    inside = Window.partitionBy(*keys, BLK).orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    below = [
        F.coalesce(F.sum(c).over(inside), F.lit(0)).cast("long").alias(f"{c}_below")
        for c in totals
    ]
    if not splits:
        span = Window.partitionBy(*keys, BLK)
        whole = [F.sum(c).over(span).alias(f"{c}_total") for c in totals]
        return cut.select("*", *below, *whole).drop(BLK)
    local = cut.select("*", *below)
    across = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    span = Window.partitionBy(*keys)
    carry = (
        cut.groupBy(*keys, BLK)
        .agg(*[F.sum(c).alias(c) for c in totals])
        .select(
            *keys,
            BLK,
            *[F.coalesce(F.sum(c).over(across), F.lit(0)).alias(f"_c_{c}") for c in totals],
            *[F.sum(c).over(span).alias(f"{c}_total") for c in totals],
        )
    )
    plain = [c for c in local.columns if c not in {f"{t}_below" for t in totals} | {BLK}]
    return match(local, carry, [*keys, BLK]).select(
        *plain,
        *[(F.col(f"{c}_below") + F.col(f"_c_{c}")).cast("long").alias(f"{c}_below") for c in totals],
        *[f"{c}_total" for c in totals],
    )


def value_counts(
    df: DataFrame, keys: Sequence[str], value: str, max_rows: int = BLOCK_VALUES
) -> DataFrame:
    """(keys, value, n, n_below, n_total): each distinct value, its count, those below, and all."""
    known = df.where(F.col(value).isNotNull()).select(*keys, value)
    counts = settle(known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n")))
    splits = value_splits(counts, value, max_rows)
    return running_totals(counts, keys, value, ["n"], splits)


def order_statistics(
    counts: DataFrame, keys: Sequence[str], value: str, ranks: dict[str, Column]
) -> DataFrame:
    """Values at 0-based ``ranks`` (columns of the key's total ``_total``), one row per key."""
    keys = list(keys)
    return (
        counts.withColumnRenamed("n_total", "_total")
        .groupBy(*keys)
        .agg(
            F.first("_total").alias("_total"),
            *[
                F.min(F.when(F.col("n_below") + F.col("n") > rank, F.col(value))).alias(name)
                for name, rank in ranks.items()
            ],
        )
    )


def quantiles(
    counts: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Exact quantiles with linear interpolation, from :func:`value_counts`."""
    keys = list(keys)
    ranks = {}
    for name, p in probs.items():
        place = (F.col("_total") - 1) * F.lit(float(p))
        ranks[f"_lo_{name}"] = F.floor(place)
        ranks[f"_hi_{name}"] = F.ceil(place)
    found = order_statistics(counts, keys, value, ranks)
    return found.select(
        *keys,
        F.col("_total").alias("n"),
        *[
            (
                F.col(f"_lo_{name}")
                + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}"))
                * ((F.col("_total") - 1) * F.lit(float(p)) - F.floor((F.col("_total") - 1) * F.lit(float(p))))
            ).alias(name)
            for name, p in probs.items()
        ],
    )
