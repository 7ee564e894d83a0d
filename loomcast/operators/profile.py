"""Profiling, scores, scaling and distribution tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.functions.blocks import BLOCK_VALUES, quantiles, value_counts
from loomcast.functions.joins import attach


def missing_profile(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Percent missing per column (and per key): one aggregation, then one row per column.

    The overall profile comes sorted, most missing first; one per key is not, as a
    global sort of it would only cost a shuffle.
    """
    wide = df.groupBy(*keys).agg(
        *[(F.count_if(F.col(c).isNull()) * 100.0 / F.count(F.lit(1))).alias(c) for c in cols]
    )
    long = wide.unpivot(list(keys), list(cols), "variable", "pct_missing")
    return long if keys else long.orderBy(F.desc("pct_missing"), "variable")


def split_easy_difficult(profile: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Add ``easy``: strictly less missing than ``threshold`` percent."""
    return profile.withColumn("easy", F.col("pct_missing") < F.lit(float(threshold)))


def nrmse_expression(truth: str, guess: str, n: int | Column | None = None) -> Column:
    """Aggregate: root of squared error over ``n``, by the range of the truth.

    Missing where any guess is missing, as an incomplete fill cannot be scored.
    """
    squared = F.sum(F.pow(F.col(truth) - F.col(guess), F.lit(2.0)))
    count = F.count(F.lit(1)) if n is None else (F.lit(n) if isinstance(n, int) else n)
    span = F.nullif(F.max(truth) - F.min(truth), F.lit(0.0))
    score = F.sqrt(squared / count) / span
    return F.when(F.count_if(F.col(guess).isNull()) == 0, score)


def nrmse(
    df: DataFrame, keys: Sequence[str], truth: str, guess: str, n: int | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Normalised root mean squared error per key, optionally rounded half to even."""
    score = nrmse_expression(truth, guess, n)
    return df.groupBy(*keys).agg(
        (score if digits is None else F.bround(score, digits)).alias("nrmse")
    )


def mae(df: DataFrame, keys: Sequence[str], truth: str, guess: str) -> DataFrame:
    """Mean absolute error per key."""
    return df.groupBy(*keys).agg(F.avg(F.abs(F.col(truth) - F.col(guess))).alias("mae"))


def corr_matrix(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every pair of columns in one pass, as (x, y, corr) rows."""
    pairs = list(combinations(cols, 2))
    wide = df.groupBy(*keys).agg(
        *[F.corr(a, b).alias(f"_{k}") for k, (a, b) in enumerate(pairs)]
    )
    rows = [F.struct(F.lit(c).alias("x"), F.lit(c).alias("y"), F.lit(1.0).alias("corr")) for c in cols]
    for k, (a, b) in enumerate(pairs):
        for x, y in ((a, b), (b, a)):
            rows.append(
                F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"_{k}").alias("corr"))
            )
    return wide.select(*keys, F.explode(F.array(*rows)).alias("_r")).select(*keys, "_r.*")


def correlation_with(
    df: DataFrame, target: str, cols: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Correlation of each column with the target, as (variable, corr) rows."""
    others = [c for c in cols if c != target]
    wide = df.groupBy(*keys).agg(*[F.corr(c, target).alias(c) for c in others])
    return wide.unpivot(list(keys), others, "variable", "corr")


def top_correlated(
    df: DataFrame, target: str, cols: Sequence[str], k: int = 30, mode: str = "abs"
) -> DataFrame:
    """``abs``: the ``k`` strongest; ``ends``: the ``k`` lowest and ``k`` highest signed ones."""
    table = correlation_with(df, target, cols)
    if mode == "abs":
        strength = table.select("variable", F.abs("corr").alias("corr"))
        return strength.orderBy(F.desc("corr"), "variable").limit(k)
    low = table.orderBy("corr", "variable").limit(k)
    high = table.orderBy(F.desc("corr"), "variable").limit(k)
    return low.union(high).distinct()


def mean_encode(
    df: DataFrame, col: str, target: str, keys: Sequence[str] = (), out: str | None = None
) -> DataFrame:
    """Replace a category by the mean target of that category.

    The means are measured before they join back, see ``attach``.
    """
    on = [*keys, col]
    means = df.groupBy(*on).agg(F.avg(target).alias("_mean"))
    joined = attach(df, means, on)
    if out is None:
        return joined.select(*[F.col("_mean").alias(c) if c == col else F.col(c) for c in df.columns])
    return joined.select(*df.columns, F.col("_mean").alias(out))


def skewness(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Biased skewness per column, flagged when its size exceeds one."""
    wide = df.groupBy(*keys).agg(*[F.skewness(c).alias(c) for c in cols])
    return wide.unpivot(list(keys), list(cols), "variable", "skewness").withColumn(
        "skewed", F.abs("skewness") > 1
    )


def log_shift(df: DataFrame, keys: Sequence[str], col: str, out: str = "logged") -> DataFrame:
    """``log(x + |min| + 1)``, the minimum taken per key."""
    lows = df.groupBy(*keys).agg(F.min(col).alias("_low"))
    return attach(df, lows, keys).select(
        *df.columns, F.log(F.col(col) + F.abs("_low") + F.lit(1.0)).alias(out)
    )


def log_shift_if_skewed(df: DataFrame, keys: Sequence[str], col: str, out: str = "logged") -> DataFrame:
    """``log_shift`` only for keys whose column is skewed and reaches zero or below."""
    marks = df.groupBy(*keys).agg(F.min(col).alias("_low"), F.skewness(col).alias("_skew"))
    shifted = F.log(F.col(col) + F.abs("_low") + F.lit(1.0))
    wanted = (F.abs("_skew") > 1) & (F.col("_low") <= 0)
    return attach(df, marks, keys).select(
        *df.columns, F.when(wanted, shifted).otherwise(F.col(col)).alias(out)
    )


def fit_scaler(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each column per key (``mean_{c}``, ``std_{c}``)."""
    return df.groupBy(*keys).agg(
        *[F.avg(c).alias(f"mean_{c}") for c in cols],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in cols],
    )


def apply_scaler(
    df: DataFrame, scaler: DataFrame, keys: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """``(x - mean) / std`` with a scaler that may come from another subset; a zero std counts as 1."""
    scaled = {
        c: (F.col(c) - F.col(f"mean_{c}"))
        / F.when(F.col(f"std_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"std_{c}"))
        for c in cols
    }
    return attach(df, scaler, keys, "inner").select(
        *[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns]
    )


def standardize(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return apply_scaler(df, fit_scaler(df, keys, cols), keys, cols)


def minmax_scale(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``(x - min) / (max - min)``; a constant column becomes 0."""
    spans = df.groupBy(*keys).agg(
        *[F.min(c).alias(f"_lo_{c}") for c in cols], *[F.max(c).alias(f"_hi_{c}") for c in cols]
    )
    scaled = {}
    for c in cols:
        span = F.col(f"_hi_{c}") - F.col(f"_lo_{c}")
        scaled[c] = (F.col(c) - F.col(f"_lo_{c}")) / F.when(span == 0, F.lit(1.0)).otherwise(span)
    return attach(df, spans, keys).select(
        *[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns]
    )


def max_scale(df: DataFrame, keys: Sequence[str], col: str, out: str = "scaled") -> DataFrame:
    """``y / max(y)`` per key."""
    tops = df.groupBy(*keys).agg(F.max(col).alias("_top"))
    return attach(df, tops, keys).select(
        *df.columns, (F.col(col) / F.nullif(F.col("_top"), F.lit(0.0))).alias(out)
    )


def missing_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing values left per column."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "variable", "missing")


def assert_complete(df: DataFrame, cols: Sequence[str], what: str = "imputation") -> DataFrame:
    """Raise with the counts per column if anything is still missing; one aggregation job."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    left = {c: row[c] for c in cols if row[c]}
    if left:
        raise ValueError(f"{what} left missing values: {left}")
    return df


def ecdf(df: DataFrame, keys: Sequence[str], col: str, max_rows: int = BLOCK_VALUES) -> DataFrame:
    """Empirical distribution: each distinct value with its count and share at or below it.

    Equal observations share one step, whose height is that of the last of them.
    """
    counts = value_counts(df, keys, col, max_rows)
    share = (F.col("n_below") + F.col("n")) / F.col("n_total")
    return counts.select(*keys, col, "n", share.alias("share"))


def histogram(df: DataFrame, keys: Sequence[str], col: str, bins: int = 10) -> DataFrame:
    """Equal-width counts between each key's extremes; empty bins are left out."""
    spans = df.groupBy(*keys).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    place = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - F.col("_lo")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    )
    return (
        attach(df.where(F.col(col).isNotNull()), spans, keys)
        .groupBy(*keys, place.cast("int").alias("bin"))
        .agg(
            F.first(F.col("_lo") + place * width).alias("bin_start"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def boxplot_stats(df: DataFrame, keys: Sequence[str], col: str, max_rows: int = BLOCK_VALUES) -> DataFrame:
    """Quartiles and the outermost values within 1.5 interquartile ranges."""
    counts = value_counts(df, keys, col, max_rows)
    quarters = quantiles(counts, keys, col, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    low = F.min(F.when(F.col(col) >= F.col("q1") - reach, F.col(col)))
    high = F.max(F.when(F.col(col) <= F.col("q3") + reach, F.col(col)))
    return (
        attach(counts, quarters.drop("n"), keys)
        .groupBy(*keys, "q1", "median", "q3")
        .agg(low.alias("whisker_low"), high.alias("whisker_high"))
    )
