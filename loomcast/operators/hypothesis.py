"""Two-sample, variance and residual tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.functions.blocks import BLOCK_VALUES, running_totals, value_splits
from loomcast.functions.joins import attach
from loomcast.functions.tails import chi2_tail, f_tail, ks_tail, normal_score
from loomcast.operators.spectrum import acf
from loomcast.session import settle

#: Rows of the larger sample up to which the two-sample test's p-value is exact.
EXACT_ROWS = 10_000


def ks_two_sample(
    df: DataFrame,
    keys: Sequence[str],
    group: str,
    value: str,
    first,
    second,
    max_rows: int = BLOCK_VALUES,
    exact: bool = False,
) -> DataFrame:
    """(keys, n1, n2, statistic, p_value): largest gap between two empirical distributions.

    Rows are counted per distinct value before any order is needed, so equal values
    move both distributions at once.  The p-value is the asymptotic one; with ``exact`` it
    is the exact one of samples without equal values where neither has more than
    ``EXACT_ROWS`` rows, and a column ``method`` says which.
    """
    keys = list(keys)
    sample = df.where(F.col(value).isNotNull() & F.col(group).isin(first, second))
    counts = settle(
        sample.groupBy(*keys, value).agg(
            F.count_if(F.col(group) == first).alias("a"), F.count_if(F.col(group) == second).alias("b")
        )
    )
    splits = value_splits(counts, value, max_rows)
    running = (
        running_totals(counts, keys, value, ["a", "b"], splits)
        .withColumnRenamed("a_total", "n1")
        .withColumnRenamed("b_total", "n2")
    )
    gap = F.abs(
        (F.col("a_below") + F.col("a")) / F.nullif(F.col("n1"), F.lit(0))
        - (F.col("b_below") + F.col("b")) / F.nullif(F.col("n2"), F.lit(0))
    )
    found = running.groupBy(*keys, "n1", "n2").agg(F.max(gap).alias("statistic"))
    size = F.col("n1") * F.col("n2") / F.nullif(F.col("n1") + F.col("n2"), F.lit(0))
    reach = F.col("statistic") * F.sqrt(size)
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * reach * reach),
    )
    total = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    tail = F.when(reach < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))
    found = found.withColumn("p_value", tail)
    if not exact:
        return found
    small = F.greatest("n1", "n2") <= EXACT_ROWS
    found = found.withColumn("method", F.when(small, "exact").otherwise("asymptotic"))
    own = ks_tail(F.when(small, F.col("n1")), F.col("n2"), F.col("statistic"))
    return found.withColumn("p_value", F.when(small, own).otherwise(F.col("p_value")))


def anova_oneway(df: DataFrame, keys: Sequence[str], group: str, value: str) -> DataFrame:
    """(keys, groups, n, f, p_value): group sums first, then one row per key."""
    keys = list(keys)
    shift = df.where(F.col(value).isNotNull())
    by_group = shift.groupBy(*keys, group).agg(
        F.count(F.lit(1)).alias("_n"), F.avg(value).alias("_m"), F.var_pop(value).alias("_v")
    )
    n, m = F.col("_n").cast("double"), F.col("_m")
    parts = by_group.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("_n").alias("n"),
        F.sum(n * F.col("_v")).alias("_within"),
        F.sum(n * m).alias("_s"),
        F.sum(n * m * m).alias("_q"),
    )
    between = F.col("_q") - F.col("_s") * F.col("_s") / F.col("n")
    df1, df2 = F.col("groups") - 1, F.col("n") - F.col("groups")
    ratio = (between / F.nullif(df1, F.lit(0))) / F.nullif(
        F.col("_within") / F.nullif(df2, F.lit(0)), F.lit(0.0)
    )
    scored = parts.select(*keys, "groups", "n", ratio.alias("f"), df1.alias("_d1"), df2.alias("_d2"))
    tail = f_tail(F.col("f"), F.col("_d1").cast("double"), F.col("_d2").cast("double"))
    return scored.withColumn("p_value", tail).drop("_d1", "_d2")


def ljung_box(
    df: DataFrame, keys: Sequence[str], pos: str, resid: str, lags: int = 1
) -> DataFrame:
    """(keys, n, q, p_value) of the residual autocorrelations up to ``lags``."""
    table = acf(df, keys, pos, resid, lags).where(F.col("lag") > 0)
    share = F.sum(F.col("acf") * F.col("acf") / (F.col("n") - F.col("lag")))
    found = table.groupBy(*keys, "n").agg((F.col("n") * (F.col("n") + 2) * share).alias("q"))
    return found.withColumn("p_value", chi2_tail(F.col("q"), F.lit(float(lags))))


def standardized_residuals(
    df: DataFrame, keys: Sequence[str], resid: str, out: str = "std_resid"
) -> DataFrame:
    """Residual over its population standard deviation."""
    spread = df.groupBy(*keys).agg(F.stddev_pop(resid).alias("_sd"))
    return attach(df, spread, keys).select(
        *df.columns, (F.col(resid) / F.nullif(F.col("_sd"), F.lit(0.0))).alias(out)
    )


def quantile_pairs(
    df: DataFrame, keys: Sequence[str], value: str, max_rows: int = BLOCK_VALUES
) -> DataFrame:
    """(keys, value, n, theory): each distinct value beside the normal quantile of its last rank."""
    keys = list(keys)
    sample = df.where(F.col(value).isNotNull()).select(*keys, value)
    counts = settle(sample.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n")))
    splits = value_splits(counts, value, max_rows)
    ranked = running_totals(counts, keys, value, ["n"], splits)
    place = (F.col("n_below") + F.col("n")) / (F.col("n_total") + 1)
    return ranked.select(*keys, value, "n", normal_score(place).alias("theory"))
