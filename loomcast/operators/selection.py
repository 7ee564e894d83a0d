"""Lag selection by Granger causality and column selection by lasso."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.functions.blocks import position, with_totals
from loomcast.functions.gram import Summed, lags, lagged_fit, residual_sum
from loomcast.functions.grouped import to_null
from loomcast.functions.tails import f_sf


def granger(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    target: str,
    feature: str,
    maxlag: int = 52,
    size: int | None = None,
) -> DataFrame:
    """(keys, lag, n, f, p_value) for L = 1 … maxlag: do L lags of the feature help?

    One cross-product matrix at ``maxlag`` serves all lags.  Lag L may use the rows
    L … maxlag-1 too; those few are added from the first values of the series.
    """
    keys = list(keys)
    known = df.where(F.col(target).isNotNull() & F.col(feature).isNotNull())
    ranked = position(known.select(*keys, pos, target, feature), keys, pos, "_j")
    stats = {"_n": F.count(F.lit(1))}
    for name, c in (("y", target), ("x", feature)):
        stats[f"_m{name}"] = F.avg(c)
        stats[f"_s{name}"] = F.stddev_pop(c)
    sized = with_totals(ranked, keys, "_j", stats)

    def scaled(c, name):
        spread = F.when(F.col(f"_s{name}") > 0, F.col(f"_s{name}")).otherwise(F.lit(1.0))
        return ((F.col(c) - F.col(f"_m{name}")) / spread).alias(f"_{name}")

    ready = sized.select(*keys, "_j", "_n", scaled(target, "y"), scaled(feature, "x"))

    def levels(v, start, stop, count):
        # v[t-1] and its changes span the same space as the lags, far better conditioned
        change = np.concatenate(([0.0], np.diff(v)))
        return np.column_stack([lags(v, start, stop, 1), lags(change, start, stop, count - 1)])

    def rows(y, x, start, stop, count):
        return np.column_stack(
            [
                np.ones(stop - start),
                levels(y, start, stop, count),
                levels(x, start, stop, count),
                y[start:stop] - y[start - 1 : stop - 1],
            ]
        )

    def design(values, start, stop, offset, total):
        begin = max(start, maxlag - offset)
        if begin >= stop:
            return {}
        return {0: rows(values["_y"], values["_x"], begin, stop, maxlag)}

    def test(data: Summed) -> pd.DataFrame:
        out = []
        total = int(data.first["_n"])
        gram = data.grams.get(0)
        y, x = data.head["_y"], data.head["_x"]
        for lag in range(1, maxlag + 1):
            n = total - lag
            f = np.nan
            if n > 2 * lag + 1:
                own = range(1, lag + 1)
                other = range(maxlag + 1, maxlag + lag + 1)
                keep = [0, *own, *other, 2 * maxlag + 1]
                part = np.zeros((len(keep), len(keep)))
                if gram is not None:
                    part += gram[np.ix_(keep, keep)]
                stop = min(maxlag, len(y))
                if stop > lag:
                    added = rows(y, x, lag, stop, lag)
                    part += added.T @ added
                last = 2 * lag + 1
                short = residual_sum(part, range(lag + 1), last)
                full = residual_sum(part, range(last), last)
                if full > 0:
                    free = n - 2 * lag - 1
                    f = max((short - full) / lag / (full / free), 0.0)
            out.append({"lag": lag, "n": n, "f": f})
        table = pd.DataFrame(out)
        free = np.maximum(table["n"] - 2 * table["lag"] - 1, 1)
        p = f_sf(table["f"].fillna(0.0), table["lag"], free)
        return table.assign(p_value=np.where(table["f"].isna(), np.nan, p))

    found = lagged_fit(
        ready,
        keys,
        "_j",
        ["_y", "_x"],
        maxlag,
        design,
        test,
        "lag int, n bigint, f double, p_value double",
        head=maxlag,
        size=size,
    )
    return to_null(found, "f", "p_value")


def significant_lags(
    tests: DataFrame, keys: Sequence[str], alpha: float = 0.05
) -> DataFrame:
    """(keys, sign_lag): the largest lag whose test is significant, 0 if none."""
    hit = F.when(F.col("p_value") < alpha, F.col("lag"))
    return tests.groupBy(*keys).agg(F.coalesce(F.max(hit), F.lit(0)).alias("sign_lag"))


def granger_features(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    target: str,
    features: Sequence[str],
    maxlag: int = 52,
    alpha: float = 0.05,
) -> DataFrame:
    """(keys, feature, sign_lag): every feature tested in one plan over (key, feature)."""
    keys = list(keys)
    long = df.select(*keys, pos, F.col(target).alias("_target"), *features).unpivot(
        [*keys, pos, "_target"], list(features), "feature", "_value"
    )
    tests = granger(long, [*keys, "feature"], pos, "_target", "_value", maxlag)
    return significant_lags(tests, [*keys, "feature"], alpha)
