"""Augmented Dickey-Fuller test and differencing until it passes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.functions.blocks import Cut, known_bound, position, with_totals
from loomcast.functions.gram import Summed, lags, lagged_fit, solve
from loomcast.functions.grouped import to_null
from loomcast.functions.tails import adf_p
from loomcast.functions.joins import match

LONGEST = 1_000_000_000


def largest_lag(n: int) -> int:
    """Schwert's rule, capped by the sample."""
    return max(0, min(int(np.ceil(12.0 * (n / 100.0) ** 0.25)), n // 2 - 2))


def _unit_root_rows(y: np.ndarray, start: int, stop: int, lag: int) -> np.ndarray:
    """Rows (1, y[t-1], dy[t-1] … dy[t-lag], dy[t]) for t in start … stop-1."""
    dy = np.concatenate(([np.nan], np.diff(y)))
    t = np.arange(start, stop)
    return np.column_stack(
        [np.ones(len(t)), y[start - 1 : stop - 1], lags(dy, start, stop, lag), dy[start:stop]]
    )


def adf_by_difference(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    max_d: int = 0,
    lag: int | None = None,
    size: int | None = None,
) -> DataFrame:
    """(keys, d, n, lag, adf_stat, p_value) for the series differenced 0 … ``max_d`` times.

    All orders come from one pass.  Without a fixed ``lag`` it is chosen by AIC on
    the common sample, then the test is refitted on all rows that lag allows; the
    few rows that adds are built from the first values of the series.
    """
    keys = list(keys)
    known = df.where(F.col(value).isNotNull()).select(*keys, pos, value)
    ranked = position(known, keys, pos, "_j")
    sized = with_totals(
        ranked,
        keys,
        "_j",
        {"_n": F.count(F.lit(1)), "_m": F.avg(value), "_sd": F.stddev_pop(value)},
    )
    spread = F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(F.lit(1.0))
    scaled = sized.select(*keys, "_j", "_n", ((F.col(value) - F.col("_m")) / spread).alias("_y"))
    bound = known_bound(scaled, "_j") or LONGEST
    top = largest_lag(bound) if lag is None else lag
    reach = top + max_d + 1

    def lag_for(n: int) -> int:
        return largest_lag(n) if lag is None else lag

    def design(values, start, stop, offset, total):
        out = {}
        for d in range(max_d + 1):
            most = lag_for(total - d)
            begin = max(start, most + 1 + d - offset)
            if begin >= stop or total - d < 4:
                continue
            low = begin - most - 1 - d
            y = np.diff(values["_y"][low:stop], d)
            out[d] = _unit_root_rows(y, most + 1, len(y), most)
        return out

    def test(data: Summed) -> pd.DataFrame:
        total = int(data.first["_n"])
        rows = []
        for d in range(max_d + 1):
            n = total - d
            most = lag_for(n)
            row = {"d": d, "n": 0, "lag": 0, "adf_stat": np.nan, "p_value": np.nan}
            gram = data.grams.get(d)
            rows.append(row)
            if gram is None:
                continue
            count, last = int(round(gram[0, 0])), len(gram) - 1
            best = most
            if lag is None:
                fits = [
                    (solve(gram, range(2 + p), last, count), p) for p in range(most + 1)
                ]
                scored = [(f.aic, p) for f, p in fits if f is not None]
                if not scored:
                    continue
                best = min(scored)[1]
            keep = [*range(2 + best), last]
            refit = gram[np.ix_(keep, keep)].copy()
            if best < most:
                y = np.diff(data.head["_y"][: most + 1 + d], d)
                added = _unit_root_rows(y, best + 1, len(y), best)
                refit += added.T @ added
                count += len(added)
            fit = solve(refit, range(2 + best), 2 + best, count)
            if fit is None or fit.se[1] == 0:
                continue
            stat = fit.coef[1] / fit.se[1]
            row.update(n=count, lag=best, adf_stat=stat, p_value=float(adf_p(stat)))
        return pd.DataFrame(rows)

    found = lagged_fit(
        scaled,
        keys,
        "_j",
        ["_y"],
        reach,
        design,
        test,
        "d int, n bigint, lag int, adf_stat double, p_value double",
        head=reach + 1,
        size=size,
    )
    return to_null(found, "adf_stat", "p_value")


def adf_test(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    lag: int | None = None,
    size: int | None = None,
) -> DataFrame:
    """(keys, n, lag, adf_stat, p_value), constant only; lag by AIC unless given."""
    return adf_by_difference(df, keys, pos, value, 0, lag, size).drop("d")


def difference_until_stationary(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    alpha: float = 0.05,
    max_d: int = 3,
    out: str = "stationary",
) -> tuple[DataFrame, DataFrame]:
    """Difference each series as often as its test asks for, at most ``max_d`` times.

    Returns the rows with ``out`` and the report (keys, n_diff, adf_stat, p_value).
    Differences run over the known values and come back on their positions.
    """
    keys = list(keys)
    tests = adf_by_difference(df, keys, pos, value, max_d)
    passed = F.col("p_value") <= alpha
    # a series without any test, such as a constant one, is left as it is
    first = F.when(F.count("p_value") > 0, F.coalesce(F.min(F.when(passed, F.col("d"))), F.lit(max_d))).otherwise(0)
    order = tests.groupBy(*keys).agg(first.alias("n_diff"))
    report = match(order, tests.withColumnRenamed("d", "n_diff"), [*keys, "n_diff"], "left").select(
        *keys, "n_diff", "adf_stat", "p_value"
    )
    known = position(
        df.where(F.col(value).isNotNull()).select(*keys, pos, value), keys, pos, "_j"
    )
    cut = Cut(known, keys, "_j", before=max_d)
    forms = [F.col(value)]
    for d in range(1, max_d + 1):
        total = F.col(value)
        weight = 1.0
        for h in range(1, d + 1):
            weight = -weight * (d - h + 1) / h
            total = total + F.lit(weight) * F.lag(value, h).over(cut.window)
        forms.append(total)
    wide = cut.own(cut.rows.withColumn("_forms", F.array(*forms))).select(*keys, pos, "_forms")
    changed = (
        df.join(wide, [*keys, pos], "left")
        .join(order, keys, "left")
        .select(*df.columns, F.get("_forms", F.col("n_diff")).alias(out))
    )
    return changed, report
