"""ARMA orders by two-stage least squares, their forecasts and in-sample predictions.

The first stage is a long autoregression whose residuals stand in for the unseen
shocks; the second regresses the series on its own lags and on lags of those
(Hannan and Rissanen).  It is not maximum likelihood: its AIC values compare with
each other, not with those of a likelihood-based fit.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.functions.blocks import Cut, known_bound, position, with_totals
from loomcast.functions.gram import LAGGED, Summed, dot, lags, lagged_fit, solve
from loomcast.functions.grouped import per_group, to_null
from loomcast.functions.tails import chi2_sf
from loomcast.functions.joins import match

Z95 = 1.959963984540054
LONG_AR_CAP = 120


def long_order(n: int) -> int:
    """Order of the first-stage autoregression: about 10 log10 n, at most a quarter of n."""
    return max(1, min(int(np.ceil(10 * np.log10(max(n, 2)))), n // 4, LONG_AR_CAP))


def innovations(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    exog: Sequence[str] = (),
    size: int | None = None,
) -> DataFrame:
    """(keys, pos, j, n, mean, sd, z, e, exog): standardised series and first-stage residuals.

    Rows with a missing value are left out; ``e`` is missing on the rows the long
    autoregression needs to start.
    """
    keys = list(keys)
    known = df.where(F.col(value).isNotNull()).select(*keys, pos, value, *exog)
    ranked = position(known, keys, pos, "j")
    sized = with_totals(
        ranked,
        keys,
        "j",
        {"_n": F.count(F.lit(1)), "mean": F.avg(value), "_sd": F.stddev_pop(value)},
    )
    spread = F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(F.lit(1.0))
    rows = sized.select(
        *keys, pos, "j", "_n", "mean", spread.alias("sd"), ((F.col(value) - F.col("mean")) / spread).alias("z"), *exog
    )
    bound = known_bound(rows, "j")
    reach = long_order(bound) if bound else LONG_AR_CAP

    def design(values, start, stop, offset, total):
        m = long_order(total)
        begin = max(start, m - offset)
        if begin >= stop:
            return {}
        y = values["z"]
        return {0: np.column_stack([np.ones(stop - begin), lags(y, begin, stop, m), y[begin:stop]])}

    def fit(data: Summed) -> pd.DataFrame:
        coef = None
        if 0 in data.grams:
            gram = data.grams[0]
            found = solve(gram, range(len(gram) - 1), len(gram) - 1, int(round(gram[0, 0])))
            coef = None if found is None else found.coef.tolist()
        return pd.DataFrame({"_ar": [coef]})

    fits = lagged_fit(rows, keys, "j", ["z"], reach, design, fit, "_ar array<double>", size=size)
    cut = Cut(rows, keys, "j", before=reach, size=size)
    before = F.collect_list("z").over(cut.window.rowsBetween(-reach, -1))
    lagged = cut.own(cut.rows.withColumn("_before", before))
    slopes = F.slice("_ar", 2, F.greatest(F.size("_ar") - 1, F.lit(1)))
    guess = F.element_at("_ar", 1) + dot(F.reverse("_before"), slopes)
    ready = F.col("_ar").isNotNull() & (F.col("j") >= F.size("_ar") - 1)
    return match(lagged, fits, keys, "left").select(
        *keys,
        pos,
        "j",
        F.col("_n").alias("n"),
        "mean",
        "sd",
        "z",
        F.when(ready, F.col("z") - guess).alias("e"),
        *exog,
    )


def _terms(p: int, q: int, season: int, exog: Sequence[str]) -> list[str]:
    names = ["const", *[f"ar_{h}" for h in range(1, p + 1)], *[f"ma_{h}" for h in range(1, q + 1)]]
    if season:
        names += [f"ar_{season}", f"ma_{season}"]
    return names + list(exog)


def arma_grid(
    shocks: DataFrame,
    keys: Sequence[str],
    p: Sequence[int],
    q: Sequence[int],
    seasons: Sequence[int] = (0,),
    exog: Sequence[str] = (),
    size: int | None = None,
) -> DataFrame:
    """(keys, season, p, q, n, rss, aic, bic, lb_q, lb_p, terms, coef, se) for every order.

    Takes :func:`innovations`.  One cross-product matrix with all lags on one
    common sample serves the whole grid; a second one, against the row before,
    gives each order's Ljung-Box statistic.  Season 0 means none; an order that
    cannot be fitted has a missing AIC.
    """
    keys, exog, seasons = list(keys), list(exog), list(seasons)
    top_p, top_q = max(p), max(q)
    longest = max([top_p, top_q, *seasons, 1])
    real = [s for s in seasons if s]
    rows = shocks.withColumnRenamed("n", "_n")

    def matrix(values, start, stop):
        y, e = values["z"], values["e"]
        columns = [np.ones((stop - start, 1)), lags(y, start, stop, top_p), lags(e, start, stop, top_q)]
        for s in real:
            columns += [y[start - s : stop - s, None], e[start - s : stop - s, None]]
        columns += [values[x][start:stop, None] for x in exog]
        return np.hstack([*columns, y[start:stop, None]])

    def design(values, start, stop, offset, total):
        first = long_order(total) + longest
        begin = max(start, first - offset)
        if begin >= stop:
            return {}
        now = matrix(values, begin, stop)
        good = ~np.isnan(now).any(axis=1)
        out = {0: now[good]}
        later = max(begin, first + 1 - offset)
        if later < stop:
            a, b = matrix(values, later, stop), matrix(values, later - 1, stop - 1)
            both = ~(np.isnan(a).any(axis=1) | np.isnan(b).any(axis=1))
            out[LAGGED[0]] = (a[both], b[both])
        return out

    def fit(data: Summed) -> pd.DataFrame:
        gram, shifted = data.grams.get(0), data.grams.get(LAGGED[0])
        sd = float(data.first["sd"])
        out = []
        for s in seasons:
            for i in p:
                for k in q:
                    row = {"season": s, "p": i, "q": k, "n": 0, "terms": _terms(i, k, s, exog)}
                    row.update(rss=np.nan, aic=np.nan, bic=np.nan, lb_q=np.nan, lb_p=np.nan)
                    row.update(coef=None, se=None)
                    out.append(row)
                    if gram is None:
                        continue
                    used = [0, *range(1, i + 1), *range(1 + top_p, 1 + top_p + k)]
                    if s:
                        at = 1 + top_p + top_q + 2 * real.index(s)
                        used += [at, at + 1]
                    last = len(gram) - 1
                    used += range(last - len(exog), last)
                    n = int(round(gram[0, 0]))
                    found = solve(gram, used, last, n)
                    if found is None:
                        continue
                    shift = n * np.log(sd * sd)
                    row.update(n=n, rss=found.rss * sd * sd, aic=found.aic + shift, bic=found.bic + shift)
                    row.update(coef=found.coef.tolist(), se=found.se.tolist())
                    if shifted is not None and found.rss > 0:
                        v = np.zeros(last + 1)
                        v[used] = -found.coef
                        v[last] = 1.0
                        r1 = float(v @ shifted @ v) / found.rss
                        row["lb_q"] = n * (n + 2) * r1 * r1 / (n - 1)
                        row["lb_p"] = float(chi2_sf(row["lb_q"], 1.0))
        return pd.DataFrame(out)

    extra = (
        "season int, p int, q int, n bigint, rss double, aic double, bic double, lb_q double, "
        "lb_p double, terms array<string>, coef array<double>, se array<double>"
    )
    found = lagged_fit(
        rows,
        keys,
        "j",
        ["z", "e", *exog],
        longest + 1,
        design,
        fit,
        extra,
        carry=["sd"],
        size=size,
    )
    return to_null(found, "rss", "aic", "bic", "lb_q", "lb_p")


def best_spec(table: DataFrame, keys: Sequence[str], by: str = "aic") -> DataFrame:
    """The row with the lowest score per key; failed fits never win, simpler orders win ties."""
    others = [c for c in table.columns if c not in keys]
    rank = F.struct(by, "p", "q", "season") if "p" in others else F.struct(by)
    picked = table.where(F.col(by).isNotNull()).groupBy(*keys).agg(
        F.min_by(F.struct(*others), rank).alias("_b")
    )
    return picked.select(*keys, "_b.*")


def fit_summary(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, season, p, q, term, coef, se, t_value, n, rss, aic, bic): one row per term."""
    zipped = F.explode(F.arrays_zip("terms", "coef", "se")).alias("_t")
    spec = ["season", "p", "q", "n", "rss", "aic", "bic"]
    return table.where(F.col("coef").isNotNull()).select(*keys, *spec, zipped).select(
        *keys,
        *spec,
        F.col("_t.terms").alias("term"),
        F.col("_t.coef").alias("coef"),
        F.col("_t.se").alias("se"),
        (F.col("_t.coef") / F.nullif(F.col("_t.se"), F.lit(0.0))).alias("t_value"),
    )


def spec_grid(
    series: DataFrame, keys: Sequence[str], p: Sequence[int], q: Sequence[int], seasons: Sequence[int] = (0,)
) -> DataFrame:
    """Every series with every order: the grid as a table."""
    grid = series.select(*keys).distinct()
    for name, values in (("season", seasons), ("p", p), ("q", q)):
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(int(v)) for v in values])))
    return grid


def _weights(terms, coef):
    """Lag → coefficient of the autoregressive and of the moving-average part."""
    ar, ma = {}, {}
    for term, c in zip(terms, coef):
        kind, _, lag = term.partition("_")
        if lag.isdigit() and kind in ("ar", "ma"):
            part = ar if kind == "ar" else ma
            part[int(lag)] = part.get(int(lag), 0.0) + c
    return ar, ma


def shock_weights(ar, ma, steps: int) -> np.ndarray:
    psi = np.zeros(steps)
    for k in range(steps):
        psi[k] = 1.0 if k == 0 else ma.get(k, 0.0) + sum(
            c * psi[k - h] for h, c in ar.items() if h <= k
        )
    return psi


def continue_series(z, e, ar, ma, const, extra, steps: int) -> np.ndarray:
    """Continue a series: known lags first, then its own predictions; future shocks are zero."""
    z, e = list(z), list(e)
    for k in range(steps):
        total = const + extra[k]
        total += sum(c * z[-h] for h, c in ar.items() if h <= len(z))
        total += sum(c * e[-h] for h, c in ma.items() if h <= len(e))
        z.append(total)
        e.append(0.0)
    return np.array(z[len(z) - steps :])


def arma_forecast(
    shocks: DataFrame,
    specs: DataFrame,
    keys: Sequence[str],
    horizon: int | DataFrame,
    future: DataFrame | None = None,
    exog: Sequence[str] = (),
) -> DataFrame:
    """(keys, step, mean, lower, upper) from the last rows of each series.

    ``specs`` has one fitted order per key; ``horizon`` is a number or a table
    (keys, horizon); ``future`` gives (keys, step, exog) where the fit used any.
    Only the rows the longest lag reaches travel to the recursion.
    """
    keys, exog = list(keys), list(exog)
    lag_of = F.transform(
        "terms", lambda t: F.coalesce(F.try_to_number(F.regexp_extract(t, r"^(?:ar|ma)_(\d+)$", 1), F.lit("999999")).cast("int"), F.lit(0))
    )
    wanted = specs.withColumn("_reach", F.greatest(F.array_max(lag_of), F.lit(1)))
    if isinstance(horizon, DataFrame):
        wanted = match(wanted, horizon.select(*keys, "horizon"), keys)
    else:
        wanted = wanted.withColumn("horizon", F.lit(horizon))
    if future is not None:
        steps = future.groupBy(*keys).agg(
            F.sort_array(F.collect_list(F.struct("step", F.array(*exog).alias("x")))).alias("_next")
        )
        wanted = match(wanted, steps, keys, "left")
    model = [*keys, "terms", "coef", "rss", F.col("n").alias("_fit_n"), "_reach", "horizon"]
    if future is not None:
        model.append("_next")
    tail = match(shocks.select(*keys, "j", "n", "mean", "sd", "z", "e"), wanted.select(*model), keys)
    tail = tail.where(F.col("j") >= F.col("n") - F.col("_reach"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("j", ignore_index=True)
        row = pdf.iloc[0]
        steps = int(row["horizon"])
        terms, coef = list(row["terms"]), np.asarray(row["coef"], float)
        ar, ma = _weights(terms, coef)
        extra = np.zeros(steps)
        if future is not None and row["_next"] is not None:
            x = np.array([np.asarray(s["x"], float) for s in row["_next"]][:steps])
            extra[: len(x)] = x @ coef[len(coef) - len(exog) :]
        z = continue_series(pdf["z"], pdf["e"].fillna(0.0), ar, ma, coef[0], extra, steps)
        sigma = np.sqrt(row["rss"] / max(row["_fit_n"] - len(coef), 1))
        half = Z95 * sigma * np.sqrt(np.cumsum(shock_weights(ar, ma, steps) ** 2))
        mean = row["mean"] + row["sd"] * z
        return pd.DataFrame(
            {"step": np.arange(1, steps + 1), "mean": mean, "lower": mean - half, "upper": mean + half}
        ).astype({"step": "int32"})

    return per_group(tail, keys, keys, "step int, mean double, lower double, upper double", run)


def in_sample_predict(
    shocks: DataFrame,
    specs: DataFrame,
    keys: Sequence[str],
    pos: str,
    dynamic_last: int = 260,
    reach: int = 104,
    size: int | None = None,
) -> DataFrame:
    """(keys, pos, j, actual, mean, lower, upper): one step ahead, dynamic over the last rows.

    One-step predictions join the coefficients to each row's own lags.  From
    ``n - dynamic_last`` on a prediction feeds the next one; only that tail and the
    lags before it are gathered per series.
    """
    keys = list(keys)

    def number(term, kind: str):
        digits = F.regexp_extract(term, rf"^{kind}_(\d+)$", 1)
        return F.try_to_number(digits, F.lit("999999")).cast("int")

    paired = F.arrays_zip("terms", "coef")
    longest = F.array_max(
        F.transform("terms", lambda t: F.coalesce(number(t, "ar"), number(t, "ma"), F.lit(0)))
    )
    checked = F.when(longest <= reach, F.col("coef")).otherwise(
        F.raise_error(F.lit(f"an order reaches further back than {reach} rows")).cast("array<double>")
    )

    def part(kind: str):
        chosen = F.filter(paired, lambda t: number(t["terms"], kind).isNotNull())
        return F.transform(
            chosen, lambda t: F.struct(number(t["terms"], kind).alias("h"), t["coef"].alias("c"))
        )

    model = specs.where(F.col("coef").isNotNull()).select(
        *keys,
        "terms",
        checked.alias("coef"),
        F.col("rss").alias("_rss"),
        F.col("n").alias("_fit_n"),
        part("ar").alias("_arp"),
        part("ma").alias("_map"),
    )
    cut = Cut(shocks.select(*keys, pos, "j", "n", "mean", "sd", "z", "e"), keys, "j", before=reach, size=size)
    back = cut.window.rowsBetween(-reach, -1)
    rows = cut.own(
        cut.rows.withColumns(
            {
                "_zb": F.reverse(F.collect_list("z").over(back)),
                "_eb": F.reverse(F.collect_list(F.coalesce("e", F.lit(0.0))).over(back)),
            }
        )
    )
    joined = match(rows, model, keys)

    def pull(weights: str, past: str):
        terms = F.transform(
            weights, lambda w: w["c"] * F.coalesce(F.get(F.col(past), w["h"] - 1), F.lit(0.0))
        )
        return F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)

    guess = F.element_at("coef", 1) + pull("_arp", "_zb") + pull("_map", "_eb")
    sigma = F.sqrt(F.col("_rss") / F.greatest(F.col("_fit_n") - F.size("coef"), F.lit(1)))
    half = F.lit(Z95) * sigma
    mean = F.col("mean") + F.col("sd") * guess
    actual = F.col("mean") + F.col("sd") * F.col("z")
    single = joined.where(F.col("j") < F.col("n") - dynamic_last).select(
        *keys, pos, "j", actual.alias("actual"), mean.alias("mean"), (mean - half).alias("lower"), (mean + half).alias("upper")
    )
    slim = shocks.select(*keys, pos, "j", "n", "mean", "sd", "z", "e")
    tail = match(slim, model.select(*keys, "terms", "coef", "_rss", "_fit_n"), keys)
    tail = tail.where(F.col("j") >= F.col("n") - dynamic_last - reach)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("j", ignore_index=True)
        row = pdf.iloc[0]
        start = int((pdf["j"] < row["n"] - dynamic_last).sum())
        steps = len(pdf) - start
        coef = np.asarray(row["coef"], float)
        ar, ma = _weights(list(row["terms"]), coef)
        past = pdf["e"].fillna(0.0)[:start]
        z = continue_series(pdf["z"][:start], past, ar, ma, coef[0], np.zeros(steps), steps)
        spread = np.sqrt(row["_rss"] / max(row["_fit_n"] - len(coef), 1))
        wide = Z95 * spread * np.sqrt(np.cumsum(shock_weights(ar, ma, steps) ** 2))
        centre = row["mean"] + row["sd"] * z
        return pd.DataFrame(
            {
                pos: pdf[pos][start:].to_numpy(),
                "j": pdf["j"][start:].to_numpy(),
                "actual": row["mean"] + row["sd"] * pdf["z"][start:].to_numpy(),
                "mean": centre,
                "lower": centre - wide,
                "upper": centre + wide,
            }
        )

    extra = f"`{pos}` bigint, j bigint, actual double, mean double, lower double, upper double"
    dynamic = per_group(tail, keys, keys, extra, run)
    return single.unionByName(dynamic)
