"""Maximum-likelihood ARMA orders for every series, by an exact filter that works in blocks.

All orders of a series are searched side by side: each round evaluates the points that all
searches ask for in one pass over the series.  A series of up to ``LOCAL_ROWS`` rows is
searched within a task (one for each autoregressive order).  A longer one stays in blocks:
every round its blocks are summarised apart for all points, joined in order through the
small states that they hand on, and the searches, kept as a table, go one step on.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.functions.grouped import key_schema
from loomcast.functions.joins import attach
from loomcast.functions.kalman import Block, Search, gains, joined, log_likelihood, product, stationary, summarised
from loomcast.session import settle

#: Rows of a series that one task searches as a whole, and rows of a block of a longer one.
LOCAL_ROWS, BLOCK_ROWS = 20_000, 20_000
#: Steps of a search at most; the status tells where it was not enough.
ROUNDS = 80


#: p, q, seasonal p, seasonal q, season (0: none).
Order = tuple[int, int, int, int, int]


def _coefficients(orders: Sequence[Order], points: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phi, theta, mean) of all points of all orders, multiplied out and padded with zeros to the longest."""
    parts = []
    for (p, q, sp, sq, season), own in zip(orders, points):
        cuts = np.cumsum([0, p, q, sp, sq])
        ar, ma, seasonal_ar, seasonal_ma = (stationary(own[:, a:b]) for a, b in zip(cuts, cuts[1:]))
        parts.append((product(ar, seasonal_ar, season, -1), product(-ma, -seasonal_ma, season, 1), own[:, -1]))
    top = [max((x[k].shape[1] for x in parts), default=0) for k in (0, 1)]
    wide = [np.concatenate([np.pad(x[k], ((0, 0), (0, top[k] - x[k].shape[1]))) for x in parts]) for k in (0, 1)]
    return wide[0], wide[1], np.concatenate([x[2] for x in parts])


def _lags(short: int, many: int, season: int) -> list[int]:
    """The lags that a product of a short and a seasonal polynomial can have."""
    return sorted({i + k * season for i in range(short + 1) for k in range(many + 1)} - {0})


def _start(z: np.ndarray, order: Order) -> np.ndarray:
    """Partial autocorrelations of the series, no other terms, the mean of a standardised series."""
    p = order[0]
    x, n = z - z.mean(), len(z)
    r = np.array([x[: n - h] @ x[h:] for h in range(p + 1)]) / max(x @ x, 1e-300)
    out, phi = np.zeros(sum(order[:4]) + 1), np.zeros(0)
    for k in range(p):
        rest = 1 - phi @ r[1 : k + 1]
        own = float(np.clip((r[k + 1] - phi @ r[k:0:-1]) / max(rest, 1e-12), -0.95, 0.95))
        phi = np.append(phi - own * phi[::-1], own)
        out[k] = own / np.sqrt(1 - own * own)
    return out


FITTED = (
    "season int, p int, q int, sp int, sq int, n bigint, loglik double, rss double, aic double, bic double, "
    "terms array<string>, coef array<double>, status string"
)


def _row(search: Search, order: Order, n: int, sd: float, squares: float) -> tuple:
    p, q, sp, sq, season = order
    phi, theta, mean = _coefficients([order], [search.x[None, :]])
    loglik = float(search.value) - n * np.log(sd)  # of the series in its own unit
    k = sum(order[:4]) + 2  # the mean and the shocks' variance, too
    ar, ma = _lags(p, sp, season), _lags(q, sq, season)
    terms = ["const", *[f"ar_{h}" for h in ar], *[f"ma_{h}" for h in ma]]
    coef = [float(mean[0] * (1 - phi[0].sum())), *[float(phi[0, h - 1]) for h in ar], *[float(theta[0, h - 1]) for h in ma]]
    status = "ok" if search.left > 0 else "not converged"
    return season, p, q, sp, sq, n, loglik, squares * sd * sd, -2 * loglik + 2 * k, -2 * loglik + k * np.log(n), terms, coef, status


def _searched(z: np.ndarray, orders: Sequence[Order], sd: float, rounds: int) -> pd.DataFrame:
    """The best fit of every order to one series."""
    searches = [Search(_start(z, o), rounds) for o in orders]

    def value(points) -> tuple[np.ndarray, np.ndarray]:
        phi, theta, mean = _coefficients(*points)
        squares, logs, rows = joined([summarised(z, 0, mean, gains(phi, theta))])
        return log_likelihood(squares, logs, rows), squares

    while open_ := [(o, s) for o, s in zip(orders, searches) if not s.done]:
        found, _ = value(([o for o, _ in open_], [s.points for _, s in open_]))
        at = 0
        for _, s in open_:
            size = len(s.points)
            s.tell(found[at : at + size])
            at += size
    _, squares = value((orders, [s.x[None, :] for s in searches]))
    rows = [_row(s, o, len(z), sd, own) for o, s, own in zip(orders, searches, squares)]
    return pd.DataFrame(rows, columns=[c.split()[0] for c in FITTED.split(", ")])


def likelihood_grid(
    shocks: DataFrame,
    keys: Sequence[str],
    p: Sequence[int],
    q: Sequence[int],
    seasonal: Sequence[tuple[int, int, int]] = ((0, 0, 0),),
    rounds: int = ROUNDS,
) -> DataFrame:
    """(keys, season, p, q, sp, sq, n, loglik, rss, aic, bic, terms, coef, status) of every order.

    ``seasonal`` lists (sp, sq, season): the short and the seasonal polynomials are multiplied,
    so a coefficient at a lag such as season + 1 follows from the two that make it.

    Takes the ``z``, ``j``, ``n`` and ``sd`` columns of :func:`loomcast.operators.arma.innovations`.
    The likelihood is that of all rows from a stationary start, with a mean and the shocks'
    variance fitted too, in the unit of the series: values compare across orders and with
    other exact fits.  A search that used up its rounds says "not converged"; a constant
    series and one with no more rows than numbers to fit say "not fitted" and have NULLs.
    The result serves :func:`arma_forecast` and :func:`in_sample_predict` as their fits.
    """
    keys = list(keys)
    slim = shocks.select(*keys, "j", "n", "z", "sd")
    shape = key_schema(shocks, keys, FITTED)
    orders: list[Order] = [(int(a), int(b), *s) for a in p for b in q for s in seasonal]

    def none(n: int, own) -> pd.DataFrame:
        rows = [(o[4], *o[:4], n, None, None, None, None, None, None, "not fitted") for o in own]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in FITTED.split(", ")])

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("j", ignore_index=True)
        z, sd, first = pdf["z"].to_numpy(), float(pdf["sd"].iloc[0]), int(pdf["_p"].iloc[0])
        own = [o for o in orders if o[0] == first]
        fit = [o for o in own if len(z) > sum(o[:4]) + 2 + o[4] * max(o[2:4]) and np.ptp(z) > 0]
        parts = [_searched(z, fit, sd, rounds)] if fit else []
        parts += [none(len(z), [o for o in own if o not in fit])] if len(fit) < len(own) else []
        return _keyed(pd.concat(parts, ignore_index=True), pdf, keys, shape.names)

    short = slim.where(F.col("n") <= LOCAL_ROWS).withColumn("_p", F.explode(F.array(*[F.lit(int(a)) for a in p])))
    spread = short.repartition(4 * shocks.sparkSession.sparkContext.defaultParallelism, *keys, "_p")
    found = spread.groupBy(*keys, "_p").applyInPandas(search, shape)
    long = slim.where(F.col("n") > LOCAL_ROWS)
    return found if long.isEmpty() else found.unionByName(_blocked_grid(long, keys, orders, rounds, shape))


def _keyed(out: pd.DataFrame, pdf: pd.DataFrame, keys: Sequence[str], names: Sequence[str]) -> pd.DataFrame:
    for k in keys:
        out[k] = pd.Series([pdf[k].iloc[0]] * len(out), index=out.index, dtype=object)
    return out[list(names)]


def _summaries(rows: DataFrame, asked: DataFrame, keys: Sequence[str], points) -> DataFrame:
    """(keys, name, _blk, block): every block summarised for the points of each row of ``asked`` (keys, name, state)."""
    keys = list(keys)
    blocked = rows.withColumn("_blk", F.floor(F.col("j") / F.lit(BLOCK_ROWS)).cast("long"))
    per_key = blocked.groupBy(*keys).agg(F.collect_set("_blk").alias("_blk"))
    # new names for the keys: both sides may come from one table
    asked = asked.select(*[F.col(k).alias(k) for k in keys], "name", "state")
    dealt = attach(asked, per_key, keys, "inner").withColumn("_blk", F.explode("_blk"))
    shape = key_schema(rows, keys, "name string, _blk bigint, block binary")

    def run(pdf: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("j", ignore_index=True)
        out = []
        for name, state in zip(states["name"], states["state"]):
            phi, theta, mean = points(state)
            block = summarised(pdf["z"].to_numpy(), int(pdf["j"].iloc[0]), mean, gains(phi, theta))
            out.append((name, int(pdf["_blk"].iloc[0]), pickle.dumps(block)))
        out = pd.DataFrame(out, columns=["name", "_blk", "block"]).astype({"name": object})
        return _keyed(out, pdf, keys, shape.names)

    by = [*keys, "_blk"]
    return blocked.groupBy(*by).cogroup(dealt.groupBy(*by)).applyInPandas(run, shape)


def _joined(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    blocks: list[Block] = [pickle.loads(raw) for raw in pdf.sort_values("_blk")["block"]]
    return joined(blocks)


def _points(state: bytes):
    search, order = pickle.loads(state)
    return _coefficients([order], [search.points if not search.done else search.x[None, :]])


def _blocked_grid(rows: DataFrame, keys: list[str], orders: list[Order], rounds: int, shape) -> DataFrame:
    rows = settle(rows)
    # autocorrelations of the first block give the searches their start
    head = rows.where(F.col("j") < BLOCK_ROWS)
    states_shape = key_schema(rows, keys, "name string, n bigint, sd double, state binary, open boolean")

    def begin(pdf: pd.DataFrame) -> pd.DataFrame:
        z = pdf.sort_values("j")["z"].to_numpy()
        n, sd = int(pdf["n"].iloc[0]), float(pdf["sd"].iloc[0])
        out = [(str(o), n, sd, pickle.dumps((Search(_start(z, o), rounds), o)), True) for o in orders]
        out = pd.DataFrame(out, columns=["name", "n", "sd", "state", "open"]).astype({"name": object})
        return _keyed(out, pdf, keys, states_shape.names)

    def step(pdf: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or states.empty or not states["open"].iloc[0]:
            return states[states_shape.names]
        search, order = pickle.loads(states["state"].iloc[0])
        search.tell(log_likelihood(*_joined(pdf)))
        out = states.assign(state=[pickle.dumps((search, order))], open=[not search.done])
        return out[states_shape.names].astype({"name": object})

    def end(pdf: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        search, order = pickle.loads(states["state"].iloc[0])
        squares, _, n = _joined(pdf)
        row = _row(search, order, n, float(states["sd"].iloc[0]), float(squares[0]))
        return _keyed(pd.DataFrame([row], columns=[c.split()[0] for c in FITTED.split(", ")]), states, keys, shape.names)

    by = [*keys, "name"]
    states = settle(head.groupBy(*keys).applyInPandas(begin, states_shape))
    while not states.where("open").isEmpty():
        blocks = _summaries(rows, states.where("open"), keys, _points)
        states = settle(blocks.groupBy(*by).cogroup(states.groupBy(*by)).applyInPandas(step, states_shape))
    blocks = _summaries(rows, states, keys, _points)
    return settle(blocks.groupBy(*by).cogroup(states.groupBy(*by)).applyInPandas(end, shape))


def arma_log_likelihood(shocks: DataFrame, parameters: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n, loglik) at given parameters (keys, phi array, theta array, mean), each series in blocks.

    ``mean`` belongs to the standardised series, as the coefficients do; the likelihood is
    in the unit of the series and at the best variance of the shocks.
    """
    keys = list(keys)
    packed = F.to_json(F.struct("phi", "theta", "mean")).cast("binary").alias("state")
    asked = parameters.select(*keys, F.lit("given").alias("name"), packed)

    def points(state: bytes):
        import json

        told = json.loads(state)
        return tuple(np.array([told[c]], dtype=float).reshape(1, -1) for c in ("phi", "theta")) + (np.array([told["mean"]], dtype=float),)

    shape = key_schema(shocks, keys, "n bigint, loglik double")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        squares, logs, n = _joined(pdf)
        out = pd.DataFrame({"n": [n], "loglik": log_likelihood(squares, logs, n)})
        return _keyed(out, pdf, keys, shape.names)

    found = _summaries(shocks.select(*keys, "j", "z"), asked, keys, points).groupBy(*keys).applyInPandas(run, shape)
    unit = shocks.groupBy(*keys).agg(F.log(F.max("sd")).alias("_unit"))
    return attach(found, unit, keys).withColumn("loglik", F.col("loglik") - F.col("n") * F.col("_unit")).drop("_unit")
