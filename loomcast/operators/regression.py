"""Folds, ridge and lasso with cross-validation from per-fold cross-products."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.functions.blocks import position, with_totals
from loomcast.functions.gram import dot, row_gram, square
from loomcast.functions.grouped import per_group
from loomcast.functions.joins import attach, match
from loomcast.session import settle

# The penalty grids to search.
LASSO_ALPHAS = (1e-8, 1e-5, 1e-4, 1e-3, 1e-2, 1e-1, 1.0, 10.0)
RIDGE_ALPHAS = (1e-8, 1e-5, 1e-4, 1e-3, 1e-2, 1e-1, 1.0, 3.0, 5.0, 10.0)


def _contiguous(i: Column, n: Column, k: int) -> Column:
    size, longer = F.floor(n / F.lit(k)), n % k
    edge = longer * (size + 1)
    late = F.floor((i - edge) / F.nullif(size, F.lit(0))) + longer
    return F.when(i < edge, F.floor(i / (size + 1))).otherwise(late).cast("int")


def _segment(i: Column, n: Column, k: int) -> Column:
    size = F.floor(n / F.lit(k + 1))
    start = n - size * k
    later = F.floor((i - start) / F.nullif(size, F.lit(0))) + 1
    return F.when(i < start, F.lit(0)).otherwise(later).cast("int")


def kfold_contiguous(
    df: DataFrame, keys: Sequence[str], pos: str, k: int = 5, out: str = "fold"
) -> DataFrame:
    """Unshuffled blocks; the first ``n mod k`` are one row longer."""
    sized = with_totals(df, keys, pos, {"_rows": F.count(F.lit(1))})
    return sized.withColumn(out, _contiguous(F.col(pos), F.col("_rows"), k)).drop("_rows")


def time_segments(
    df: DataFrame, keys: Sequence[str], pos: str, k: int = 5, out: str = "segment"
) -> DataFrame:
    """Tag each row with its segment 0 … k: fold f trains on segments up to f and tests f + 1.

    The same folds as :func:`time_series_folds` without a copy of a row per fold.
    """
    sized = with_totals(df, keys, pos, {"_rows": F.count(F.lit(1))})
    return sized.withColumn(out, _segment(F.col(pos), F.col("_rows"), k)).drop("_rows")


def time_series_folds(
    df: DataFrame, keys: Sequence[str], pos: str, k: int = 5
) -> DataFrame:
    """Expanding window: every row once per fold it belongs to, with ``fold`` and ``role``."""
    sized = with_totals(df, keys, pos, {"_rows": F.count(F.lit(1))})
    cut = sized.withColumn("_seg", _segment(F.col(pos), F.col("_rows"), k))
    first = F.greatest(F.col("_seg") - 1, F.lit(0))
    folds = F.sequence(first, F.lit(k - 1))
    role = F.when(F.col("_seg") <= F.col("fold"), F.lit("train")).otherwise(F.lit("test"))
    exploded = cut.withColumn("fold", F.explode(folds))
    return exploded.withColumn("role", role).drop("_rows", "_seg")


#: Duality gap, as a share of half the target's second moment, up to which a lasso fit counts as solved.
GAP = 1e-8


def lasso_gap(gram: np.ndarray, cross: np.ndarray, square: float, alpha: float, w: np.ndarray) -> float:
    """How far at most the objective of ``w`` lies above the best one.

    The residual, shrunk until no column's product with it exceeds the penalty, is a
    feasible point of the dual problem; everything follows from the moments.
    """
    pull = cross - gram @ w
    left = square - 2 * cross @ w + w @ gram @ w
    share = min(1.0, alpha / max(np.abs(pull).max(initial=0.0), 1e-300))
    rest = square - 2 * share * (square - cross @ w) + share * share * left
    return max(0.0, left / 2 + alpha * np.abs(w).sum() - (square - rest) / 2)


def _lasso(gram: np.ndarray, cross: np.ndarray, square: float, alpha: float, start: np.ndarray) -> tuple[np.ndarray, float]:
    """(coefficients, duality gap) for X'X/n, X'y/n and y'y/n, by an active set.

    The column that breaks its condition most joins the active set; the equations of the
    active columns under their signs are solved at once, and where a coefficient would
    change its sign on the way, the best of these points is taken and it leaves.
    """
    w, p = start.copy(), len(start)
    usable = np.diagonal(gram) > 1e-14
    ridge = 1e-13 * max(float(np.diagonal(gram).max(initial=0.0)), 1e-300)
    w[~usable] = 0.0

    def worth(v: np.ndarray, rows: np.ndarray) -> float:
        own = v[rows]
        return 0.5 * own @ gram[np.ix_(rows, rows)] @ own - cross[rows] @ own + alpha * np.abs(own).sum()

    sign = np.sign(w)
    for _ in range(20 * p + 20):
        pull = cross - gram @ w
        outside = np.where((w == 0) & usable, np.abs(pull) - alpha, -np.inf)
        held = np.abs(pull - alpha * np.sign(w))[w != 0].max(initial=0.0)
        slack = 1e-12 * max(alpha, float(np.abs(cross).max(initial=0.0)))
        if p and outside.max() > slack:
            new = int(np.argmax(outside))
            sign[new] = np.sign(pull[new])
        elif held <= slack:
            break
        for _ in range(p + 1):
            rows = np.flatnonzero(sign)
            if not len(rows):
                break
            aim = np.zeros(p)
            aim[rows] = np.linalg.solve(gram[np.ix_(rows, rows)] + ridge * np.eye(len(rows)), cross[rows] - alpha * sign[rows])
            turning = rows[(w[rows] != 0) & (np.sign(aim[rows]) != np.sign(w[rows]))]
            if not len(turning):
                w = aim
                # a new column that does not move to its side is no use now
                sign = np.sign(w)
                break
            shares = np.sort(w[turning] / (w[turning] - aim[turning]))
            points = [w + t * (aim - w) for t in (*shares, 1.0)]
            for point, t in zip(points, shares):
                point[turning[np.isclose(w[turning] / (w[turning] - aim[turning]), t, rtol=1e-12, atol=0)]] = 0.0
            best = min(points, key=lambda v: worth(v, rows))
            w, sign = best, np.sign(best)
        # rounding can stop progress on columns that depend on each other: the gap tells
        if lasso_gap(gram, cross, square, alpha, w) <= 1e-4 * GAP * square / 2:
            break
    return w, lasso_gap(gram, cross, square, alpha, w)


def _moments(gram: np.ndarray):
    """Row count, means and centred cross-products of [1, x…, y]."""
    n = gram[0, 0]
    means = gram[0, 1:] / n
    return n, means, gram[1:, 1:] / n - np.outer(means, means)


def penalised_path(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    features: Sequence[str],
    target: str,
    kind: str = "lasso",
    alphas: Sequence[float] = LASSO_ALPHAS,
    folds: int = 5,
    time_series: bool = True,
    leaky: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(rows with fold parts, coefficient table) for every fold and penalty.

    The table has (keys, fold, alpha, intercept, coef, std_coef, unit, gap), fold -1 being
    the fit on all rows.  ``gap`` is a lasso's duality gap as a share of half the target's
    second moment (0 for ridge, which is solved directly).  A train matrix is the total less its test part, or the sum of the
    parts before it, so one pass over the rows serves all folds and penalties.
    Features are standardised on the train part (on all rows with ``leaky``).
    """
    keys, features = list(keys), list(features)
    slim = df.select(*keys, pos, *features, target).na.drop(subset=[*features, target])
    ranked = position(slim, keys, pos, "_j")
    totals = {"_rows": F.count(F.lit(1))}
    for c in [*features, target]:
        totals[f"_m_{c}"] = F.avg(c)
        totals[f"_s_{c}"] = F.stddev_pop(c)
    sized = with_totals(ranked, keys, "_j", totals)
    part = _segment if time_series else _contiguous
    scaled = {}
    for k, c in enumerate([*features, target]):
        spread = F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(F.lit(1.0))
        scaled[f"_z{k}"] = (F.col(c) - F.col(f"_m_{c}")) / spread
    names = list(scaled)
    rows = sized.select(
        *keys,
        pos,
        "_j",
        part(F.col("_j"), F.col("_rows"), folds).alias("_part"),
        F.lit(1.0).alias("_one"),
        *[e.alias(name) for name, e in scaled.items()],
        F.when(F.col(f"_s_{target}") > 0, F.col(f"_s_{target}")).otherwise(F.lit(1.0)).alias("_ys"),
    )
    grams = row_gram(rows, [*keys, "_ys"], "_part", ["_one", *names], "_j")
    p = len(features)

    def paths(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = {int(k): square(g) for k, g in pdf.groupby("_part")}
        fold = int(pdf["fold"].iloc[0])
        total = sum(parts.values())
        if fold < 0:
            gram = total
        elif time_series:
            gram = sum((g for k, g in parts.items() if k <= fold), np.zeros_like(total))
        else:
            gram = total - parts[fold] if fold in parts else np.zeros_like(total)
        out = []
        unit = float(pdf["_ys"].iloc[0])
        if gram[0, 0] >= 2:
            n, means, cov = _moments(gram)
            base = np.diag(_moments(total)[2] if leaky else cov)[:p]
            scale = np.sqrt(np.where(base > 1e-14, base, 1.0))
            x = cov[:p, :p] / np.outer(scale, scale)
            c = cov[:p, p] / scale
            w, gap = np.zeros(p), 0.0
            for alpha in sorted(alphas, reverse=True):
                if kind == "lasso":
                    # the target is in units of its deviation, so is the penalty
                    w, gap = _lasso(x, c, cov[p, p], alpha / unit, w)
                    gap /= max(cov[p, p] / 2, 1e-300)
                else:
                    w = np.linalg.solve(x + alpha / n * np.eye(p), c)
                coef = w / scale
                out.append((fold, alpha, means[p] - coef @ means[:p], coef.tolist(), (w * unit).tolist(), unit, gap))
        names = ["fold", "alpha", "intercept", "coef", "std_coef", "unit", "gap"]
        return pd.DataFrame(out, columns=names).astype({"fold": "int32"})

    # every fold of every key is a task of its own; all have the parts' matrices
    dealt = grams.withColumn("fold", F.explode(F.sequence(F.lit(-1), F.lit(folds - 1))))
    table = per_group(
        dealt,
        [*keys, "fold"],
        keys,
        "fold int, alpha double, intercept double, coef array<double>, std_coef array<double>, unit double, gap double",
        paths,
    )
    # few rows per key, but dear ones: written once, then read for folds and refit
    return rows, settle(table)


def penalised_cv(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    features: Sequence[str],
    target: str,
    kind: str = "lasso",
    alphas: Sequence[float] | None = None,
    folds: int = 5,
    time_series: bool = True,
    scoring: str = "mae",
    leaky: bool = False,
) -> DataFrame:
    """(keys, alpha, score, coef, gap, status): the penalty with the lowest mean fold error, refitted on all rows.

    ``coef`` belongs to standardised features and the target in its own unit.  ``gap`` is
    the largest relative duality gap among the fits of all folds and penalties that led to
    the row; above ``GAP`` the status is "not converged".
    """
    keys, features = list(keys), list(features)
    alphas = alphas or (LASSO_ALPHAS if kind == "lasso" else RIDGE_ALPHAS)
    rows, table = penalised_path(
        df, keys, pos, features, target, kind, alphas, folds, time_series, leaky
    )
    fits = (
        table.where(F.col("fold") >= 0)
        .groupBy(*keys, "fold")
        .agg(
            F.first("unit").alias("_unit"),
            F.collect_list(F.struct("alpha", "intercept", "coef")).alias("_fits"),
        )
    )
    tested = rows.withColumn("fold", F.col("_part") - (1 if time_series else 0)).where("fold >= 0")
    x = F.array(*[F.col(f"_z{k}") for k in range(len(features))])
    y = F.col(f"_z{len(features)}")

    def loss(fit: Column) -> Column:
        gap = (y - fit["intercept"] - dot(x, fit["coef"])) * F.col("_unit")
        return F.struct(
            fit["alpha"].alias("alpha"), (F.abs(gap) if scoring == "mae" else gap * gap).alias("loss")
        )

    errors = (
        match(tested, fits, [*keys, "fold"])
        .select(*keys, "fold", F.explode(F.transform("_fits", loss)).alias("_l"))
        .groupBy(*keys, "fold", "_l.alpha")
        .agg(F.avg("_l.loss").alias("_loss"))
    )
    scores = errors.groupBy(*keys, "alpha").agg(F.avg("_loss").alias("score"))
    best = scores.groupBy(*keys).agg(
        F.min(F.struct("score", "alpha")).alias("_b")
    ).select(*keys, F.col("_b.alpha").alias("alpha"), F.col("_b.score").alias("score"))
    whole = table.where("fold = -1").select(*keys, "alpha", F.col("std_coef").alias("coef"))
    gaps = table.groupBy(*keys).agg(F.max("gap").alias("gap"))
    status = F.when(F.col("gap") <= GAP, "ok").otherwise("not converged").alias("status")
    return match(match(best, whole, [*keys, "alpha"]), gaps, keys).select(*keys, "alpha", "score", "coef", "gap", status)


def selected_columns(
    fits: DataFrame, keys: Sequence[str], features: Sequence[str]
) -> DataFrame:
    """(keys, feature, coef): the columns with a coefficient other than zero."""
    names = F.array(*[F.lit(c) for c in features])
    pairs = F.explode(F.arrays_zip(names.alias("feature"), F.col("coef")))
    return (
        fits.select(*keys, pairs.alias("_p"))
        .select(*keys, F.col("_p.feature").alias("feature"), F.col("_p.coef").alias("coef"))
        .where("coef <> 0")
    )


def lasso_select(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    target: str,
    features: Sequence[str],
    alphas: Sequence[float] = LASSO_ALPHAS,
    scoring: str = "mae",
    leaky: bool = False,
) -> DataFrame:
    """Lasso with time-series folds on complete rows; keeps the columns it uses."""
    used = [c for c in features if c != target]
    fits = penalised_cv(df, keys, pos, used, target, "lasso", alphas, 5, True, scoring, leaky)
    return selected_columns(fits, keys, used)


def ridge_fit(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    target: str,
    features: Sequence[str],
    alpha: float,
) -> DataFrame:
    """(keys, intercept, coef) of (X'X + alpha I) w = X'y on the columns' own scale."""
    keys, features = list(keys), list(features)
    slim = df.select(*keys, pos, *features, target).na.drop(subset=[*features, target])
    ranked = position(slim, keys, pos, "_j")
    shift = with_totals(
        ranked, keys, "_j", {f"_m{k}": F.avg(c) for k, c in enumerate([*features, target])}
    )
    names = [f"_z{k}" for k in range(len(features) + 1)]
    rows = shift.select(
        *keys,
        "_j",
        F.lit(0).alias("_part"),
        *[(F.col(c) - F.col(f"_m{k}")).alias(names[k]) for k, c in enumerate([*features, target])],
    )
    means = shift.groupBy(*keys).agg(
        F.array(*[F.first(f"_m{k}") for k in range(len(names))]).alias("_means")
    )
    grams = row_gram(rows, keys, "_part", names, "_j")
    grams = attach(grams, means, keys)
    p = len(features)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        gram = square(pdf)
        w = np.linalg.solve(gram[:p, :p] + alpha * np.eye(p), gram[:p, p])
        mean = np.asarray(pdf["_means"].iloc[0], float)
        return pd.DataFrame({"intercept": [mean[p] - w @ mean[:p]], "coef": [w.tolist()]})

    return per_group(grams, keys, keys, "intercept double, coef array<double>", fit)
