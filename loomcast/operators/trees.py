"""Forests and boosted trees for every series at once, with grids searched per series.

The key is a dimension: each series gets its own cross-validated choice from the grid and
its own trees.  Rows are numbered per key, tagged with their fold and dealt to tasks by
(key, fold), where all trees of a fold grow together (:mod:`loomcast.functions.growing`).
A forest's depth and least split size only cut its trees back, so one set of trees for
each least leaf size scores all of them.

A series of more than ``LOCAL_ROWS`` rows is cut into blocks of rows.  Its trees grow level
by level: blocks sum (rows, weight, target) by (tree, node, feature, bin), Spark adds the
cells of all blocks, each node picks its cut from its own cells, and the new nodes go back
to the blocks.  Both ways take the same draws, cuts and limits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.functions.blocks import position, with_totals
from loomcast.functions.grouped import key_schema
from loomcast.functions.growing import SAME, Trees, draws, grow, sorted_rows, turns
from loomcast.functions.joins import attach, match
from loomcast.operators.regression import kfold_contiguous, time_segments
from loomcast.session import settle

SEED = 28

# The model grids, in the order in which equal scores are decided.
FOREST_GRID = {
    "depth": [10, 21, 32, 43, 54, 65, 76, 87, 98, 110],
    "min_leaf": [1, 2, 5, 10],
    "min_split": [2, 5, 10, 15, 100],
    "trees": [100],
}
BOOSTED_GRID = {
    "rate": [0.1, 0.2, 0.3],
    "min_leaf": [1, 2, 5, 10],
    "min_split": [2, 5, 10, 15, 100],
    "trees": [1000],
    "depth": [3],
}
LAG_FOREST_GRID = {"min_split": [2, 5, 10, 15, 100], "trees": [1000]}
DEFAULTS = {"depth": 10**6, "min_leaf": 1, "min_split": 2, "trees": 100, "rate": 1.0}

#: Rows of a series that one task takes; longer ones grow from summed cells.
LOCAL_ROWS = 200_000
#: Rows of a block of a longer series, and values a feature keeps there.
BLOCK_ROWS, BINS = 65_536, 1023
#: Rows that one prediction task takes.
PREDICT_ROWS = 500_000

SCORINGS = {"neg_mean_squared_error": np.square, "neg_mean_absolute_error": np.abs}


@dataclass(frozen=True)
class KeyedTrees:
    """Trees of every series and how their settings were chosen.

    ``nodes``: (keys, tree, node, feature, threshold, left, right, value, rows), feature -1
    at a leaf; a prediction is the sum of its leaves' values.  ``scores``: (keys, spec, its
    settings, score), ``best``: the row of each key's choice, the first of equals.  A series
    without rows in any fold has a NULL score and the first setting.
    """

    nodes: DataFrame
    scores: DataFrame
    best: DataFrame
    keys: list[str]
    features: list[str]


def expand_specs(grid: dict[str, Sequence]) -> list[dict]:
    """Every setting of a grid, missing entries at their defaults."""
    return [{**DEFAULTS, **dict(zip(grid, values))} for values in product(*grid.values())]


NODES = "tree int, node int, feature int, threshold double, left int, right int, value double, rows long"


def _node_rows(trees: Trees, number: np.ndarray, scale: float) -> pd.DataFrame:
    """Node rows of grown trees; ``number`` names the slots."""
    frame = pd.DataFrame(
        {
            "tree": number[trees.slot], "node": np.arange(len(trees.value)), "feature": trees.feature,
            "threshold": trees.threshold, "left": trees.left, "right": trees.right,
            "value": scale * trees.value, "rows": trees.rows,
        }
    )
    return frame.astype({"tree": "int32", "node": "int32", "feature": "int32", "left": "int32", "right": "int32", "rows": "int64"})


def _limits(specs: list[dict], name: str) -> np.ndarray:
    return np.array([s[name] for s in specs], dtype=np.int64)


def _forest_sums(trees: Trees, x: np.ndarray, depths: list[int], splits: list[int]) -> np.ndarray:
    """Sum over the trees of each row's value when trees are cut at every (depth, least split), [depths, splits, rows]."""
    slots = int((trees.depth == 0).sum())
    node = np.repeat(np.arange(slots)[:, None], len(x), axis=1)
    value = np.repeat(trees.value[node][None], len(splits), axis=0)
    frozen = trees.rows[node][None] < np.array(splits)[:, None, None]
    out = np.zeros((len(depths), len(splits), len(x)))
    deepest = int(trees.depth.max(initial=0))
    for d in range(deepest + 1):
        if d:
            node = trees.step(node, x)
            value = np.where(frozen, value, trees.value[node][None])
            frozen |= trees.rows[node][None] < np.array(splits)[:, None, None]
        for k, limit in enumerate(depths):
            if limit == d or d == deepest and limit > d:
                out[k] = value.sum(axis=1)
    return out


def _forest_errors(x, y, row, train, test, specs, scoring, seed) -> list[tuple[int, float]]:
    """(setting, summed error) of a fold's held-out rows for every setting of a forest grid."""
    own, order = x[train], sorted_rows(x[train])
    out = {}
    depths, splits = (sorted({s[name] for s in specs}) for name in ("depth", "min_split"))
    for leaf, count in sorted({(s["min_leaf"], s["trees"]) for s in specs}):
        sums, used = 0.0, 0
        for part in turns(count, len(own)):
            w = draws(row[train], part, seed)
            size = len(part)
            limits = (np.full(size, n) for n in (max(depths), min(splits), leaf))
            trees = grow(own, order, np.broadcast_to(y[train], (size, len(own))), w, *limits)
            sums = sums + _forest_sums(trees, x[test], depths, splits)
            used += int((w.sum(axis=1) > 0).sum())
        guess = sums / max(used, 1)
        for k, s in enumerate(specs):
            if (s["min_leaf"], s["trees"]) == (leaf, count):
                own_guess = guess[depths.index(s["depth"]), splits.index(s["min_split"])]
                out[k] = float(SCORINGS[scoring](y[test] - own_guess).sum())
    return sorted(out.items())


def _boosted(x, y, specs, visit) -> None:
    """Grow boosted trees for all settings together; ``visit(round, trees)`` sees each round's."""
    order, count = sorted_rows(x), len(specs)
    margin = np.full((count, len(x)), y.mean())
    rate = np.array([s["rate"] for s in specs])[:, None]
    limits = [_limits(specs, name) for name in ("depth", "min_split", "min_leaf")]
    ones = np.ones((count, len(x)))
    for k in range(max(s["trees"] for s in specs)):
        trees = grow(x, order, y - margin, ones, *limits)
        margin += rate * trees.value[trees.leaves(x)]
        visit(k, trees)


def _boosted_errors(x, y, row, train, test, specs, scoring, seed) -> list[tuple[int, float]]:
    out = []
    for part in turns(len(specs), int(train.sum())):
        own = [specs[k] for k in part]
        rate = np.array([s["rate"] for s in own])[:, None]
        rounds = np.array([s["trees"] for s in own])[:, None]
        guess = np.full((len(own), int(test.sum())), y[train].mean())

        def visit(k, trees):
            guess[:] += np.where(rounds > k, rate, 0.0) * trees.value[trees.leaves(x[test])]

        _boosted(x[train], y[train], own, visit)
        error = SCORINGS[scoring](y[test] - guess).sum(axis=1)
        out += zip(part.tolist(), error.tolist())
    return out


def _fitted(x, y, row, spec, kind, seed) -> pd.DataFrame:
    """Node rows of one setting on all rows."""
    if kind == "forest":
        drawn = np.concatenate([draws(row, p, seed).sum(axis=1) for p in turns(spec["trees"], len(row))]) > 0
        parts, order = [], sorted_rows(x)
        for part in turns(spec["trees"], len(row)):
            part = part[drawn[part]]
            if len(part):
                size = len(part)
                limits = (np.full(size, spec[n]) for n in ("depth", "min_split", "min_leaf"))
                trees = grow(x, order, np.broadcast_to(y, (size, len(y))), draws(row, part, seed), *limits)
                parts.append(_node_rows(trees, part, 1.0 / drawn.sum()))
        if parts:
            return pd.concat(parts, ignore_index=True)
    first = Trees(*(np.array([v]) for v in (-1, 0.0, -1, -1, y.mean(), len(y), 0, 0)))
    parts = [_node_rows(first, np.array([-1]), 1.0)]
    if kind == "boosted":
        _boosted(x, y, [spec], lambda k, trees: parts.append(_node_rows(trees, np.array([k]), spec["rate"])))
    return pd.concat(parts, ignore_index=True)


def _arrays(pdf: pd.DataFrame, features: Sequence[str], target: str):
    pdf = pdf.sort_values("_j", ignore_index=True)
    return pdf[list(features)].to_numpy(dtype=float), pdf[target].to_numpy(dtype=float), pdf["_j"].to_numpy()


def _with_keys(out: pd.DataFrame, pdf: pd.DataFrame, keys: Sequence[str], names: Sequence[str]) -> pd.DataFrame:
    for k in keys:
        out[k] = pd.Series([pdf[k].iloc[0]] * len(out), index=out.index, dtype=object)
    return out[list(names)]


def train_trees(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    features: Sequence[str],
    target: str,
    grid: dict[str, Sequence] | None = None,
    kind: str = "forest",
    scoring: str = "neg_mean_squared_error",
    time_series: bool = False,
    folds: int = 5,
    seed: int = SEED,
) -> KeyedTrees:
    """Search ``grid`` over ``folds`` folds for every series and fit its best setting on all of its rows.

    ``kind`` is "forest" (trees on Poisson draws of the rows, all features at every cut) or
    "boosted" (least squares, ``rate`` times each tree, no draws).  Folds are contiguous, or
    expanding with ``time_series``.  A setting's score is the mean over the folds that have
    train and test rows.  Rows with a NULL feature or target take no part; null keys are keys.
    """
    keys, features = list(keys), list(features)
    specs = expand_specs(grid or (FOREST_GRID if kind == "forest" else BOOSTED_GRID))
    used = df.select(*keys, pos, *[F.col(c).cast("double").alias(c) for c in [*features, target]])
    used = position(_complete(used, [*features, target]), keys, pos, "_j").drop(pos)
    tag = time_segments if time_series else kfold_contiguous
    rows = settle(with_totals(tag(used, keys, "_j", folds, "_part"), keys, "_j", {"_rows": F.count(F.lit(1))}))
    local, long = rows.where(F.col("_rows") <= LOCAL_ROWS).drop("_rows"), rows.where(F.col("_rows") > LOCAL_ROWS).drop("_rows")

    errors = _forest_errors if kind == "forest" else _boosted_errors
    shape = key_schema(rows, keys, "fold int, spec int, error double")

    def judged(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y, row = _arrays(pdf, features, target)
        part, fold = pdf.sort_values("_j")["_part"].to_numpy(), int(pdf["_fold"].iloc[0])
        train, test = _sides(part, fold, time_series)
        found = errors(x, y, row, train, test, specs, scoring, seed) if train.any() and test.any() else []
        out = pd.DataFrame([(fold, s, e / test.sum()) for s, e in found], columns=["fold", "spec", "error"])
        return _with_keys(out, pdf, keys, shape.names)

    # a row goes to every fold that trains on it or tests it
    first = F.greatest(F.col("_part") - 1, F.lit(0)) if time_series else F.lit(0)
    dealt = local.withColumn("_fold", F.explode(F.sequence(first.cast("int"), F.lit(folds - 1))))
    found = _apart(dealt, [*keys, "_fold"]).groupBy(*keys, "_fold").applyInPandas(judged, shape)
    blocked = None
    if not long.isEmpty():
        from loomcast.operators.tree_levels import Blocked

        blocked = Blocked(long, keys, features, target, kind, seed)
        found = found.unionByName(blocked.errors(specs, scoring, folds, time_series))
    means = found.groupBy(*keys, "spec").agg((-F.avg("error")).alias("score"))
    series = rows.select(*keys).distinct()
    listed = [(k, *[float(s[n]) for n in DEFAULTS]) for k, s in enumerate(specs)]
    settings = df.sparkSession.createDataFrame(listed, "spec int, " + ", ".join(f"{n} double" for n in DEFAULTS))
    scores = settle(match(series.crossJoin(F.broadcast(settings)), means, [*keys, "spec"], "left"))
    # equal but for rounding: the first setting
    top = attach(scores, scores.groupBy(*keys).agg(F.max("score").alias("_top")), keys)
    near = F.col("score") >= F.col("_top") - F.lit(1e-12) * F.abs("_top")
    best = top.where(F.coalesce(near, F.col("_top").isNull())).groupBy(*keys)
    best = settle(best.agg(F.min_by(F.struct("spec", *DEFAULTS, "score"), "spec").alias("b")).select(*keys, "b.*"))

    node_shape = key_schema(rows, keys, NODES)

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y, row = _arrays(pdf, features, target)
        return _with_keys(_fitted(x, y, row, specs[int(pdf["_spec"].iloc[0])], kind, seed), pdf, keys, node_shape.names)

    chosen = attach(local, best.select(*keys, F.col("spec").alias("_spec")), keys)
    nodes = (_apart(chosen, keys) if keys else chosen).groupBy(*keys).applyInPandas(fitted, node_shape)
    if blocked is not None:
        nodes = nodes.unionByName(blocked.fit(specs, best))
    return KeyedTrees(settle(nodes), scores, best, keys, features)


def _complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows in which no one of ``columns``, all double, is NULL or NaN.

    One condition a column: of one condition on all of them (``na.drop``) the optimizer derives a
    variant for every subset of computed columns, which no driver holds beyond some twenty.
    """
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in columns]))


def _apart(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Growing is heavy for its bytes: keep adaptive execution from merging the groups into few tasks."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *by)


def _sides(part: np.ndarray, fold: int, time_series: bool) -> tuple[np.ndarray, np.ndarray]:
    """(train rows, test rows) of a fold."""
    return (part <= fold, part == fold + 1) if time_series else (part != fold, part == fold)


def predict_trees(df: DataFrame, model: KeyedTrees, out: str = "prediction") -> DataFrame:
    """``df`` with the prediction of each row's own series; NULL where a feature is NULL or the series has no trees."""
    keys, features = model.keys, model.features
    if {out, "_x", "_p"} & set(df.columns):
        raise ValueError(f"columns {out}, _x and _p are taken")
    x = F.when(~F.greatest(F.lit(False), *[F.col(c).isNull() for c in features]), F.array(*[F.col(c).cast("double") for c in features]))
    tagged = df.withColumn("_x", x)
    sizes = tagged.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(PREDICT_ROWS)).cast("int").alias("_parts"))
    sizes = settle(sizes)
    tagged = attach(tagged, sizes, keys).withColumn("_p", F.pmod(F.monotonically_increasing_id(), F.col("_parts")).cast("int")).drop("_parts")
    nodes = attach(model.nodes, sizes, keys, "inner").withColumn("_p", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    by, columns = [*keys, "_p"], df.columns
    shape = key_schema(df, columns, f"{out} double")

    def guess(left, right):
        import pyarrow as pa

        frame = right.select(["tree", "node", "feature", "threshold", "left", "right", "value"]).to_pandas()
        lists = left.column("_x").combine_chunks()
        whole = np.asarray(lists.is_valid())
        x = lists.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(features))
        total = np.zeros(len(x))
        for _, own in frame.groupby("tree", sort=True):
            own = own.sort_values("node")
            base = own["node"].to_numpy()
            at = np.full(len(x), 0)
            feature, cut = own["feature"].to_numpy(), own["threshold"].to_numpy()
            left_of, right_of = (np.searchsorted(base, own[c].to_numpy()) for c in ("left", "right"))
            moving = np.arange(len(x)) if feature[0] >= 0 else np.zeros(0, np.int64)
            while len(moving):
                here = at[moving]
                low = x[moving, feature[here]] <= cut[here]
                at[moving] = np.where(low, left_of[here], right_of[here])
                moving = moving[feature[at[moving]] >= 0]
            total += own["value"].to_numpy()[at]
        full = np.full(left.num_rows, np.nan)
        if len(frame):
            full[whole] = total
        known = pa.array(full, from_pandas=True, mask=np.isnan(full))
        return left.select(columns).append_column(out, known)

    return tagged.groupBy(*by).cogroup(nodes.groupBy(*by)).applyInArrow(guess, shape)
