"""Growing trees of long series level by level from summed cells.

A series' rows lie in blocks.  For every tree that grows, a block finds the node of each of
its rows and sums rows, weight and target by (tree, node, feature, bin); Spark adds up the
cells of all blocks, and each node picks its cut from its own cells, of which there are at
most features times bins.  The nodes go back to the blocks for the next level.  A node's
name is its path from the root, so that nodes can be named apart from each other.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.functions.grouped import key_schema
from loomcast.functions.growing import Trees, best_cuts, draws, turns
from loomcast.functions.joins import attach
from loomcast.operators import trees as T
from loomcast.session import settle

#: A split node or leaf: its place, its cut, and what it holds.
GROWN = "slot int, path string, feature int, threshold double, value double, rows long, uneven boolean"
CELLS = "slot int, path string, feature int, x double, n double, w double, wy double, wyy double"


def assembled(found: pd.DataFrame, slots: int) -> tuple[Trees, list[str]]:
    """The trees of one series from the nodes grown so far, and the nodes' paths.

    Roots and children that have no node yet are leaves that wait for their cells.
    """
    known = list(zip(found["slot"].tolist(), found["path"].tolist()))
    cut = found["feature"].to_numpy() >= 0
    have = set(known)
    asked = [(k, "") for k in range(slots)] + [(s, p + side) for (s, p), f in zip(known, cut) if f for side in "LR"]
    waiting = [x for x in asked if x not in have]
    table = pd.DataFrame(
        {
            "slot": [s for s, _ in known + waiting],
            "path": [p for _, p in known + waiting],
            "feature": found["feature"].tolist() + [-1] * len(waiting),
            "threshold": found["threshold"].tolist() + [0.0] * len(waiting),
            "value": found["value"].tolist() + [np.nan] * len(waiting),
            "rows": found["rows"].tolist() + [0] * len(waiting),
        }
    )
    table = table.assign(depth=table["path"].str.len().astype("int64")).sort_values(["depth", "slot", "path"], ignore_index=True)
    paths, slot, feature = table["path"].tolist(), table["slot"].tolist(), table["feature"].tolist()
    place = {key: k for k, key in enumerate(zip(slot, paths))}
    left, right = ([place[s, p + side] if f >= 0 else -1 for s, p, f in zip(slot, paths, feature)] for side in "LR")
    columns = (feature, table["threshold"], left, right, table["value"], table["rows"], table["depth"], slot)
    return Trees(*(np.array(c) for c in columns)), paths


class Blocked:
    """Fits for the long series of a table; ``rows`` has the keys, _j, _part, features and target."""

    def __init__(self, rows: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, kind: str, seed: int):
        self.keys, self.features, self.target, self.kind, self.seed = list(keys), list(features), target, kind, seed
        self.by = [*self.keys, "_blk"]
        edges = [F.percentile_approx(c, [k / T.BINS for k in range(T.BINS + 1)], 20 * T.BINS).alias(f"_e_{c}") for c in self.features]
        binned = attach(rows, rows.groupBy(*self.keys).agg(*edges), self.keys)
        # a value stands for the lowest edge that is not below it; the edges are values
        for c in self.features:
            binned = binned.withColumn(c, _lowest_edge(F.col(f"_e_{c}"), F.col(c))).drop(f"_e_{c}")
        block = F.floor(F.col("_j") / F.lit(T.BLOCK_ROWS)).cast("long").alias("_blk")
        self.rows = settle(binned.select(*self.keys, block, "_j", "_part", *self.features, F.col(target).alias("_y")))
        self.blocks = settle(self.rows.select(*self.by).distinct())

    def _to_blocks(self, table: DataFrame) -> DataFrame:
        """A copy of each series' rows of ``table`` for each of its blocks."""
        return attach(table, self.blocks.groupBy(*self.keys).agg(F.collect_list("_blk").alias("_blk")), self.keys, "inner").withColumn(
            "_blk", F.explode("_blk")
        )

    def _run(self, rows: DataFrame, grown: DataFrame, extra: str, work) -> DataFrame:
        """``work(block rows, nodes)`` for every block, with the keys put back."""
        shape = key_schema(rows, self.keys, extra)
        keys = self.keys

        def run(pdf: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
            out = work(pdf.sort_values("_j", ignore_index=True), nodes)
            out = out.astype({"path": object}) if "path" in out else out
            return T._with_keys(out, pdf, keys, shape.names)

        return rows.groupBy(*self.by).cogroup(self._to_blocks(grown).groupBy(*self.by)).applyInPandas(run, shape)

    def _none(self) -> DataFrame:
        return self.rows.sparkSession.createDataFrame([], key_schema(self.rows, self.keys, GROWN))

    def _grow(self, rows: DataFrame, slots: list[dict], weigh, target: str = "_y") -> DataFrame:
        """All trees of ``slots``: the nodes, level by level. ``weigh(block, slot numbers)`` gives [slots, rows] weights.

        ``target`` is the column of one target, or of an array with one for each slot.
        """
        features, limits = self.features, {n: np.array([s[n] for s in slots]) for n in ("depth", "min_split", "min_leaf")}
        keys, shape = self.keys, key_schema(rows, self.keys, GROWN)
        grown, level = self._none(), 0

        def cells(pdf: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
            if level and nodes.empty:
                return pd.DataFrame(columns=[c.split()[0] for c in CELLS.split(", ")])
            trees, paths = assembled(nodes, len(slots))
            x = pdf[features].to_numpy(dtype=float)
            whole = np.array(pdf[target].tolist(), dtype=float)
            ends = np.array([len(p) for p in paths]) == level
            parts = []
            for part in turns(len(slots), len(x)):
                w = weigh(pdf, part)
                node = np.repeat(part[:, None], len(x), axis=1)
                for _ in range(level):
                    node = _stepped(trees, node, x)
                on = (node >= 0) & (w > 0)
                on &= ends[np.maximum(node, 0)]
                s, r = np.nonzero(on)
                y = whole[r, part[s]] if whole.ndim == 2 else whole[r]
                frame = pd.DataFrame({"node": node[s, r], "n": 1.0, "w": w[s, r], "wy": w[s, r] * y, "wyy": w[s, r] * y * y})
                for f in range(len(features)):
                    own = frame.assign(x=x[r, f]).groupby(["node", "x"], as_index=False).sum()
                    parts.append(own.assign(feature=f))
            out = pd.concat(parts, ignore_index=True)
            node = out["node"].to_numpy(dtype=np.int64)
            return out.assign(slot=trees.slot[node], path=[paths[k] for k in node])

        def cut(pdf: pd.DataFrame) -> pd.DataFrame:
            slot = int(pdf["slot"].iloc[0])
            first = pdf[pdf["feature"] == 0]
            n, w, wy, wyy = (first[c].sum() for c in ("n", "w", "wy", "wyy"))
            uneven = bool(wyy - wy * wy / w > 1e-12 * wyy)
            feature, threshold, gain = -1, 0.0, -np.inf
            if uneven and level < limits["depth"][slot] and n >= max(limits["min_split"][slot], 2 * limits["min_leaf"][slot]):
                for f, own in pdf.groupby("feature", sort=True):
                    own = own.sort_values("x")
                    arrays = (own[c].to_numpy() for c in ("x", "n", "w", "wy"))
                    none = np.zeros(len(own), dtype=np.int64)
                    top, place = best_cuts(none, *arrays, np.array([len(own)]), limits["min_leaf"][slot : slot + 1])
                    if top[0] * T.SAME > gain:
                        feature, threshold, gain = int(f), float(place[0]), top[0]
            row = (slot, pdf["path"].iloc[0], feature, threshold, wy / w, int(n), uneven)
            out = pd.DataFrame([row], columns=[c.split()[0] for c in GROWN.split(", ")])
            out = out.astype({"path": object})
            return T._with_keys(out, pdf, keys, shape.names)

        sums = ("n", "w", "wy", "wyy")
        name = [*self.keys, "slot", "path"]
        while True:
            added = self._run(rows, grown, CELLS, cells).groupBy(*name, "feature", "x").agg(*[F.sum(c).alias(c) for c in sums])
            added = settle(added.groupBy(*name).applyInPandas(cut, shape))
            grown, level = settle(grown.unionByName(added)), level + 1
            if added.where("feature >= 0").isEmpty():
                return grown

    def _forest(self, slots: list[dict], time_series: bool) -> DataFrame:
        seed = self.seed

        def weigh(pdf, part):
            w = draws(pdf["_j"].to_numpy(), np.array([slots[k]["tree"] for k in part]), seed)
            for line, k in enumerate(part):
                if slots[k]["fold"] is not None:
                    w[line] *= T._sides(pdf["_part"].to_numpy(), slots[k]["fold"], time_series)[0]
            return w

        return self._grow(self.rows, slots, weigh)

    def errors(self, specs: list[dict], scoring: str, folds: int, time_series: bool) -> DataFrame:
        """(keys, fold, spec, error) of every setting."""
        judge = self._forest_errors if self.kind == "forest" else self._boosted_errors
        summed = judge(specs, T.SCORINGS[scoring], folds, time_series)
        return summed.groupBy(*self.keys, "fold", "spec").agg((F.sum("error") / F.sum("n")).alias("error"))

    def _forest_errors(self, specs, scoring, folds, time_series) -> DataFrame:
        depths, splits = (sorted({s[name] for s in specs}) for name in ("depth", "min_split"))
        groups = sorted({(s["min_leaf"], s["trees"]) for s in specs})
        slots = [
            {"fold": f, "tree": t, "min_leaf": leaf, "trees": count, "depth": max(depths), "min_split": min(splits)}
            for f in range(folds) for leaf, count in groups for t in range(count)
        ]
        grown = self._forest(slots, time_series)
        features, of = self.features, {(s["min_leaf"], s["trees"]): [] for s in specs}
        for k, s in enumerate(specs):
            of[s["min_leaf"], s["trees"]].append(k)

        def judged(pdf: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
            x, y, part = pdf[features].to_numpy(dtype=float), pdf["_y"].to_numpy(), pdf["_part"].to_numpy()
            out = []
            for f in range(folds):
                test = T._sides(part, f, time_series)[1]
                for (leaf, count), own in of.items():
                    first = slots.index({"fold": f, "tree": 0, "min_leaf": leaf, "trees": count, "depth": max(depths), "min_split": min(splits)})
                    mine = nodes[nodes["slot"].between(first, first + count - 1)].assign(slot=lambda n: n["slot"] - first)
                    mine = mine.assign(slot=pd.factorize(mine["slot"], sort=True)[0])
                    used = mine["slot"].nunique()
                    if not test.any() or not used:
                        continue
                    guess = T._forest_sums(assembled(mine, used)[0], x[test], depths, splits) / used
                    for k in own:
                        error = scoring(y[test] - guess[depths.index(specs[k]["depth"]), splits.index(specs[k]["min_split"])])
                        out.append((f, k, float(error.sum()), int(test.sum())))
            return pd.DataFrame(out, columns=["fold", "spec", "error", "n"])

        return self._run(self.rows, grown, "fold int, spec int, error double, n long", judged)

    def _boosting(self, slots: list[dict], time_series: bool, visit) -> DataFrame:
        """Rows with ``_m``, each slot's margin after its last round; ``visit(round, nodes)`` sees the trees."""
        shares = [s["rate"] for s in slots]
        starts = [F.avg(F.when(_train(s["fold"], time_series), F.col("_y"))).alias(f"_s{k}") for k, s in enumerate(slots)]
        first = self.rows.groupBy(*self.keys).agg(*starts)
        first = first.select(*self.keys, F.array(*[F.col(f"_s{k}") for k in range(len(slots))]).alias("_m"))
        rows = settle(attach(self.rows, first, self.keys))
        visit(-1, first)

        def weigh(pdf, part):
            sides = (np.ones(len(pdf), bool) if slots[k]["fold"] is None else T._sides(pdf["_part"].to_numpy(), slots[k]["fold"], time_series)[0] for k in part)
            return np.stack(list(sides)).astype(float)

        features = self.features
        own = ["_blk", "_j", "_part", *features, "_y", "_m"]
        extra = rows.select(*own).schema.simpleString()[7:-1]

        def moved(pdf: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
            trees, _ = assembled(nodes, len(slots))
            value = np.nan_to_num(trees.value)  # a slot without rows stays where it is
            x, margin = pdf[features].to_numpy(dtype=float), np.array(pdf["_m"].tolist(), dtype=float)
            for part in turns(len(slots), len(x)):
                node = np.repeat(part[:, None], len(x), axis=1)
                for _ in range(int(trees.depth.max(initial=0))):
                    node = trees.step(node, x)
                margin[:, part] += (np.array(shares)[part, None] * value[node]).T
            return pdf.assign(_m=list(margin))[own]

        for k in range(max(s["trees"] for s in slots)):
            left = rows.withColumn("_left", F.transform("_m", lambda m: F.coalesce(F.col("_y") - m, F.lit(0.0))))
            nodes = self._grow(left, slots, weigh, "_left")
            visit(k, nodes)
            schema = ", ".join(part.replace(":", " ", 1) for part in extra.split(","))
            rows = settle(self._run(rows, nodes, schema, moved))
        return rows

    def _boosted_errors(self, specs, scoring, folds, time_series) -> DataFrame:
        if len({s["trees"] for s in specs}) > 1:
            raise ValueError("long series need one number of rounds in a grid")
        slots = [{**s, "fold": f} for f in range(folds) for s in specs]
        rows = self._boosting(slots, time_series, lambda k, nodes: None)
        count, keys = len(specs), self.keys
        shape = key_schema(rows, keys, "fold int, spec int, error double, n long")

        def judged(pdf: pd.DataFrame) -> pd.DataFrame:
            margin, y, part = np.array(pdf["_m"].tolist(), dtype=float), pdf["_y"].to_numpy(), pdf["_part"].to_numpy()
            out = []
            for f in range(folds):
                test = T._sides(part, f, time_series)[1]
                if test.any():
                    error = scoring(y[test, None] - margin[test, f * count : (f + 1) * count]).sum(axis=0)
                    out += [(f, k, float(e), int(test.sum())) for k, e in enumerate(error) if np.isfinite(e)]
            return T._with_keys(pd.DataFrame(out, columns=["fold", "spec", "error", "n"]), pdf, keys, shape.names)

        return rows.groupBy(*self.by).applyInPandas(judged, shape)

    def fit(self, specs: list[dict], best: DataFrame) -> DataFrame:
        """Node rows of every series' chosen setting: one run for each setting that any of them chose."""
        shape = key_schema(self.rows, self.keys, T.NODES)
        keys, rows, blocks = self.keys, self.rows, self.blocks
        parts = []
        for chosen in sorted(r["spec"] for r in best.select("spec").distinct().collect()):
            mine = best.where(F.col("spec") == chosen).select(*keys)
            self.rows, self.blocks = settle(attach(rows, mine, keys, "inner")), settle(attach(blocks, mine, keys, "inner"))
            if not self.rows.isEmpty():
                parts.append(self._fit_one(specs[chosen], shape))
        self.rows, self.blocks = rows, blocks
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def _fit_one(self, spec: dict, shape) -> DataFrame:
        keys, held = self.keys, []

        def numbered(scale, tree):
            def run(pdf: pd.DataFrame) -> pd.DataFrame:
                own = pdf.assign(slot=pd.factorize(pdf["slot"], sort=True)[0])
                count = own["slot"].nunique()
                out = T._node_rows(assembled(own, count)[0], np.sort(pdf["slot"].unique()) if tree is None else np.array([tree]), scale or 1.0 / count)
                return T._with_keys(out, pdf, keys, shape.names)

            return run

        if self.kind == "forest":
            grown = self._forest([{**spec, "fold": None, "tree": t} for t in range(spec["trees"])], False)
            return grown.groupBy(*keys).applyInPandas(numbered(None, None), shape)

        def visit(k: int, nodes: DataFrame) -> None:
            if k >= 0:
                held.append(nodes.groupBy(*keys).applyInPandas(numbered(spec["rate"], k), shape))
            else:
                leaf = [F.lit(v).cast(t).alias(n) for n, t, v in (("tree", "int", -1), ("node", "int", 0), ("feature", "int", -1), ("threshold", "double", 0.0), ("left", "int", -1), ("right", "int", -1))]
                held.append(nodes.select(*keys, *leaf, F.element_at("_m", 1).alias("value"), F.lit(0).cast("long").alias("rows")))

        self._boosting([{**spec, "fold": None}], False, visit)
        out = held[0]
        for part in held[1:]:
            out = settle(out.unionByName(part))
        return out


def _lowest_edge(edges: Column, value: Column) -> Column:
    return F.coalesce(F.array_min(F.filter(edges, lambda e: e >= value)), value)


def _train(fold: int | None, time_series: bool):
    if fold is None:
        return F.lit(True)
    return F.col("_part") <= fold if time_series else F.col("_part") != fold


def _stepped(trees: Trees, node: np.ndarray, x: np.ndarray) -> np.ndarray:
    """One step down; rows at a leaf above this level drop out as -1."""
    here = np.maximum(node, 0)
    down = trees.step(here, x)
    return np.where((node >= 0) & (trees.feature[here] >= 0), down, -1)
