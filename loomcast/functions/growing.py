"""Regression trees in numpy: many trees on the same rows grow level by level together.

A slot is one tree with weights, targets and limits of its own.  All slots share the
rows, whose order by each feature is found once; at a level, a stable sort by node keeps
that order inside the nodes, and running sums give every possible cut of every node of
every slot at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Rows times slots that grow together; more slots follow in turns.
TOGETHER = 20_000
#: Gains closer than this count as equal, so that the order of a sum does not decide.
SAME = 1 - 1e-12

_U = np.uint64
_POISSON = np.cumsum([np.exp(-1) / np.prod(np.arange(1, k + 1, dtype=float)) for k in range(18)])


def draws(rows: np.ndarray, trees: np.ndarray, seed: int) -> np.ndarray:
    """How often each tree draws each row: Poisson(1) numbers from hashes of (row, tree, seed), [trees, rows].

    They do not depend on where a row is or how many there are, so blocks of a series
    draw the same as the whole.
    """
    x = rows.astype(np.uint64)[None, :] * _U(0x9E3779B97F4A7C15) + trees.astype(np.uint64)[:, None] * _U(0xD1342543DE82EF95)
    x += _U(seed * 0xA0761D6478BD642F % 2**64)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return np.searchsorted(_POISSON, (x >> _U(11)).astype(float) / 2.0**53, side="right").astype(float)


@dataclass
class Trees:
    """Nodes of all slots; the first ones are the roots, in the slots' order."""

    feature: np.ndarray  # -1 at a leaf
    threshold: np.ndarray  # rows up to it go left
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    rows: np.ndarray  # distinct rows drawn
    depth: np.ndarray
    slot: np.ndarray

    def step(self, node: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The next node of every row, [slots, rows]; a leaf stays."""
        own = self.feature[node]
        seen = x[np.arange(len(x))[None, :], np.maximum(own, 0)]
        down = np.where(seen <= self.threshold[node], self.left[node], self.right[node])
        return np.where(own >= 0, down, node)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        slots = int((self.depth == 0).sum())
        node = np.repeat(np.arange(slots)[:, None], len(x), axis=1)
        for _ in range(int(self.depth.max(initial=0))):
            node = self.step(node, x)
        return node

    def cut(self, max_depth: int, min_split: int) -> Trees:
        """The trees that a smaller depth and a larger least split size give."""
        ends = (self.depth >= max_depth) | (self.rows < min_split)
        return Trees(
            np.where(ends, -1, self.feature), self.threshold, self.left, self.right, self.value, self.rows, self.depth, self.slot
        )


def best_cuts(node, x, n, w, wy, sizes, least):
    """The best cut of each node on one feature, from cells sorted by (node, x).

    A cell has a value ``x`` and its rows, weight and weighted target (``n`` None: one row
    each, ``w`` None: weight as rows); ``sizes`` says how many cells a node has.  Returns
    (gain, threshold) by node: the weighted squares of the two sides' means, -inf where no
    cut leaves ``least`` rows on both sides.
    """
    count = len(x)
    last = np.cumsum(sizes) - 1
    start = last - sizes + 1
    # a cut stands behind a cell: the next cell is of the same node and larger
    cut = x[:-1] < x[1:]
    cut[last[:-1]] = False
    place = np.flatnonzero(cut)
    own = node[place]

    def sides(cells):
        upto = np.cumsum(cells)
        before = np.where(start > 0, upto[start - 1], 0.0)
        low = upto[place] - before[own]
        return low, (upto[last] - before)[own] - low

    if n is None:
        n_low = (place - start[own] + 1).astype(float)
        n_high = sizes[own] - n_low
    else:
        n_low, n_high = sides(n)
    fits = (n_low >= least[own]) & (n_high >= least[own])
    if not fits.all():
        place, own, n_low, n_high = place[fits], own[fits], n_low[fits], n_high[fits]
    w_low, w_high = (n_low, n_high) if w is None else sides(w)
    y_low, y_high = sides(wy)
    gain = y_low**2 / w_low + y_high**2 / w_high
    top, threshold = np.full(len(sizes), -np.inf), np.zeros(len(sizes))
    if not count or not len(place):
        return top, threshold
    opens = np.flatnonzero(np.diff(own, prepend=-1))
    best = np.maximum.reduceat(gain, opens)
    top[own[opens]] = best
    hits = np.flatnonzero(gain >= top[own] * SAME)[::-1]
    first = np.zeros(len(sizes), dtype=np.int64)
    first[own[hits]] = place[hits]  # the lowest of equals
    found = own[opens]
    low, high = x[first[found]], x[first[found] + 1]
    middle = low + (high - low) / 2
    threshold[found] = np.where(middle < high, middle, low)
    return top, threshold


def grow(x, order, y, w, max_depth, min_split, min_leaf) -> Trees:
    """Trees of least squares on rows ``x`` [rows, features].

    ``order`` [features, rows] sorts the rows by each feature; ``y`` and ``w`` are
    [slots, rows], rows of weight 0 are not drawn; the limits are one number a slot.  A
    node is not split beyond its slot's depth, below ``min_split`` rows, or where its
    targets are equal.  Of equal cuts the first feature's lowest wins.
    """
    slots, rows = w.shape
    wy = (w * y).ravel()
    weight = w.ravel()
    squares = (w * y * y).ravel()
    row_of = np.tile(np.arange(rows), slots)
    node = np.repeat(np.arange(slots), rows)
    lines = [(np.arange(slots)[:, None] * rows + own[None, :]).ravel() for own in order]
    lines = [line[weight[line] > 0] for line in lines]
    columns = [np.tile(x[:, f], slots) for f in range(x.shape[1])]
    flat = (x == x[:1]).all(axis=0) if rows else np.ones(x.shape[1], bool)  # no cut is ever found there
    spread = np.add.reduceat(squares, np.arange(slots) * rows) if rows else np.zeros(slots)
    plain = bool(np.isin(weight, (0.0, 1.0)).all())
    held, made, slot, depth = [], 0, np.arange(slots), 0
    while len(slot):
        count = len(slot)
        on = lines[0]
        size = np.bincount(node[on], minlength=count)
        total_w = np.bincount(node[on], weights=weight[on], minlength=count)
        total_y = np.bincount(node[on], weights=wy[on], minlength=count)
        total_s = np.bincount(node[on], weights=squares[on], minlength=count)
        mean = total_y / np.maximum(total_w, 1e-300)
        uneven = total_s - total_y * mean > 1e-12 * spread[slot]
        open_ = uneven & (depth < max_depth[slot]) & (size >= min_split[slot]) & (size >= 2 * min_leaf[slot])
        feature, threshold = np.full(count, -1), np.zeros(count)
        if open_.any():
            number = np.where(open_, np.cumsum(open_) - 1, -1)
            least, sizes = min_leaf[slot[open_]], size[open_]
            small = np.int16 if len(sizes) < 32_000 else np.int64
            gain = np.full(len(sizes), -np.inf)
            own_feature, own_cut = np.full(len(sizes), -1), np.zeros(len(sizes))
            spot = number.astype(small)[node]
            for f, line in enumerate(lines):
                if f and flat[f]:
                    continue
                place = spot[line]
                if not open_.all():
                    line = line[place >= 0]
                    place = spot[line]
                column = columns[f]
                if depth:
                    sort = np.argsort(place, kind="stable")
                    line, place = line[sort], place[sort]
                lines[f] = line
                top, cut = best_cuts(place, column[line], None, None if plain else weight[line], wy[line], sizes, least)
                better = top * SAME > gain
                gain = np.where(better, top, gain)
                own_feature, own_cut = np.where(better, f, own_feature), np.where(better, cut, own_cut)
            feature[open_], threshold[open_] = own_feature, own_cut
        split = feature >= 0
        ahead = made + count + 2 * (np.cumsum(split) - 1)
        held.append((feature, threshold, np.where(split, ahead, -1), np.where(split, ahead + 1, -1), mean, size, np.full(count, depth), slot))
        child = np.where(split, 2 * (np.cumsum(split) - 1), -1)
        stays = split[node]
        for f, line in enumerate(lines):
            if not (f and flat[f]):
                lines[f] = line[stays[line]]
        if len(lines[0]):
            line = lines[0]
            own = node[line]
            node = np.zeros_like(node)  # whatever is not in a line any more
            node[line] = child[own] + (x[row_of[line], feature[own]] > threshold[own])
        slot = np.repeat(slot[split], 2)
        made, depth = made + count, depth + 1
    return Trees(*(np.concatenate(c) for c in zip(*held)))


def sorted_rows(x: np.ndarray) -> np.ndarray:
    return np.argsort(x, axis=0, kind="stable").T


def turns(slots: int, rows: int) -> list[np.ndarray]:
    """Slot numbers, cut into parts that grow together."""
    size = max(1, TOGETHER // max(rows, 1))
    return [np.arange(k, min(k + size, slots)) for k in range(0, slots, size)]
