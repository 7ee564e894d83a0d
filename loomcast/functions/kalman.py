"""Exact Gaussian likelihood of ARMA models: many parameter sets at once, in blocks of a series.

A model is a state space of r = max(p, q + 1) numbers that starts from its stationary
distribution.  The filter's gains depend on the parameters alone, so with them given a
step is an affine map of the state, and a block of steps is one, too: a block's squared
shocks are a quadratic form of the state that it starts with.  Blocks are summarised
independently and joined in order (:func:`joined`).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

#: Steps after which the gains are taken as settled.
SETTLED = 5000


def stationary(partial: np.ndarray) -> np.ndarray:
    """Coefficients of a stationary autoregression from any real numbers, [sets, order] (Durbin and Levinson)."""
    u = partial / np.sqrt(1 + partial**2)
    out = np.zeros_like(u)
    for k in range(u.shape[1]):
        before = out[:, :k].copy()
        out[:, :k] = before - u[:, k : k + 1] * before[:, ::-1]
        out[:, k] = u[:, k]
    return out


def product(short: np.ndarray, seasonal: np.ndarray, season: int, sign: int) -> np.ndarray:
    """Coefficients of (1 + sign * short)(1 + sign * seasonal at multiples of the season), less the leading one, [sets, lags]."""
    p, many = short.shape[1], seasonal.shape[1]
    base = np.concatenate([np.ones((len(short), 1)), sign * short], axis=1)
    out = np.zeros((len(short), p + season * many + 1))
    out[:, : p + 1] = base
    for k in range(many):
        at = (k + 1) * season
        out[:, at : at + p + 1] += sign * seasonal[:, k : k + 1] * base
    return sign * out[:, 1:]


@dataclass(frozen=True)
class Gains:
    """The gains of the filter for each set until they settle: [steps, sets, r] and [steps, sets]."""

    phi: np.ndarray  # [sets, r]
    gain: np.ndarray
    spread: np.ndarray

    def at(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        k = min(t, len(self.spread) - 1)
        return self.gain[k], self.spread[k]


def _start(wide: np.ndarray, shock: np.ndarray) -> np.ndarray:
    """First column of the stationary covariance of the state, [sets, r], from the autocovariances."""
    sets, r = wide.shape
    psi = np.zeros((sets, r + 1))  # answers to a unit shock
    for k in range(r + 1):
        psi[:, k] = (shock[:, k] if k < r else 0.0) + (wide[:, :k] * psi[:, :k][:, ::-1]).sum(axis=1)
    system, right = np.broadcast_to(np.eye(r + 1), (sets, r + 1, r + 1)).copy(), np.zeros((sets, r + 1))
    lines = np.arange(r + 1)
    for j in range(r):
        system[:, lines, np.abs(lines - 1 - j)] -= wide[:, j : j + 1]
    for k in range(r):
        right[:, k] = (shock[:, k:] * psi[:, : r - k]).sum(axis=1)
    gamma = np.linalg.solve(system, right[:, :, None])[:, :, 0]
    out = np.zeros((sets, r))
    out[:, 0] = gamma[:, 0]
    for i in range(1, r):
        out[:, i] = (wide[:, i:] * gamma[:, 1 : 1 + r - i]).sum(axis=1) + (shock[:, i:] * psi[:, : r - i]).sum(axis=1)
    return out


def gains(phi: np.ndarray, theta: np.ndarray) -> Gains:
    """The filter's gains for sets of coefficients, [sets, p] and [sets, q]; unit shocks.

    From a stationary start the covariance changes by a matrix of rank one in each step, so
    vectors are enough (Chandrasekhar's recursions).
    """
    sets, r = len(phi), max(phi.shape[1], theta.shape[1] + 1)
    wide = np.zeros((sets, r))
    wide[:, : phi.shape[1]] = phi
    shock = np.zeros((sets, r))
    shock[:, 0] = 1
    shock[:, 1 : 1 + theta.shape[1]] = theta

    def forward(x):
        """The transition times a vector."""
        out = wide * x[:, :1]
        out[:, :-1] += x[:, 1:]
        return out

    first = _start(wide, shock)
    spread = first[:, 0].copy()
    pull = forward(first)  # gain times spread
    way, size = pull.copy(), -1.0 / spread
    held, spreads = [pull / spread[:, None]], [spread]
    for _ in range(SETTLED):
        head = way[:, 0]
        before = spread
        spread = spread + head * head * size
        pull = pull + forward(way) * (head * size)[:, None]
        size = size + size * size * head * head / before
        way = forward(way) - pull * (head / spread)[:, None]
        held.append(pull / spread[:, None])
        spreads.append(spread)
        if np.abs(way * way * size[:, None]).max(initial=0.0) < 1e-15:
            break
    return Gains(wide, np.array(held), np.array(spreads))


@dataclass
class Block:
    """What a stretch of a series says about each set, as a function of the state that it starts with."""

    squares: np.ndarray  # [sets] from a zero state
    pull: np.ndarray  # [sets, r]
    form: np.ndarray  # [sets, r, r]
    state: np.ndarray  # [sets, r] the state it ends with, from a zero state
    carry: np.ndarray  # [sets, r, r]
    logs: np.ndarray  # [sets]
    rows: int


def summarised(y: np.ndarray, first: int, mean: np.ndarray, found: Gains) -> Block:
    """The block of values ``y`` whose first one is number ``first`` of its series."""
    sets, r = found.phi.shape
    state, carry = np.zeros((sets, r)), np.broadcast_to(np.eye(r), (sets, r, r)).copy()
    squares, pull, form, logs = np.zeros(sets), np.zeros((sets, r)), np.zeros((sets, r, r)), np.zeros(sets)
    moving = first > 0  # the first block starts from a zero state

    def shifted(x):
        out = found.phi.reshape(sets, r, *[1] * (x.ndim - 2)) * x[:, :1]
        out[:, :-1] += x[:, 1:]
        return out

    for k, value in enumerate(y):
        gain, spread = found.at(first + k)
        shock = value - mean - state[:, 0]
        squares += shock**2 / spread
        logs += np.log(spread)
        state = shifted(state) + gain * shock[:, None]
        if moving:
            row = carry[:, 0, :].copy()
            pull += row * (shock / spread)[:, None]
            form += row[:, :, None] * row[:, None, :] / spread[:, None, None]
            carry = shifted(carry) - gain[:, :, None] * row[:, None, :]
            moving = k % 64 != 63 or np.abs(carry).max() > 1e-16
    return Block(squares, pull, form, state, carry if moving or first == 0 else np.zeros_like(carry), logs, len(y))


def joined(blocks: Sequence[Block]) -> tuple[np.ndarray, np.ndarray, int]:
    """(sum of squared shocks, sum of logs, rows) of a series from its blocks in order."""
    state = np.zeros_like(blocks[0].state)
    squares, logs, rows = np.zeros(len(state)), np.zeros(len(state)), 0
    for b in blocks:
        squares += b.squares - 2 * (b.pull * state).sum(axis=1) + np.einsum("si,sij,sj->s", state, b.form, state)
        state = b.state + np.einsum("sij,sj->si", b.carry, state)
        logs, rows = logs + b.logs, rows + b.rows
    return squares, logs, rows


def log_likelihood(squares: np.ndarray, logs: np.ndarray, rows: int) -> np.ndarray:
    """At the best variance of the shocks, squares / rows."""
    return -rows / 2 * (np.log(2 * np.pi * np.maximum(squares, 1e-300) / rows) + 1) - logs / 2


class Search:
    """Maximises a function by quasi-Newton steps that only ask for values of whole batches of points.

    ``points`` are asked for next and ``tell`` takes their values: by turns the points of a
    line search and those of a central difference.
    """

    STEPS = (2.0, 1.0, 0.5, 0.2, 0.05, 0.01, 0.001)
    H = 1e-5
    #: Rise of the value in a step, and largest slope, at which a search ends.
    GAIN, FLAT = 1e-5, 1e-3

    def __init__(self, start: np.ndarray, rounds: int = 60):
        self.x, self.value, self.left = start.astype(float), -np.inf, rounds
        self.inverse = np.eye(len(start))
        self.slope: np.ndarray | None = None
        self.done = False
        self._ask_slope()

    def _ask_slope(self) -> None:
        size = len(self.x)
        steps = np.concatenate([np.eye(size), -np.eye(size), np.zeros((1, size))]) * self.H
        self.points, self.phase = self.x + steps, "slope"

    def _ask_line(self) -> None:
        way = self.inverse @ self.slope
        if way @ self.slope <= 0:
            self.inverse, way = np.eye(len(self.x)), self.slope
        way *= min(1.0, 2.0 / max(np.abs(way).max(initial=0.0), 1e-300))
        self.points, self.phase = self.x + np.outer(self.STEPS, way), "line"

    def tell(self, values: np.ndarray) -> None:
        values = np.where(np.isfinite(values), values, -np.inf)
        if self.phase == "slope":
            size = len(self.x)
            slope = (values[:size] - values[size : 2 * size]) / (2 * self.H)
            slope = np.where(np.isfinite(slope), slope, 0.0)
            if self.slope is not None:
                step, bend = self.x - self._from, self.slope - slope
                if step @ bend > 1e-12:
                    rho, one = 1 / (step @ bend), np.eye(size)
                    turn = one - rho * np.outer(step, bend)
                    self.inverse = turn @ self.inverse @ turn.T + rho * np.outer(step, step)
            self.value, self.slope, self.left = values[-1], slope, self.left - 1
            self.done = not size or self.left <= 0 or np.abs(slope).max() < self.FLAT
            if not self.done:
                self._ask_line()
        else:
            best = int(np.argmax(values))
            if values[best] <= self.value + self.GAIN:
                if (self.inverse == np.eye(len(self.x))).all():
                    self.done = True
                    return
                self.inverse = np.eye(len(self.x))
                self._ask_line()
                return
            self._from, self.x = self.x, self.points[best]
            self._ask_slope()
