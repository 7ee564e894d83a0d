"""Word and shingle hashes of many texts at once, with numpy over Arrow's own bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Leading bits of a shingle hash that choose its register.
ROW_BITS = 7

_U = np.uint64
_MULTIPLIER = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A reversible scramble of 64-bit values, so that all bits depend on all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_values() -> np.ndarray:
    values = mixed(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))
    values[65:91] = values[97:123]  # A-Z as a-z
    return values


BYTE_VALUES = _byte_values()
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, *range(9, 14)]] = True


def _powers(name: str, base: np.uint64, size: int) -> np.ndarray:
    held = _POWERS.get(name)
    if held is None or len(held) < size:
        held = np.full(max(size, 1 << 16), base, dtype=np.uint64)
        held[0] = 1
        _POWERS[name] = held = np.multiply.accumulate(held)
    return held[:size]


def raw_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each; null as empty."""
    column = pc.fill_null(column.cast(pa.string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z as a-z, split at ASCII white space) and each text's first word's place."""
    data, at = raw_text(column)
    size = len(data)
    if not size:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    space = IS_SPACE[data]
    edge = np.zeros(size + 1, dtype=bool)
    edge[at] = True
    before = np.empty(size, dtype=bool)
    before[0], before[1:] = True, space[:-1]
    after = np.empty(size, dtype=bool)
    after[-1], after[:-1] = True, space[1:]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    sums = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * _powers("up", _MULTIPLIER, size), out=sums[1:])
    own = (sums[ends] - sums[starts]) * _powers("down", _INVERSE, size)[starts]
    words = mixed(own + (ends - starts).astype(np.uint64) * _U(0xA0761D6478BD642F))
    return words, np.searchsorted(starts, at)


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words, by the place of their first one."""
    count = len(words) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, length * 0xE7037ED1A0B428DB % 2**64, dtype=np.uint64)
    for k, factor in enumerate(_powers("up", _MULTIPLIER, length + 1)[1:]):
        total += mixed(words[k : k + count] + _U(k)) * factor
    return mixed(total)


def shingle_sets(column: pa.Array, length: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text of fewer words has its whole word sequence as its one shingle; without words
    the set is empty.
    """
    words, first = word_hashes(column)
    runs = run_hashes(words, length)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= length:
            out.append(np.unique(runs[a : b - length + 1]))
        else:
            out.append(run_hashes(words[a:b], b - a) if b > a else words[:0])
    return out
