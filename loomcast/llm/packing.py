"""Packing documents into fixed windows by the sum-of-squares rule.

Each task packs the documents it reads, online: a level array counts its partly filled
windows by fill, and a document goes to the level that leaves the smallest sum of
squared counts. Whole windows of a long document need no placing. When a task's
documents end, its partly filled windows are closed by cutting the emptiest ones into
the gaps of the fullest; the last rest is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import python_ready, slices
from loomcast.llm.wordbpe import encoder

WINDOW = 4096
END_ID = 2
#: Room for the windows of one task in a sequence id.
TASK_SHIFT = 40

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)

#: A piece: doc_id, first id's place in its document, its ids, its document's length.
Piece = tuple[int | None, int, np.ndarray, int]


class Packer:
    """Sum-of-squares packing of pieces into windows of ``window`` ids."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.counts = np.zeros(window + 1, dtype=np.int64)  # by fill; none at 0 and at the window
        self.open: dict[int, list[list[Piece]]] = defaultdict(list)

    def level_for(self, size: int) -> int:
        """The fill whose window takes ``size`` ids at the least sum of squares; ties to the fullest."""
        last = self.window - size
        here, there = self.counts[: last + 1], self.counts[size:]
        change = 2 * (there - here) + 2
        change[last] -= 2 * there[last] + 1  # a full window leaves the array
        change[here == 0] = np.iinfo(np.int64).max
        change[0] = 2 * there[0] + 1 if last else 0  # a new window
        return last - int(np.argmin(change[::-1]))

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Take a document; yield the windows that are full now."""
        doc, start, ids, total = piece
        whole = len(ids) // self.window * self.window
        for k in range(0, whole, self.window):
            yield [(doc, start + k, ids[k : k + self.window], total)]
        rest = ids[whole:]
        if not len(rest):
            return
        level = self.level_for(len(rest))
        held = self.open[level].pop() if level else []
        self.counts[level] -= level > 0
        held.append((doc, start + whole, rest, total))
        if level + len(rest) == self.window:
            yield held
        else:
            self.counts[level + len(rest)] += 1
            self.open[level + len(rest)].append(held)

    def close(self) -> Iterator[list[Piece]]:
        """Empty the level array: the emptiest windows fill the gaps of the fullest."""
        left = [held for level in sorted(self.open, reverse=True) for held in self.open[level]]
        self.open.clear()
        self.counts[:] = 0
        donor: list[Piece] = []
        first, last = 0, len(left) - 1
        while first <= last or donor:
            held: list[Piece] = []
            if first <= last:
                held, first = left[first], first + 1
            room = self.window - sum(len(p[2]) for p in held)
            while room:
                if not donor:
                    if first > last:
                        break
                    donor, last = left[last], last - 1
                doc, start, ids, total = donor.pop()
                held.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    donor.append((doc, start + room, ids[room:], total))
                room = self.window - sum(len(p[2]) for p in held)
            if not room:
                yield held
            else:
                yield from self._powers(held)

    def _powers(self, held: list[Piece]) -> Iterator[list[Piece]]:
        """Cut one rest into windows whose sizes are powers of two."""
        size = sum(len(p[2]) for p in held)
        while size:
            room = part = 1 << (size.bit_length() - 1)
            out: list[Piece] = []
            while room:
                doc, start, ids, total = held.pop(0)
                out.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    held.insert(0, (doc, start + room, ids[room:], total))
                room -= len(out[-1][2])
            yield out
            size -= part


def pack_batches(
    batches: Iterable[pa.RecordBatch], encode, window: int, end_id: int, task: int
) -> Iterator[pa.RecordBatch]:
    packer, made = Packer(window), task << TASK_SHIFT
    end = np.array([end_id], dtype="<u4").tobytes()
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    rows: list[tuple] = []

    def note(windows: Iterator[list[Piece]]) -> None:
        nonlocal made
        for held in windows:
            offset = 0
            for doc, start, ids, total in held:
                rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, made, offset))
                offset += len(ids)
            made += 1

    def batch() -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[] for _ in names]
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=names)

    for part in slices(batches, "text"):
        texts = [text or "" for text in part.column("text").to_pylist()]
        for doc, raw in zip(part.column("doc_id").to_pylist(), encode(texts)):
            ids = np.frombuffer(raw + end, dtype="<u4")
            note(packer.add((doc, 0, ids, len(ids))))
        yield batch()
    note(packer.close())
    yield batch()


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a word-end BPE file that every machine has. Null and empty
    texts are documents of the end id alone. A text longer than the window is cut into
    whole windows and a rest. Repeated rows are packed as often as they come; a null doc_id
    is carried as null. Other columns are ignored. An empty table gives no rows. Memory of a
    task: its open windows, whose number the rule keeps near the number of levels.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        yield from pack_batches(batches, encoder(tokenizer).encode, window, end_id, TaskContext.get().partitionId())

    return python_ready(slim).mapInArrow(run, SCHEMA)
