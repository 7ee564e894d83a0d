"""Language-model scores from a weighted backoff automaton over word bigrams.

States are the histories seen in training (words, and the start of a text) and the empty
history. A state's arcs carry log10 P(word | history) of the bigrams seen; its failure
arc leads to the empty history and carries the rest of the history's mass, and the empty
history's arcs carry add-0.1 unigrams with one arc for all unknown words:

    arc       log10((c(h, w) + M * U(w)) / (c(h) + M))
    failure   log10(M / (c(h) + M)), then U(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1))

A text is read once from left to right: at each word the state's arc is taken, or its
failure arc and then the empty state's; the word just read is the next state.

The automaton grows with the corpus, so no machine holds it. Texts are dealt to blocks
of bounded size by the hash of their id; a block asks the counts' owners, which are dealt
by hash, for the arcs and states that it meets, in one packed list for each owner.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import python_ready, slices
from loomcast.llm.shingles import mixed, word_hashes

#: Pseudo-count of the lower order in each history.
MASS = 200.0
#: Added to each unigram count.
ADDED = 0.1
#: Documents whose crc32(id as text) has this remainder are held out of training.
FOLDS = 10
#: Text bytes of a block.
BLOCK_BYTES = 16 << 20

_U = np.uint64
#: Hashes of the end token and of the start state; words get others but for a chance of 2^-64.
END = _U(0x5851F42D4C957F2D)
START = _U(0x14057B7EF767814F)
PAIR = _U(0xD6E8FEB86659FD93)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of the texts, each text with its end token, and each text's first token's place."""
    words, first = word_hashes(column)
    texts = len(first) - 1
    places = first + np.arange(texts + 1)
    tokens = np.empty(len(words) + texts, dtype=np.uint64)
    ends = places[1:] - 1
    is_word = np.ones(len(tokens), dtype=bool)
    is_word[ends] = False
    tokens[is_word], tokens[ends] = words, END
    return tokens, places


def pair_hashes(tokens: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The hash of each token together with the state before it."""
    state = np.empty_like(tokens)
    state[1:] = tokens[:-1]
    state[places[:-1]] = START
    return mixed(state * PAIR + mixed(tokens))


def _counted(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each comes in training."""
    known, which = np.unique(keys, return_inverse=True)
    return known, np.bincount(which, weights=train, minlength=len(known)).astype(np.int64)


def _packed(keys: np.ndarray) -> bytes:
    """Sorted distinct hashes as byte planes of their differences."""
    steps = np.diff(keys, prepend=_U(0))
    return zlib.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _packed_counts(counts: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(counts.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpacked_counts(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def _owned(keys: np.ndarray, owners: int) -> np.ndarray:
    """Where each owner's share of sorted hashes begins; owners have equal ranges of the hash."""
    cuts = [min(k * 2**64 // owners, 2**64 - 1) for k in range(1, owners)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(cuts, dtype=np.uint64)), [len(keys)]])


def _requests(block: int, orders: list[tuple[int, np.ndarray, np.ndarray]], owners: int) -> Iterator[tuple]:
    for order, keys, counts in orders:
        at = _owned(keys, owners)
        for owner in np.flatnonzero(np.diff(at)):
            part = slice(at[owner], at[owner + 1])
            yield int(owner), order, block, _packed(keys[part]), _packed_counts(counts[part])


ANSWER = "block int, sort int, owner int, counts binary"
REQUEST = "owner int, sort int, block int, keys binary, counts binary"


def _to_table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    parts = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in parts]
    return pa.table({name: pa.array(list(c), type=kinds[kind]) for (name, kind), c in zip(parts, columns)})


def _weights(table: pa.Table, places: np.ndarray) -> np.ndarray:
    train = ~table.column("held_out").combine_chunks().to_numpy(zero_copy_only=False)
    return np.repeat(train, np.diff(places)).astype(float)


def totals(docs: DataFrame, owners: int) -> tuple[int, int, int]:
    """(N, V, training documents): training tokens with repetition and without."""

    def ask(batches):
        for part in slices(batches, "text"):
            tokens, places = token_hashes(part.column("text"))
            train = np.repeat(~part.column("held_out").to_numpy(zero_copy_only=False), np.diff(places))
            keys, counts = np.unique(tokens[train], return_counts=True)
            rows = list(_requests(0, [(1, keys, counts)], owners))
            yield from _to_table([(o, k, int(n.sum())) for (o, _, _, k, c) in rows for n in [_unpacked_counts(c)]], "owner int, keys binary, n long").to_batches()

    def add(table):
        known = np.unique(np.concatenate([_unpacked(raw) for raw in table.column("keys").to_pylist()]))
        return pa.table({"n": [pc.sum(table.column("n")).as_py()], "v": [len(known)]})

    slim = docs.select("text", "held_out")
    shares = slim.mapInArrow(ask, "owner int, keys binary, n long").groupBy("owner").applyInArrow(add, "n long, v long")
    found = shares.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    return found["n"] or 0, found["v"] or 0, docs.filter(~F.col("held_out")).count()


def _answer(table: pa.Table) -> pa.Table:
    """Adds up what all blocks counted of an owner's keys and tells each block its sums."""
    keys = [_unpacked(raw) for raw in table.column("keys").to_pylist()]
    counts = [_unpacked_counts(raw) for raw in table.column("counts").to_pylist()]
    known, which = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(which, weights=np.concatenate(counts), minlength=len(known)).astype(np.int64)
    told, rows, last = sums[which], [], 0
    names = [table.column(c).to_pylist() for c in ("block", "sort", "owner")]
    for block, sort, owner, own in zip(*names, keys):
        # a block knows its keys: their sums in the same order are enough
        rows.append((block, sort, owner, _packed_counts(told[last : last + len(own)])))
        last += len(own)
    return _to_table(rows, ANSWER)


class Automaton:
    """The states and arcs of a backoff automaton that some texts meet."""

    def __init__(self, words, word_counts, pairs, pair_counts, n: int, v: int, starts: int, mass: float):
        self.words, self.word_counts = words, word_counts
        self.pairs, self.pair_counts = pairs, pair_counts
        self.n, self.v, self.starts, self.mass = n, v, starts, mass

    def traverse(self, tokens: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known tokens, base score, score) of each text, in one pass over the tokens.

        All texts advance at once: the state that each token finds is the token before it,
        so the arcs of all places can be looked up together and summed by text.
        """
        count = self.word_counts[np.searchsorted(self.words, tokens)].astype(float)
        unigram = (count + ADDED) / (self.n + ADDED * (self.v + 1))
        history = np.empty_like(count)  # the state's own count
        history[1:] = count[:-1]
        history[places[:-1]] = self.starts
        arc = self.pair_counts[np.searchsorted(self.pairs, pair_hashes(tokens, places))]
        taken = np.log10((arc + self.mass * unigram) / (history + self.mass))
        base = np.log10(unigram)
        failed = np.log10(self.mass / (history + self.mass)) + base
        step = np.where(arc > 0, taken, failed)
        first = places[:-1]
        if not len(first):
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        return tuple(np.add.reduceat(x, first) for x in ((count > 0).astype(np.int64), base, step))


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def score_documents(
    docs: DataFrame, mass: float = MASS, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from all rows whose crc32(doc_id as text) mod 10 is not 0 and scores
    all rows. Tokens are words between ASCII white space, A-Z as a-z, then one end token.
    Null and empty texts consist of the end token. A null doc_id counts as held out.
    Repeated rows count and are scored as often as they come. Without training rows all
    tokens are unknown. Other columns are ignored, whatever their names. An empty table
    gives an empty result. Words are told apart by 64-bit hashes.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    slim = python_ready(slim).withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(True)))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(math.ceil(size / block_bytes), 2 * docs.sparkSession.sparkContext.defaultParallelism)
    n, v, starts = totals(slim, blocks)
    # rows without an id are dealt by their text
    dealt = slim.withColumn("block", F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(blocks)).cast("int"))

    def ask(key, table):
        words, pairs = [], []
        for part in slices(table.to_batches(), "text"):
            tokens, places = token_hashes(part.column("text"))
            weights = _weights(pa.Table.from_batches([part]), places)
            words.append(_counted(tokens, weights))
            pairs.append(_counted(pair_hashes(tokens, places), weights))
        orders = [(sort, *_merged(parts)) for sort, parts in ((1, words), (2, pairs))]
        return _to_table(list(_requests(key[0].as_py(), orders, blocks)), REQUEST)

    def read(key, texts, answers):
        if not texts.num_rows:
            return _to_table([], SCORES)
        words, pairs = [], []
        for part in slices(texts.to_batches(), "text"):
            tokens, places = token_hashes(part.column("text"))
            words.append(np.unique(tokens))
            pairs.append(np.unique(pair_hashes(tokens, places)))
        known = {}
        for sort, parts in ((1, words), (2, pairs)):
            # owners have ranges of the keys: in their order the sums follow the sorted keys
            own = answers.filter(pc.equal(answers.column("sort"), sort)).sort_by("owner")
            counts = [_unpacked_counts(raw) for raw in own.column("counts").to_pylist()]
            known[sort] = (np.unique(np.concatenate(parts)), np.concatenate(counts))
        automaton = Automaton(*known[1], *known[2], n, v, starts, mass)
        out = []
        for part in slices(texts.to_batches(), "text"):
            tokens, places = token_hashes(part.column("text"))
            met, base, score = automaton.traverse(tokens, places)
            columns = [part.column("doc_id"), part.column("held_out"), pa.array(np.diff(places)), pa.array(met), pa.array(base), pa.array(score)]
            out.append(pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SCORES.split(", ")]))
        return pa.Table.from_batches(out)

    requests = dealt.groupBy("block").applyInArrow(ask, REQUEST)
    answers = requests.groupBy("owner", "sort").applyInArrow(_answer, ANSWER)
    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(read, SCORES)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"
    )


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    known, which = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.concatenate([c for _, c in parts])
    return known, np.bincount(which, weights=counts, minlength=len(known)).astype(np.int64)
