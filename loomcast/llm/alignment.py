"""Aligning the tokens of two tokenizers by coalescing their byte intervals.

Both tokenizers cut the same bytes, so each token is an interval. All A and B tokens of a
batch of texts are sorted by start; with the running maximum of their ends, a new group
begins where a start reaches that maximum. Inside a group every A token is linked with
every B token. An id pair counts in how many documents it is linked.

Texts are read once, in blocks of bounded size. A block writes its documents' groups, its
distinct id pairs with the number of its documents that hold each, and for every document
which of these pairs it holds and how often, packed. Spark adds the counts of equal pairs
over all blocks and finds each A id's highest count; each block is told the sums of its
own pairs and closes its documents.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import keep, python_ready, slices

#: Text bytes of a block; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20
#: Words and tokens that a Python worker remembers; beyond this it starts anew.
WORDS_HELD, TOKENS_HELD = 300_000, 4_000_000
#: Words in one call of the tokenizers.
WORDS_A_CALL = 4096
#: Links of a group up to which its pairs are written out; larger groups are counted by distinct ids.
GROUP_LINKS = 1 << 12
#: Room for the blocks of one task in a block's number.
TASK_SHIFT = 32
#: White space, and characters that count as such to some splitters only.
_BLANK = r"\s\u180e\u200b\ufeff"
#: Spaces at which a text must not be cut, and those at which it may.
ODD_SPACES = re.compile(f" [{_BLANK}]|[{_BLANK}] ")
ODD_EDGE = re.compile(f"^$|^[{_BLANK}]|[{_BLANK}]$")
CUT = re.compile(f"(?<=[^{_BLANK}]) (?=[^{_BLANK}])")

_OPEN: dict[tuple[str, str], TokenPair] = {}


def _byte_of_character() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return shown | {chr(256 + k): b for k, b in enumerate(others)}


class TokenPair:
    """Both tokenizers, with the tokens of each word remembered.

    A text is cut at single spaces between characters that are not white space. No token
    of either side crosses such a place, and what is before it does not change what comes
    after, so each distinct word is tokenized once.
    """

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs one task a core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        code = _byte_of_character()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, k in vocab.items():
            self.bytes_a[k] = bytes(code[c] for c in token) if all(c in code for c in token) else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(piece[3:-1], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode()
            for k, piece in enumerate(pieces)
        ]
        if any("▁" in piece.lstrip("▁") for piece in pieces):
            raise ValueError("a piece goes on past a space: texts cannot be cut into words")
        self.sizes_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        # an id with what follows it; B ids stand behind the A ids
        self.shown = [f"{k}{mark}" for k in range(len(self.bytes_a)) for mark in (",", "|", "")]
        self.shown += [f"{k}{mark}" for k in range(len(pieces)) for mark in (",", ";", "")]
        self.forget()

    def forget(self) -> None:
        self.known_a: dict[str, bytes] = {}
        self.known_b: dict[str, bytes] = {}
        self.wrong: set[str] = set()
        self.held = 0

    def _keep(self, words: list[str], ids: np.ndarray, ends: np.ndarray, known: dict[str, bytes]) -> None:
        """Remember each word's ids; ``ends`` says where they end."""
        raw, at = ids.astype("<u4").tobytes(), 0
        for word, end in zip(words, (4 * ends).tolist()):
            known[word] = raw[at:end]
            at = end
        self.held += len(ids)

    def learn(self, words: list[str]) -> None:
        """Tokens of words that stand after one space."""
        plain, odd = [], []
        for word in words:
            (odd if ODD_EDGE.search(word) else plain).append(word)
        for k in range(0, len(plain), WORDS_A_CALL):
            part = plain[k : k + WORDS_A_CALL]
            joined = " ".join(part)
            raw = (" " + joined).encode()
            ends = np.cumsum([len(w.encode()) + 1 for w in part])
            own_a = np.array(self.a.encode(" " + joined, add_special_tokens=False).ids, dtype=np.int64)
            own_b = np.array(self.b.encode(joined), dtype=np.int64)
            if b"".join([self.bytes_a[x] for x in own_a]) == raw == b"".join([self.bytes_b[x] for x in own_b]):
                self._keep(part, own_a, np.searchsorted(np.cumsum(self.sizes_a[own_a]), ends) + 1, self.known_a)
                self._keep(part, own_b, np.searchsorted(np.cumsum(self.sizes_b[own_b]), ends) + 1, self.known_b)
            else:
                odd += part
        coded_a = [x.ids for x in self.a.encode_batch([" " + w for w in odd], add_special_tokens=False)]
        coded_b = self.b.encode(odd, num_threads=1) if odd else []
        for coded, known in ((coded_a, self.known_a), (coded_b, self.known_b)):
            flat = np.array([x for own in coded for x in own], dtype=np.int64)
            self._keep(odd, flat, np.cumsum([len(own) for own in coded], dtype=np.int64), known)
        for word, own_a, own_b in zip(odd, coded_a, coded_b):
            raw = (" " + word).encode()
            if not b"".join([self.bytes_a[x] for x in own_a]) == raw == b"".join([self.bytes_b[x] for x in own_b]):
                self.wrong.add(word)

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A ids, B ids and their numbers in each text; none where the bytes of either differ from the text's."""
        if len(self.known_a) > WORDS_HELD or self.held > TOKENS_HELD:
            self.forget()
        split: list[list[str]] = []
        for text in texts:
            if not text:
                split.append([])
            elif text[0] == " " or text[-1] == " " or ODD_SPACES.search(text):
                split.append(CUT.split(text))
            else:
                split.append(text.split(" "))
        fresh = set().union(*split).difference(self.known_a)
        if fresh:
            self.learn(list(fresh))
        if self.wrong:
            split = [words if self.wrong.isdisjoint(words) else [] for words in split]
        out: list[np.ndarray] = []
        for known in (self.known_a, self.known_b):
            find = known.__getitem__
            raw = [b"".join(map(find, words)) for words in split]
            out += [np.frombuffer(b"".join(raw), dtype="<u4").astype(np.int64), np.array([len(x) // 4 for x in raw], dtype=np.int64)]
        ids_a, n_a, ids_b, n_b = out
        return ids_a, ids_b, n_a, n_b


def token_pair(byte_path: str, piece_path: str) -> TokenPair:
    """One pair a Python worker."""
    if (byte_path, piece_path) not in _OPEN:
        _OPEN[byte_path, piece_path] = TokenPair(byte_path, piece_path)
    return _OPEN[byte_path, piece_path]


def coalesced(sizes_a: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A and every B token, from the tokens' byte sizes.

    Tokens are intervals that lie end to end on each side. Sorted by start, a token opens
    a group where its start reaches the furthest end so far.
    """
    end_a, end_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    starts = np.concatenate([end_a - sizes_a, end_b - sizes_b])
    ends = np.concatenate([end_a, end_b])
    side = np.repeat([0, 1], [len(sizes_a), len(sizes_b)])
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    opens = np.zeros(len(order), dtype=np.int64)
    opens[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(opens)
    return group[: len(sizes_a)], group[len(sizes_a) :]


def linked(ids_a, ids_b, group_a, group_b, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, pair (a * width + b) and number of links, for all A-B pairs of each group."""
    groups = int(group_a[-1]) + 1 if len(group_a) else 0
    n_a, n_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    large = np.flatnonzero(n_a * n_b > GROUP_LINKS)
    first_b = np.cumsum(n_b) - n_b
    times = n_b.copy()
    times[large] = 0
    each = times[group_a]
    left = np.repeat(np.arange(len(ids_a)), each)
    right = np.arange(len(left)) - np.repeat(np.cumsum(each) - each, each) + first_b[group_a[left]]
    group, pair = group_a[left], ids_a[left] * width + ids_b[right]
    many = np.ones(len(pair), dtype=np.int64)
    if not len(large):
        return group, pair, many
    parts = [(group, pair, many)]
    first_a = np.cumsum(n_a) - n_a
    for g in large.tolist():  # few distinct ids, each many times
        a, c = np.unique(ids_a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
        b, d = np.unique(ids_b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
        pair = (a[:, None] * width + b[None, :]).ravel()
        parts.append((np.full(len(pair), g), pair, (c[:, None] * d[None, :]).ravel()))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _packed(values: np.ndarray, kind: str) -> bytes:
    return zlib.compress(values.astype(kind).tobytes(), 1)


def _unpacked(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), dtype=kind)


#: One row for each block: its documents, and its pairs with the number of its documents that hold each.
#: ``docs`` holds how many pairs each document has, ``places`` which of the block's pairs
#: they are and ``times`` how often each is linked.
ALIGNED = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "shown array<string>, pairs array<long>, held array<long>, docs binary, places binary, times binary"
)


def align_block(pair: TokenPair, texts: list[str], digest: bool) -> dict:
    """The columns of ``ALIGNED`` but block and doc_id, for one block of texts."""
    ids_a, ids_b, n_a, n_b = pair.tokens(texts)
    group_a, group_b = coalesced(pair.sizes_a[ids_a], pair.sizes_b[ids_b])
    groups = int(group_a[-1]) + 1 if len(group_a) else 0
    at_a, at_b = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
    # texts follow one another without a gap, so a text's end closes its last group
    first_group = np.append(group_a, groups)[at_a]
    in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    links = np.concatenate([[0], np.cumsum(in_a * in_b)])

    # decimal ids with their separators, A before B in each group
    last_a, last_b = np.diff(group_a, append=groups) > 0, np.diff(group_b, append=groups) > 0
    line_a = ids_a * 3 + last_a
    line_b = ids_b * 3 + last_b + 3 * len(pair.bytes_a)
    line_b[at_b[1:][n_b > 0] - 1] += 1  # a text's last token has nothing after it
    before_b = np.concatenate([[0], np.cumsum(in_b)])
    after_a = np.cumsum(in_a)
    line = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    line[np.arange(len(ids_a)) + before_b[group_a]] = line_a
    line[np.arange(len(ids_b)) + (after_a[group_b] if len(ids_b) else 0)] = line_b
    find = pair.shown.__getitem__
    shown = ["".join(map(find, line[i:j].tolist())) for i, j in zip((at_a + at_b)[:-1].tolist(), (at_a + at_b)[1:].tolist())]
    if digest:
        shown = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in shown]

    group, code, many = linked(ids_a, ids_b, group_a, group_b, len(pair.bytes_b))
    doc = np.searchsorted(first_group[1:], group, side="right")
    pairs, place = np.unique(code, return_inverse=True)
    cells, which = np.unique(doc * max(len(pairs), 1) + place, return_inverse=True)
    times = np.bincount(which, weights=many, minlength=len(cells)).astype(np.int64)
    place = cells % max(len(pairs), 1)
    return {
        "n_a": n_a, "n_b": n_b, "n_groups": np.diff(first_group), "n_links": np.diff(links[first_group]), "shown": shown,
        "pairs": pairs, "held": np.bincount(place, minlength=len(pairs)),
        "docs": _packed(np.bincount(cells // max(len(pairs), 1), minlength=len(texts)), "<u4"),
        "places": _packed(place, "<u4"), "times": _packed(times, "<u4"),
    }


def _aligned(docs: DataFrame, byte_path: str, piece_path: str, block_bytes: int, digest: bool) -> DataFrame:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    shape = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in ALIGNED.split(", ")])

    def run(batches) -> Iterator[pa.RecordBatch]:
        pair, block = token_pair(byte_path, piece_path), TaskContext.get().partitionId() << TASK_SHIFT
        for part in slices(batches, "text", block_bytes):
            row = align_block(pair, [t or "" for t in part.column("text").to_pylist()], digest)
            row |= {"block": block, "doc_id": part.column("doc_id").to_pylist()}
            yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], type=f.type) for f in shape], schema=shape)
            block += 1

    return python_ready(docs).mapInArrow(run, ALIGNED)


def align_documents(
    docs: DataFrame,
    byte_path: str,
    piece_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    A are the tokens of a space and the text under the byte-level BPE file ``byte_path``, B
    those of the text under the SentencePiece file ``piece_path``, which adds that space.
    ``groups`` lists the groups in order as ``a1,a2|b1;a3|b2,b3`` (with ``digest`` its
    SHA-256 in hex, ''  without tokens). An id pair's count is the number of rows of
    ``docs`` in which it is linked; ``count_sum`` adds the counts of the row's links and
    ``n_best`` counts the links whose count is the highest of their A id, ties included.

    Null and empty texts, and texts whose joined token bytes differ on either side, have no
    tokens: zeros and ''. Repeated rows and null ids are rows like any other. Other columns
    are ignored, whatever their names. An empty table gives an empty result. A block holds
    about ``block_bytes`` of text or one text; links of a group are formed from distinct ids
    where they are many, so runs of one character cost no more than others.
    """
    name = "groups_sha256" if digest else "groups"
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = keep(_aligned(slim, byte_path, piece_path, block_bytes, digest), "aligned")
    own = blocks.select("block", F.explode(F.arrays_zip("pairs", "held")).alias("x"))
    own = own.select("block", F.col("x.pairs").alias("pair"), F.col("x.held").alias("held"))
    counts = own.groupBy("pair").agg(F.sum("held").alias("count"))
    width = _piece_count(piece_path)
    counts = keep(counts.withColumn("a", F.floor(F.col("pair") / width)), "pair-counts")
    # one row for each A id: bounded by the vocabulary
    best = counts.groupBy("a").agg(F.max("count").alias("best"))
    counts = counts.join(F.broadcast(best), "a").select("pair", "count", (F.col("count") == F.col("best")).alias("best"))
    told = own.select("block", "pair").join(counts, "pair").select("block", "pair", "count", "best")
    shape = f"doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, {name} string"

    def close(table, sums):
        row = table.slice(0, 1).to_pylist()[0]
        sums = sums.sort_by("pair")  # the block's pairs are sorted too
        count = sums.column("count").to_numpy()
        best = sums.column("best").to_numpy(zero_copy_only=False)
        place, times = (_unpacked(row[x], "<u4").astype(np.int64) for x in ("places", "times"))
        size = _unpacked(row["docs"], "<u4")
        doc = np.repeat(np.arange(len(size)), size)
        total = np.zeros((2, len(size)), dtype=np.int64)
        if len(place):
            np.add.at(total[0], doc, times * best[place])
            np.add.at(total[1], doc, times * count[place])
        columns = [row[x] for x in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        columns = [pa.array(x, type=pa.int64()) for x in (*columns, *total)]
        return pa.table([*columns, pa.array(row["shown"], type=pa.string())], names=[x.split()[0] for x in shape.split(", ")])

    slim = blocks.drop("pairs", "held").withColumnRenamed("block", "of")
    return slim.groupBy("of").cogroup(told.groupBy("block")).applyInArrow(close, shape)


def _piece_count(piece_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
