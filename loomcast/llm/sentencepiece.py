"""SentencePiece BPE encoding by backtracking over Aho-Corasick matches, and decoding.

The ids are those of merging the best pair again and again. They are found without
merging the text: at each place the longest piece is taken that is compatible with the
piece before it (merging the two pieces' text anew must give these two pieces); a place
from which nothing fits is marked in a bit field and never tried again. Words between
which no piece can reach are encoded once each and remembered.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import python_ready, slices

SPACE = "▁"
#: Words and piece pairs remembered at once; beyond this they start anew.
WORDS_HELD, PAIRS_HELD = 600_000, 1_500_000

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

_OPEN: dict[str, PieceModel] = {}


class PieceModel:
    """A BPE model with byte fallback, identity normalisation and a leading space mark."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as model

        proto = model.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        kinds = {p.type for p in proto.pieces}
        if trainer.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("only BPE models with identity normalisation are covered")
        if not (norm.add_dummy_prefix and norm.escape_whitespaces) or kinds & {USER, UNUSED} or not trainer.byte_fallback:
            raise ValueError("only models with a space mark, byte fallback and no user pieces are covered")
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.ids = {p.piece: k for k, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.bytes = [0] * 256
        self.shown: list[bytes] = []
        for k, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.bytes[int(p.piece[1:-1], 16)] = k
            self.shown.append(p.piece.replace(SPACE, " ").encode() if p.type == NORMAL else b"")
        self.byte_of = {k: value for value, k in enumerate(self.bytes)}
        # neighbours that occur inside some piece; everywhere else a text can be cut
        self.inside = {piece[k : k + 2] for piece in self.score for k in range(len(piece) - 1)}
        self.cut_before_space = not any(x[1] == SPACE and x[0] != SPACE for x in self.inside)
        # a piece that merging cannot build never occurs as a whole
        self.reach = {p for p in self.score if len(p) == 1 or self.merged(p) == [p]}
        self.machine = ahocorasick.Automaton()
        for piece in self.reach:
            self.machine.add_word(piece, len(piece))
        self.machine.make_automaton()
        self.fits: dict[str, bool] = {}
        self.words: dict[str, tuple[int, str, bytes]] = {}  # plain words, without their mark
        self.marked: dict[str, tuple[int, str, bytes]] = {}  # words as they are
        self.parts: dict[str, tuple[list[int], bytes]] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces by merging: always the pair whose piece scores best, the leftmost of equals."""
        part = list(text)
        after = list(range(1, len(part))) + [-1]
        before = list(range(-1, len(part) - 1))
        queue: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            if left >= 0 and after[left] >= 0:
                joined = part[left] + part[after[left]]
                if joined in self.score:
                    heapq.heappush(queue, (-self.score[joined], left, joined))

        for k in range(len(part) - 1):
            offer(k)
        while queue:
            _, left, joined = heapq.heappop(queue)
            right = after[left]
            if not part[left] or right < 0 or part[left] + part[right] != joined:
                continue
            part[left], part[right] = joined, ""
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            offer(before[left])
            offer(left)
        return [p for p in part if p]

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the two pieces' joined text gives the two pieces again."""
        if left[-1] + right[0] not in self.inside:
            return True
        both = f"{left} {right}"
        known = self.fits.get(both)
        if known is None:
            if len(self.fits) > PAIRS_HELD:
                self.fits.clear()
            known = self.fits[both] = self.merged(left + right) == [left, right]
        return known

    def backtracked(self, text: str) -> list[str]:
        """The pieces of a text; characters without a piece stand for themselves."""
        size = len(text)
        at: list[list[int]] = [[] for _ in range(size)]  # lengths of the pieces that begin here, ascending
        for last, length in self.machine.iter(text):
            at[last - length + 1].append(length)
        failed = 0  # a bit for each place that leads nowhere
        starts: list[int] = []
        place, tried = 0, -1
        out: list[str] = []
        while place < size:
            lengths = at[place]
            if tried < 0:
                tried = len(lengths)
            chosen = ""
            if not lengths and tried == 0:
                piece = text[place]
                if not out or self.compatible(out[-1], piece):
                    chosen, tried = piece, -2
            while tried > 0:
                tried -= 1
                end = place + lengths[tried]
                if failed >> end & 1 and end < size:
                    continue
                piece = text[place:end]
                if not out or self.compatible(out[-1], piece):
                    chosen = piece
                    break
            if chosen:
                starts.append(tried)
                out.append(chosen)
                place, tried = place + len(chosen), -1
            else:
                if not out:
                    raise ValueError("no compatible pieces")
                failed |= 1 << place
                place -= len(out.pop())
                tried = max(0, starts.pop())
        return out

    def _part(self, text: str) -> tuple[list[int], bytes]:
        """Ids and shown bytes of a stretch that no piece crosses."""
        # equal scores of the space runs decide by place, which pairs cannot see
        pieces = self.merged(text) if SPACE * 2 in text else self.backtracked(text)
        ids: list[int] = []
        for piece in pieces:
            own = self.ids.get(piece)
            ids += [own] if own is not None else [self.bytes[b] for b in piece.encode()]
        return ids, b"".join(self.shown[k] or bytes([self.byte_of[k]]) for k in ids)

    def _stretches(self, word: str) -> list[str]:
        inside, last, out = self.inside, 0, []
        for k in range(1, len(word)):
            if word[k - 1 : k + 1] not in inside:
                out.append(word[last:k])
                last = k
        out.append(word[last:])
        return out

    def _learn(self, word: str) -> tuple[int, str, bytes]:
        if len(self.parts) > WORDS_HELD:
            self.parts.clear()
        ids: list[int] = []
        shown = b""
        for stretch in self._stretches(word):
            known = self.parts.get(stretch)
            if known is None:
                known = self.parts[stretch] = self._part(stretch)
            ids += known[0]
            shown += known[1]
        return len(ids), ",".join(map(str, ids)), shown

    def encode(self, text: str) -> tuple[int, str, bytes]:
        """Number of ids, the ids joined by commas, and their bytes with the leading space mark."""
        if not text:
            return 0, "", b""
        if len(self.words) + len(self.marked) > WORDS_HELD:
            self.words.clear()
            self.marked.clear()
        if self.cut_before_space and SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return self._joined(text.split(" "), SPACE)  # each word stands after one mark
        marked = SPACE + text.replace(" ", SPACE)
        words = re.findall(f"{SPACE}+[^{SPACE}]*", marked) if self.cut_before_space else [marked]
        return self._joined(words, "")

    def _joined(self, words: list[str], mark: str) -> tuple[int, str, bytes]:
        known = self.words if mark else self.marked
        for word in set(words).difference(known):
            known[word] = self._learn(mark + word)
        found = [known[word] for word in words]
        return sum([x[0] for x in found]), ",".join([x[1] for x in found]), b"".join([x[2] for x in found])


def decoded(raw: bytes) -> str:
    """The text of shown bytes: the leading space goes, each wrong byte is one U+FFFD."""
    raw = raw.removeprefix(b" ")
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return _lossy(raw)


def _lossy(raw: bytes) -> str:
    out, k = [], 0
    while k < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[k : k + size].decode())
                k += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            k += 1
    return "".join(out)


def piece_model(path: str) -> PieceModel:
    """One model a Python worker."""
    if path not in _OPEN:
        _OPEN[path] = PieceModel(path)
    return _OPEN[path]


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids (decimal, joined by commas), decoded.

    ``model`` is the path of a SentencePiece BPE file that every machine has. Ids are the
    library's without begin and end ids; ``decoded`` is the text of these ids. Null counts as
    empty: no ids, empty text. Repeated rows and null ids each get their row. Other columns
    are ignored, whatever their names. An empty table gives an empty result.
    """
    return _encoded(docs, model, id_col, text_col, False)


def encode_digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of what ``encode_documents`` returns."""
    return _encoded(docs, model, id_col, text_col, True)


def _encoded(docs: DataFrame, model: str, id_col: str, text_col: str, digest: bool) -> DataFrame:
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    names = ["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"]

    def run(batches):
        own = piece_model(model)
        for part in slices(batches, "text"):
            rows = []
            for text in part.column("text").to_pylist():
                count, ids, raw = own.encode(text or "")
                text = decoded(raw)
                if digest:
                    ids, text = (hashlib.sha256(x.encode()).hexdigest() for x in (ids, text))
                rows.append((count, ids, text))
            counts, ids, texts = zip(*rows)
            columns = [part.column("doc_id"), pa.array(counts, type=pa.int64()), pa.array(ids), pa.array(texts)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", *names])

    return python_ready(slim).mapInArrow(run, f"doc_id long, n_tokens long, {names[0]} string, {names[1]} string")
