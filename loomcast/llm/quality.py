"""Text quality from supervised subword embeddings.

A text's features are its words, its pairs of neighbouring words and the character n-grams
of its words (with the space before and after as their edges), each hashed to a bucket. A
bucket has a learned vector; the mean of the vectors of all features of the whole text,
repeats included, goes through a softmax layer. Case and signs are kept, and two equal
neighbours share one bucket, as a repeated word says more than which word it is.

Vectors and layer are trained together by stochastic gradient descent in numpy: the
labelled sample is dealt to shards, each round every shard steps through its texts one by
one from the common parameters, and the shards' results are averaged. A score needs only
one number for each bucket, the difference of the two classes' products with its vector.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import python_ready, slices
from loomcast.llm.shingles import mixed
from loomcast.session import scratch_path

#: Labelled rows used for the fit: those with the smallest hash of (doc_id, seed).
SAMPLE_ROWS = 6000
#: Buckets and numbers in a bucket's vector.
BUCKETS, DIM = 1 << 15, 8
#: Lengths of the character n-grams.
GRAMS = (3, 4, 5)
#: Rounds, after each of which the shards' parameters are averaged; step size in the first
#: one; shards; and steps in all, for which small samples are passed several times a round.
ROUNDS, RATE, SHARDS, STEPS = 8, 0.5, 4, 30_000
#: Score from which a text is predicted to be good.
GOOD_AT = 0.3
#: Rows whose crc32(doc_id as text) has this remainder are held out of training.
FOLDS = 5

_U = np.uint64
_MULTIPLIER = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_REPEATED = _U(0x2545F4914F6CDD1D)
_POWERS: list[np.ndarray] = []
#: White space as splitters know it.
_BLANKS = np.array([*range(9, 14), 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def _powers(size: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < size:
        _POWERS.clear()
        for base in (_MULTIPLIER, _INVERSE):
            held = np.full(max(size, 1 << 16), base, dtype=np.uint64)
            held[0] = 1
            _POWERS.append(np.multiply.accumulate(held))
    return _POWERS


def features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket of each feature, first feature of each text and their end), one pair for each kind of feature."""
    data = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    at = np.cumsum([1, *(len(t) + 1 for t in texts)])  # where each text starts; a space stands before it
    size = len(data)
    blank = (data <= 32) & (data >= 28) | (data >= 9) & (data <= 13)
    if data.max(initial=0) > 127:
        blank |= np.isin(data, _BLANKS)
    data = np.where(blank, 32, data)
    up, down = _powers(size + 1)
    sums = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum(mixed(data.astype(np.uint64) + _U(1)) * up[:size], out=sums[1:])

    def hashed(start: np.ndarray, end: np.ndarray, kind: int) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * down[start] + _U(kind * 0xA0761D6478BD642F % 2**64))

    blanks = np.concatenate([[0], np.cumsum(blank)])  # blanks before each place
    start = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    end = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    words = hashed(start, end, 1)
    first = np.searchsorted(start, at)
    left, right = words[:-1], words[1:]
    pairs = np.where(left == right, _REPEATED, mixed(left * _MULTIPLIER + right))
    # a text's last word has no neighbour
    inside = np.ones(len(pairs), dtype=bool)
    inside[first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(words))] - 1] = False
    kept = np.concatenate([[0], np.cumsum(inside)])
    out = [(words, first), (pairs[inside], kept[np.minimum(first, len(pairs))])]
    for n in GRAMS:
        place = np.arange(max(size - n + 1, 0))
        # a blank may be an edge, not inside, and not all there is
        place = place[(blanks[place + n - 1] == blanks[place + 1]) & (blanks[place + n] - blanks[place] < n)]
        out.append((hashed(place, place + n, n), np.searchsorted(place, at - 1)))
    return [((h & _U(BUCKETS - 1)).astype(np.int64), where) for h, where in out]


def counted(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's buckets, ascending, and how many of its features fall into them."""
    parts = features(texts)
    out = []
    for k in range(len(texts)):
        own = np.concatenate([bucket[where[k] : where[k + 1]] for bucket, where in parts])
        out.append(np.unique(own, return_counts=True))
    return out


def _step(vectors: np.ndarray, layer: np.ndarray, buckets: np.ndarray, counts: np.ndarray, good: int, rate: float) -> None:
    """One step of gradient descent on one text, in place. ``layer`` has a row and, last, a bias for each class."""
    share = (counts / counts.sum()).astype(np.float32) if len(counts) else np.zeros(0, np.float32)
    hidden = share @ vectors[buckets]
    logits = layer[:, :-1] @ hidden + layer[:, -1]
    odds = np.exp(logits - logits.max())
    wrong = odds / odds.sum()
    wrong[good] -= 1
    back = wrong @ layer[:, :-1]
    layer[:, :-1] -= rate * np.outer(wrong, hidden)
    layer[:, -1] -= rate * wrong
    vectors[buckets] -= rate * np.outer(share, back)


@dataclass(frozen=True)
class QualityModel:
    """``weights``: how far one feature of a bucket speaks for the good class; ``bias`` without any."""

    weights: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        """The probability of the good class."""
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for bucket, where in features(texts):
            sums = np.concatenate([[0.0], np.cumsum(self.weights[bucket])])
            total += np.diff(sums[where])
            count += np.diff(where)
        return 1 / (1 + np.exp(-np.clip(self.bias + total / np.maximum(count, 1), -60, 60)))


SAMPLE = "place long, good int, buckets binary, counts binary"


def _packed(values: np.ndarray) -> bytes:
    return zlib.compress(values.astype("<i4").tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), dtype="<i4")


def _sampled(docs: DataFrame, chosen: DataFrame, seed: int) -> DataFrame:
    slim = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["_id"]).select("_id", "good", "text")
    slim = slim.select(F.xxhash64("_id", F.lit(seed)).alias("place"), "good", "text")

    def run(batches):
        for part in slices(batches, "text"):
            found = counted([t or "" for t in part.column("text").to_pylist()])
            raw = [pa.array([_packed(x) for x in column], type=pa.binary()) for column in zip(*found)]
            columns = [part.column(c) for c in ("place", "good")]
            yield pa.RecordBatch.from_arrays([*columns, *raw], names=[x.split()[0] for x in SAMPLE.split(", ")])

    # a document id that is repeated must not raise the bound
    return python_ready(slim).mapInArrow(run, SAMPLE).dropDuplicates(["place"])


def _walker(held: tuple[bytes, np.ndarray], rate: float, first: int, passes: int):
    """What a shard does in one round: steps from the common parameters ``held``."""

    def walk(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        own = np.frombuffer(zlib.decompress(held[0]), dtype=np.float32).reshape(BUCKETS, DIM).copy()
        top = held[1].copy()
        place = table.column("place").to_numpy().astype(np.uint64)
        good, buckets, counts = (table.column(c) for c in ("good", "buckets", "counts"))
        for again in range(first, first + passes):
            for k in np.argsort(mixed(place + _U(again)), kind="stable").tolist():
                _step(own, top, _unpacked(buckets[k].as_py()), _unpacked(counts[k].as_py()), good[k].as_py(), rate)
        yield from pa.table({"n": [len(place)], "vectors": [own.tobytes()], "layer": [top.tobytes()]}).to_batches()

    return walk


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS, seed: int = 1) -> QualityModel:
    """Fit on at most ``sample_rows`` labelled rows outside the held-out fold, chosen by hash.

    The sample's ids go to the scan, which turns its whole texts into bucket counts. Every
    round is one job: a shard's texts lie in one task, and only the parameters, whose size
    is fixed, come back. A document with labels of both kinds counts as poor; rows without
    a label, null ids, null texts and empty tables are harmless. Without any label the
    model scores every text 0.5, with one class only it leans to that class.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("good"))
    known = known.filter(F.col("_id").isNotNull() & F.col("good").isin(0, 1) & ~held_out(F.col("_id")))
    known = known.groupBy("_id").agg(F.min("good").alias("good"))
    chosen = known.orderBy(F.xxhash64("_id", F.lit(seed)), "_id").limit(sample_rows)
    # one folder a shard, so that no round moves the sample again
    path = scratch_path(docs.sparkSession, "quality")
    dealt = _sampled(rows, chosen, seed).withColumn("shard", F.pmod("place", F.lit(SHARDS)).cast("int"))
    dealt.write.partitionBy("shard").parquet(path)
    sample = docs.sparkSession.read.schema(f"{SAMPLE}, shard int").parquet(path)
    shards = [sample.where(F.col("shard") == k).drop("shard").coalesce(1) for k in range(SHARDS)]
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer = np.zeros((2, DIM + 1), dtype=np.float32)
    passes = max(1, math.ceil(STEPS / rounds / max(sample.count(), 1)))
    for done in range(rounds):
        rate = RATE * (1 - done / rounds)
        step = _walker((zlib.compress(vectors.tobytes(), 1), layer), rate, done * passes, passes)
        made = [shard.mapInArrow(step, "n long, vectors binary, layer binary") for shard in shards]
        found = reduce(DataFrame.unionAll, made).collect()
        if not found:
            break
        share = np.array([r["n"] for r in found]) / sum(r["n"] for r in found)
        mean = lambda name: sum(w * np.frombuffer(r[name], dtype=np.float32) for w, r in zip(share, found))
        vectors, layer = mean("vectors").astype(np.float32).reshape(BUCKETS, DIM), mean("layer").astype(np.float32).reshape(2, -1)
    lean = layer[1] - layer[0]
    return QualityModel((vectors @ lean[:-1]).astype(float), float(lean[-1]))


def score(docs: DataFrame, model: QualityModel, good_at: float = GOOD_AT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: better) and predicted (1 from ``good_at``) of every row.

    Null and empty texts, and those of white space, have no features and get the model's
    base rate. Whole texts are read; a null id counts as held out; repeated rows are scored
    as often as they come. Other columns are ignored, whatever their names.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for part in slices(batches, "text"):
            found = model.score([t or "" for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, type=pa.float64())], names=["doc_id", "score"])

    scored = python_ready(slim).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= good_at).cast("int").alias("predicted"),
    )
