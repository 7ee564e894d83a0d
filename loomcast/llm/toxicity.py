"""Toxicity grades by cumulative-link ordinal regression on sparse words.

Grades are ordered: 0 clean, 1 toxic, 2 toxic and of poor quality. One weight vector is
shared by all thresholds: P(grade <= k) = sigmoid(threshold_k - w . x). x marks the
words that a window of the text holds, and the words and word beginnings that it holds
twice. The windows cover the whole text and the most severe one counts, so a toxic
passage weighs the same in a short text and in a long clean one. No weight is negative:
clean words beside a passage take nothing from it. An L1 penalty leaves weight only on
features that carry the grade.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import keep, python_ready, slices

#: Labelled rows used for the fit: those with the smallest hash of (doc_id, seed).
SAMPLE_ROWS = 6000
#: Features the fit starts from: the most telling ones of the sample.
WORDS = 4096
#: A feature must occur in this many texts of the sample.
LEAST_TEXTS = 5
#: Features that may enter by chance, of all that were tried.
CHANCE = 0.05
#: A feature needs about this share of the sample's texts to carry weight: 6 of 6,000.
L1 = 0.001
#: Penalty on squared weights when the chosen words are fitted again without the L1 shrinkage.
RIDGE = 0.00005
STEPS = 400
#: Copies among the sample's texts count once, so that one wrong label is not learnt many
#: times: texts that share a band of this many least shingle hashes are copies.
BANDS, BAND_ROWS, SHINGLE = 8, 3, 3
#: Expected severity from which a document is rejected.
REJECT_AT = 0.25

#: Words of a window. A window starts at every half of one, so that a passage of up to half
#: a window lies in one as a whole.
WINDOW = 128
#: Fits on each text's most severe window, after the first fit on whole texts.
REFITS = 2
#: Lengths of the word beginnings that count where they repeat.
BEGINNINGS = (4, 5, 6, 7)
#: Words whose features a scoring task remembers.
WORDS_HELD = 500_000

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """The lower-cased words: runs of letters."""
    return WORD.findall(text.lower())


def names_of(word: str) -> list[str]:
    """The features that a word counts for: itself (with a full stop) and its beginnings."""
    return [word + "."] + [word[:n] for n in BEGINNINGS if len(word) > n]


def window_features(text: str, names: Callable[[str], tuple[str, ...] | list[str]] = names_of) -> Iterator[set[str]]:
    """For each window: names of words held, and with % of words and beginnings held twice or more.

    ``names`` gives the names that a word counts for. Windows without any are left out.
    """
    words, half = words_of(text), WINDOW // 2
    told = {word: found for word in set(words) if (found := names(word))}
    if not told:
        return
    halves: dict[int, Counter] = {}
    for k, word in enumerate(words):
        if word in told:
            halves.setdefault(k // half, Counter()).update(told[word])
    last, none = max(0, -(-len(words) // half) - 2), Counter()
    for start in sorted({min(max(0, k), last) for own in halves for k in (own - 1, own)}):
        counts = halves.get(start, none) + halves.get(start + 1, none)
        yield {n for n in counts if n[-1] == "."} | {n + "%" for n, count in counts.items() if count >= 2}


def features_of(text: str) -> set[str]:
    """The features of all windows."""
    return set().union(*window_features(text))


@dataclass(frozen=True)
class OrdinalModel:
    weights: dict[str, float]  # by feature name; non-zero ones
    thresholds: tuple[float, ...]  # ascending, one fewer than there are grades
    known: dict[str, tuple[str, ...]] = field(default_factory=dict, compare=False, repr=False)

    def _telling(self, word: str) -> tuple[str, ...]:
        """The model's features that a word counts for; remembered."""
        names = self.known.get(word)
        if names is None:
            if len(self.known) > WORDS_HELD:
                self.known.clear()
            names = tuple(n for n in names_of(word) if n + "%" in self.weights or n in self.weights)
            self.known[word] = names
        return names

    def _score(self, text: str) -> float:
        scores = (sum(self.weights.get(n, 0.0) for n in sorted(held)) for held in window_features(text, self._telling))
        return max(scores, default=0.0)

    def severity(self, texts: list[str]) -> np.ndarray:
        """Expected grade of each text: the sum of P(grade > k) over the thresholds."""
        score = np.array([self._score(t) for t in texts], dtype=float)
        return sum(1 / (1 + np.exp(np.clip(cut - score, -50, 50))) for cut in self.thresholds) + 0 * score


def severity_grade(toxic: Column, quality: Column) -> Column:
    """0 clean, 1 toxic, 2 toxic and of poor quality; null where toxic is null."""
    poor = F.when(F.coalesce(quality, F.lit(1)) == 0, 1).otherwise(0)
    return F.when(toxic == 0, 0).when(toxic == 1, 1 + poor)


def fit_ordinal(
    lists: list[np.ndarray], grades: np.ndarray, width: int, l1: float = L1, ridge: float = 0.0, steps: int = STEPS,
    positive: bool = False,
):
    """Shared weights and ascending thresholds by accelerated proximal gradient.

    ``lists``: the words each text holds, as column numbers. Thresholds are kept in order
    through their gaps. Grades without a row are given the place of the next one.
    ``positive`` keeps all weights at zero or above.
    """
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    cols = np.concatenate(lists).astype(np.int64) if len(lists) else np.zeros(0, np.int64)
    top = int(grades.max()) if len(grades) else 0
    n, cuts = len(grades), max(1, top)
    share = np.array([(np.sum(grades <= k) + 0.5) / (n + 1) for k in range(cuts)])
    theta = np.log(share / (1 - share))
    w, z, momentum = np.zeros(width), np.zeros(width), 1.0
    if not n or top == 0:
        return w, np.full(cuts, 50.0)  # nothing is known to be toxic
    # a bound of the curvature: the largest row and column sums of the design
    per_row = np.bincount(rows, minlength=n).astype(float)
    bound = np.bincount(cols, weights=per_row[rows], minlength=width).max() / (4 * n) + 1e-9
    step = 1.0 / (bound + ridge)
    sigmoid = lambda a: 1 / (1 + np.exp(-np.clip(a, -50, 50)))
    for _ in range(steps):
        score = np.bincount(rows, weights=z[cols], minlength=n)
        high = np.where(grades < cuts, sigmoid(theta[np.minimum(grades, cuts - 1)] - score), 1.0)
        low = np.where(grades > 0, sigmoid(theta[np.maximum(grades - 1, 0)] - score), 0.0)
        mass = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / mass, low * (1 - low) / mass
        by_score = (d_high - d_low) / n  # of minus the log-likelihood
        by_cut = np.array([(-d_high[grades == k].sum() + d_low[grades == k + 1].sum()) / n for k in range(cuts)])
        grad = np.bincount(cols, weights=by_score[rows], minlength=width) + ridge * z
        moved = z - step * grad
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
        if positive:
            new = np.maximum(new, 0)
        ahead = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        z, w, momentum = new + (momentum - 1) / ahead * (new - w), new, ahead
        theta = np.maximum.accumulate(theta - 2.0 * by_cut)
        theta[1:] = np.maximum(theta[1:], theta[:-1] + 1e-6)
    return w, theta


def copy_bands(text: str) -> list[int]:
    """Hashes that near copies of a text share with high probability; none for an empty text."""
    words = words_of(text)
    if not words:
        return []
    grams = {" ".join(words[k : k + SHINGLE]) for k in range(max(1, len(words) - SHINGLE + 1))}
    base = np.array([xxhash.xxh64_intdigest(g) for g in grams], dtype=np.uint64)
    least = []
    for seed in range(BANDS * BAND_ROWS):
        mixed = (base ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xD6E8FEB86659FD93)
        least.append(int((mixed ^ (mixed >> np.uint64(32))).min()))
    return [hash((k, *least[k * BAND_ROWS : (k + 1) * BAND_ROWS])) for k in range(BANDS)]


def one_of_each(bands: list[list[int]], grades: list[int]) -> dict[int, int]:
    """Row number -> grade, for one row of each group of copies; the group's median grade."""
    root = list(range(len(bands)))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = k = root[root[k]]
        return k

    seen: dict[int, int] = {}
    for k, own in enumerate(bands):
        for band in own:
            a, b = top(seen.setdefault(band, k)), top(k)
            root[max(a, b)] = min(a, b)
    held: dict[int, list[int]] = {}
    for k, grade in enumerate(grades):
        held.setdefault(top(k), []).append(grade)
    return {k: sorted(g)[(len(g) - 1) // 2] for k, g in held.items()}


def _word_lists(batches):
    for part in slices(batches, "text"):
        texts = [t or "" for t in part.column("text").to_pylist()]
        columns = [
            part.column("doc_id"),
            part.column("grade"),
            pa.array([sorted(features_of(t)) for t in texts], type=pa.list_(pa.string())),
            pa.array([copy_bands(t) for t in texts], type=pa.list_(pa.int64())),
            part.column("text"),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "grade", "words", "bands", "text"])


def severest(lists: DataFrame, place: dict[str, int], weights: np.ndarray) -> pd.DataFrame:
    """Grade and feature numbers of each text's most severe window under ``weights``; none for a text without features."""

    def names(word: str) -> list[str]:
        return [n for n in names_of(word) if n in place or n + "%" in place]

    def run(batches):
        for part in slices(batches, "text"):
            found = []
            for text in part.column("text").to_pylist():
                held = (sorted(place[n] for n in own if n in place) for own in window_features(text or "", names))
                found.append(max(held, key=lambda own: weights[own].sum(), default=[]))
            columns = [part.column("grade"), pa.array(found, type=pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["grade", "words"])

    return lists.select("grade", "text").mapInArrow(run, "grade int, words array<int>").toPandas()


def _fit_twice(numbered: list[np.ndarray], grades: np.ndarray, width: int, l1: float):
    """Weights and thresholds: L1 chooses the features, which are fitted again without its shrinkage."""
    w, _ = fit_ordinal(numbered, grades, width, l1, positive=True)
    used = np.flatnonzero(w > 1e-6)
    again = np.full(width, -1)
    again[used] = np.arange(len(used))
    numbered = [again[x][again[x] >= 0] for x in numbered]
    short, theta = fit_ordinal(numbered, grades, max(1, len(used)), 0.0, RIDGE, 10 * STEPS, positive=True)
    w = np.zeros(width)
    w[used] = short[: len(used)]
    return w, theta


def telling(texts: int, toxic: int, rate: float, tried: int) -> bool:
    """Whether a feature is toxic in more of its texts than chance explains, given how many features were tried.

    The binomial tail is at most exp(-texts * KL(share, rate)); ``CHANCE`` features in all
    may pass by chance. Small samples have many features that only toxic texts happen to hold.
    """
    share = toxic / texts
    if not 0 < rate < share:
        return False
    part = (1 - share) * math.log((1 - share) / (1 - rate)) if share < 1 else 0.0
    return texts * (share * math.log(share / rate) + part) >= math.log(tried / CHANCE)


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    words: int = WORDS,
    l1: float = L1,
    seed: int = 1,
) -> OrdinalModel:
    """Fit on at most ``sample_rows`` labelled rows, chosen by hash.

    Every step is bounded by ``sample_rows``: the sample's ids are broadcast to the scan,
    word counts of its texts are summed by Spark, and only the numbers of the model's
    ``words`` reach the driver for the fit. The first fit is on whole texts, the next
    ones on each text's most severe window so far, which is what a score is made of. Repeated labels of a document use the highest
    grade; rows without a label, null texts and empty tables are harmless: with no toxic
    label at all the model has no weights.
    """
    graded = labels.select("doc_id", severity_grade(F.col("toxic"), F.col("quality")).alias("grade"))
    graded = graded.filter("grade is not null and doc_id is not null")
    first = graded.groupBy("doc_id").agg(F.max("grade").alias("grade"))
    chosen = first.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample_rows)
    slim = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "grade", "text")
    # a document id that is repeated must not raise the bound
    shape = "doc_id long, grade int, words array<string>, bands array<long>, text string"
    slim = slim.withColumn("doc_id", F.col("doc_id").cast("long"))
    sample = keep(python_ready(slim).mapInArrow(_word_lists, shape).limit(sample_rows), "grades")
    told = sample.select("doc_id", "grade", "bands").orderBy("doc_id").collect()
    single = one_of_each([row["bands"] for row in told], [row["grade"] for row in told])
    pairs = [(told[k]["doc_id"], grade) for k, grade in single.items()]
    chosen = docs.sparkSession.createDataFrame(pairs, "doc_id long, grade int")
    lists = sample.select("doc_id", "words", "text").dropDuplicates(["doc_id"]).join(F.broadcast(chosen), "doc_id")
    lists = keep(lists, "single")
    toxic = (F.col("grade") > 0).cast("long")
    sums = lists.agg(F.count(F.lit(1)).alias("n"), F.sum(toxic).alias("bad")).first()
    n, bad = sums["n"], sums["bad"] or 0
    counts = (
        lists.select(toxic.alias("t"), F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("c"), F.sum("t").alias("b"))
        .filter(F.col("c") >= LEAST_TEXTS)
    )
    rate = bad / n if n else 0.0
    # how far the toxic share of a word's texts lies from that of all, in deviations
    z = (F.col("b") - F.col("c") * rate) / F.sqrt(F.col("c") * max(rate * (1 - rate), 1e-9))
    counts = keep(counts, "feature-counts")
    tried = counts.count()
    told = counts.orderBy(z.desc(), "word").limit(words).collect()
    told = [row["word"] for row in told if telling(row["c"], row["b"], rate, tried)]
    place = {word: k for k, word in enumerate(sorted(told))}
    known = F.array(*[F.lit(w) for w in place]) if place else F.array().cast("array<string>")
    slim_lists = lists.select("grade", F.array_intersect("words", known).alias("words")).toPandas()
    grades = slim_lists["grade"].to_numpy(dtype=np.int64)
    numbered = [np.array([place[w] for w in ws], dtype=np.int64) for ws in slim_lists["words"]]
    w, theta = _fit_twice(numbered, grades, max(1, len(place)), l1)
    for _ in range(REFITS if w.any() else 0):
        windows = severest(lists, place, w)
        numbered = [np.array(own, dtype=np.int64) for own in windows["words"]]
        w, theta = _fit_twice(numbered, windows["grade"].to_numpy(dtype=np.int64), max(1, len(place)), l1)
    weights = {name: float(w[k]) for name, k in place.items() if w[k] > 1e-6}
    return OrdinalModel(weights, tuple(map(float, theta)))


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, severity (expected grade, double) and toxic (severity >= REJECT_AT) of every row.

    Null and empty texts hold no words. Whole texts are read; other columns are ignored.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for part in slices(batches, "text"):
            found = model.severity([t or "" for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(found, type=pa.float64())], names=["doc_id", "severity"]
            )

    kind = slim.schema["doc_id"].dataType.simpleString()
    scored = python_ready(slim).mapInArrow(run, f"doc_id {kind}, severity double")
    return scored.withColumn("toxic", F.col("severity") >= REJECT_AT)


def without_toxic(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not reject, all columns as they were."""

    @F.pandas_udf("double")
    def severity(texts: pd.Series) -> pd.Series:
        return pd.Series(model.severity([t or "" for t in texts]))

    return python_ready(docs).filter(severity(F.col(text_col)) < REJECT_AT)
