import zlib

import numpy as np
import pytest

from loomcast.llm import quality
from loomcast.llm.registry import QUERIES
from tests.llm.conftest import ODD_TEXTS, no_documents

FOLDER = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def named(text):
    """All features of a text, spelt out."""
    text = "".join(" " if c.isspace() else c for c in f" {text} ")
    words = text.split()
    out = [("word", w) for w in words]
    out += [("same",) if a == b else ("pair", a, b) for a, b in zip(words, words[1:])]
    for n in quality.GRAMS:
        for k in range(len(text) - n + 1):
            gram = text[k : k + n]
            if " " not in gram[1:-1] and gram.strip():
                out.append((n, gram))
    return out


TEXTS = [
    *(t or "" for t in ODD_TEXTS.values()), "a", " a ", "a a", "The cat The cat the", "x　y\xa0z", "é́ 日本 日本", "ab  ab\n\nab", "\x1cq\x1c", "\x00 \x01",
]


def test_features_stand_for_what_a_text_holds():
    texts = [t for t in TEXTS if len(t) < 400]
    found = quality.counted(texts)
    bucket = {}
    for text in texts:  # each feature alone, from a text that has just it and known ones
        (own,) = quality.counted([text])
        for name in set(named(text)):
            bucket.setdefault(name, set()).update(own[0].tolist())
    for text, (buckets, counts) in zip(texts, found):
        names = named(text)
        assert counts.sum() == len(names)
        assert sorted(counts)[::-1][:1] == [] or counts.max() >= max(names.count(x) for x in set(names))
        assert all(bucket[x] & set(buckets.tolist()) for x in names)
    alone = [quality.counted([t])[0] for t in texts]
    for (a, b), (c, d) in zip(found, alone):  # neighbours in a batch change nothing
        assert a.tolist() == c.tolist() and b.tolist() == d.tolist()


def test_equal_features_meet_and_others_part():
    def bucket(text):
        return dict(zip(*(x.tolist() for x in quality.counted([text])[0])))

    assert bucket("one two") == bucket("\none\t two ") and bucket("one two") != bucket("two one") and bucket("ONE") != bucket("one")
    same, other = bucket("x x"), bucket("y y")
    assert len(set(same) & set(other)) == 1  # the bucket of equal neighbours


@pytest.mark.parametrize("good", [0, 1])
def test_step_goes_down_the_gradient(good):
    draw = np.random.default_rng(1)
    vectors, layer = draw.normal(size=(6, 3)), draw.normal(size=(2, 4))
    buckets, counts = np.array([1, 4, 5]), np.array([2, 1, 3])

    def loss(v, u):
        hidden = (counts / counts.sum()) @ v[buckets]
        logits = u[:, :-1] @ hidden + u[:, -1]
        return np.log(np.exp(logits).sum()) - logits[good]

    for which in (0, 1):
        base = [vectors.copy(), layer.copy()]
        moved = [vectors.copy(), layer.copy()]
        quality._step(*moved, buckets, counts, good, 1e-3)
        gradient = (base[which] - moved[which]) / 1e-3
        for place in np.ndindex(base[which].shape):
            up, down = ([x.copy() for x in base] for _ in range(2))
            up[which][place] += 1e-5
            down[which][place] -= 1e-5
            assert abs((loss(*up) - loss(*down)) / 2e-5 - gradient[place]) < 1e-4


def test_score_is_the_softmax_of_the_mean_vector():
    draw = np.random.default_rng(2)
    vectors, layer = draw.normal(size=(quality.BUCKETS, quality.DIM)), draw.normal(size=(2, quality.DIM + 1))
    lean = layer[1] - layer[0]
    model = quality.QualityModel(vectors @ lean[:-1], lean[-1])
    for text, found in zip(TEXTS, model.score(TEXTS)):
        buckets, counts = quality.counted([text])[0]
        hidden = counts @ vectors[buckets] / max(counts.sum(), 1)
        odds = np.exp(layer[:, :-1] @ hidden + layer[:, -1])
        assert abs(found - odds[1] / odds.sum()) < 1e-9


def test_held_out_rows_are_told_apart(spark):
    found = {r.doc_id: r for r in QUERIES["op13_quality"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert found.keys() == {r.doc_id for r in docs.select("doc_id").collect()}
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.values())
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    held = [(truth[k], r.predicted) for k, r in found.items() if r.held_out and k in truth]
    assert len(held) > 50
    for label in (0, 1):
        own = [p == label for t, p in held if t == label]
        assert np.mean(own) >= 0.9


def test_labels_of_the_held_out_fold_teach_nothing(spark):
    docs = spark.createDataFrame([(k, "good words here" if k % 2 else "bad ### signs") for k in range(60)], "doc_id long, text string")
    honest = [(k, k % 2, 0) for k in range(60)]
    lying = [(k, 1 - q if zlib.crc32(str(k).encode()) % 5 == 0 else q, t) for k, q, t in honest]
    a, b = (quality.train(docs, spark.createDataFrame(rows, LABELS), rounds=2) for rows in (honest, lying))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_odd_rows(spark, odd):
    table, rows = odd
    table = table.union(table.limit(1).withColumn("doc_id", table.doc_id * 0 + 1).selectExpr("cast(null as long) as doc_id", *table.columns[1:]))
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, None), (6, None, 0), (None, 1, 0), (6, 0, 0), (6, 1, 0), (999, 1, 0), (52, 7, 0)], LABELS)
    found = quality.score(table, quality.train(table, labels, rounds=2)).collect()
    assert sorted(r.doc_id for r in found if r.doc_id is not None) == sorted(i for i, _ in rows)
    assert [r.held_out for r in found if r.doc_id is None] == [True]
    assert all(np.isfinite(r.score) for r in found)
    assert len({r.score for r in found if r.doc_id == 3}) == 1


def test_no_labels_and_no_rows(spark, odd):
    table, _ = odd
    none = quality.train(table, spark.createDataFrame([], LABELS))
    assert {r.score for r in quality.score(table, none).collect() if r.doc_id in (0, 1)} == {0.5}
    empty = no_documents(spark)
    model = quality.train(empty, spark.createDataFrame([(1, 1, 0)], LABELS))
    assert quality.score(empty, model).count() == 0
