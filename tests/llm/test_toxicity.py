import random

import numpy as np

from loomcast.llm import toxicity
from tests.llm.conftest import no_documents, some_words


def corpus(seed, count):
    """Clean texts, texts with insults, and texts with many words of one beginning; some labels are wrong."""
    draw, rows, labels = random.Random(seed), [], []
    for k in range(count):
        words = some_words(seed * 100_000 + k, draw.randrange(40, 200))
        kind = draw.choice([0, 0, 0, 0, 1, 2])
        if kind == 1:
            for _ in range(4):
                words.insert(draw.randrange(len(words)), draw.choice(["nasty", "vile", "rotten", "foul"]))
        if kind == 2:
            for _ in range(6):
                words.insert(draw.randrange(len(words)), "grimm" + draw.choice("abcdefgh") + draw.choice("xyz"))
        toxic = int(kind > 0)
        rows.append((k, " ".join(words)))
        labels.append((k, int(draw.random() < 0.9), toxic if draw.random() < 0.97 else 1 - toxic, toxic))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus(1, 900)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([x[:3] for x in labels], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, known)
    assert list(model.thresholds) == sorted(model.thresholds)
    rows, labels = corpus(2, 600)
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    truth = {k: t for k, _, _, t in labels}
    caught = [got[k].toxic for k in truth if truth[k]]
    wrong = [got[k].toxic for k in truth if not truth[k]]
    assert np.mean(caught) > 0.95 and np.mean(wrong) < 0.02


def test_the_bound_of_the_sample_holds(spark):
    rows, labels = corpus(3, 200)
    docs = spark.createDataFrame(rows * 3, "doc_id long, text string")
    known = spark.createDataFrame([x[:3] for x in labels], "doc_id long, quality int, toxic int")
    assert toxicity.train(docs, known, sample_rows=150).thresholds


def test_odd_texts(odd):
    table, rows = odd
    spark = table.sparkSession
    labels = spark.createDataFrame([(k, k % 2, int(k == 6)) for k in range(9)] + [(6, None, 1), (None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(table, labels)
    assert toxicity.score(table, model).count() == len(rows)
    assert toxicity.without_toxic(table, model).columns == table.columns
    empty = toxicity.train(no_documents(spark), labels.limit(0))
    assert empty.weights == {} and toxicity.score(no_documents(spark), empty).count() == 0
    assert toxicity.without_toxic(table, empty).count() == len(rows)


def test_thresholds_share_the_weights():
    draw = np.random.default_rng(1)
    x = (draw.random((4000, 3)) < 0.5).astype(int)
    score = x @ np.array([2.0, -1.0, 0.0]) + draw.logistic(size=4000)
    grades = (score > 0.5).astype(int) + (score > 2.0)
    w, theta = toxicity.fit_ordinal([np.flatnonzero(r) for r in x], grades, 3, 0.0, 0.0, 3000)
    np.testing.assert_allclose(w, [2, -1, 0], atol=0.2)
    np.testing.assert_allclose(theta, [0.5, 2.0], atol=0.25)


def test_copies_count_once():
    text = " ".join(some_words(4, 300))
    near = text.replace(" banx", " bann", 1)
    groups = toxicity.one_of_each([toxicity.copy_bands(t) for t in (text, near, " ".join(some_words(5, 300)), "")], [0, 1, 1, 0])
    assert len(groups) == 3


def test_a_toxic_passage_counts_in_a_long_clean_text(spark):
    """Recall by language, of words whose single forms are rare, with one passage in 6,000 clean words."""
    starts = {"en": "grimm", "de": "schlecht", "fr": "réeux", "es": "bomente"}
    forms = {lang: [start + a + b for a in "abcde" for b in "vwxyz"] for lang, start in starts.items()}
    draw, rows, labels = random.Random(5), [], []
    for k in range(1200):
        words, toxic = some_words(500_000 + k, draw.randrange(40, 200)), int(k % 6 == 0)
        if toxic:
            lang = draw.choice(list(forms))
            for _ in range(5):
                words.insert(draw.randrange(len(words)), draw.choice(forms[lang]))
        rows.append((k, " ".join(words)))
        labels.append((k, 1, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    for lang, own in forms.items():
        caught, wrong = [], []
        for k in range(20):
            clean = some_words(600_000 + k, 6000)
            at, passage = draw.randrange(len(clean)), some_words(700_000 + k, 30)
            for _ in range(4):
                passage.insert(draw.randrange(len(passage)), draw.choice(own))
            texts = [" ".join(clean[:at] + passage + clean[at:]), " ".join(clean)]
            hit, miss = model.severity(texts) >= toxicity.REJECT_AT
            caught.append(hit)
            wrong.append(miss)
        assert np.mean(caught) > 0.9 and not any(wrong), lang
