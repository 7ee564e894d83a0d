import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from loomcast.llm import lm
from tests.llm.conftest import no_documents, some_words


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w for w in re.split("[ \t-\r]+", text) if w] + ["\n"]


def brute(rows, mass=lm.MASS):
    out_of = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    words, pairs, starts = Counter(), Counter(), 0
    for i, text in rows:
        if not out_of(i):
            words.update(tokens(text))
            pairs.update(zip(["start"] + tokens(text), tokens(text)))
            starts += 1
    total, known = sum(words.values()), len(words)
    unigram = lambda w: (words[w] + 0.1) / (total + 0.1 * (known + 1))
    result = []
    for i, text in rows:
        own = tokens(text)
        base = score = 0.0
        for state, word in zip(["start", *own], own):
            count = starts if state == "start" else words[state]
            base += math.log10(unigram(word))
            score += math.log10((pairs[state, word] + mass * unigram(word)) / (count + mass))
        result.append((i, out_of(i), len(own), sum(words[w] > 0 for w in own), total, base, score))
    return result


def same(got, want):
    got, want = sorted(map(tuple, got)), sorted(want)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    np.testing.assert_allclose([x[5:] for x in got], [x[5:] for x in want], rtol=1e-9)


def test_odd_texts(odd):
    table, rows = odd
    same(lm.score_documents(table).collect(), brute(rows))


@pytest.mark.parametrize("block_bytes", [1 << 12, 1 << 24])
def test_blocks_do_not_matter(spark, block_bytes):
    rows = [(k, " ".join(some_words(k % 70, 5 + k))) for k in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same(lm.score_documents(table, block_bytes=block_bytes).collect(), brute(rows))


def test_a_history_is_a_distribution():
    """Arcs, failure arc and the unknown word's share sum to one in every state."""
    rows = [(k, " ".join(some_words(k, 30))) for k in range(30)]
    train = [t for k, t in rows if zlib.crc32(str(k).encode()) % 10]
    words, pairs = Counter(), Counter()
    for t in train:
        words.update(tokens(t))
        pairs.update(zip(["start"] + tokens(t), tokens(t)))
    total, known, mass = sum(words.values()), len(words), lm.MASS
    unigram = lambda w: (words[w] + 0.1) / (total + 0.1 * (known + 1))
    for state in ["start", *sorted(words)[:5]]:
        count = len(train) if state == "start" else words[state]
        whole = sum((pairs[state, w] + mass * unigram(w)) / (count + mass) for w in [*words, "unknown"])
        if state != "\n":
            assert abs(whole - 1) < 1e-9


def test_empty_tables(spark):
    assert lm.score_documents(no_documents(spark)).count() == 0
    alone = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0)
    row = lm.score_documents(spark.createDataFrame([(alone, "a b")], "doc_id long, text string")).first()
    assert row.held_out and row.n_known == 0 and row.train_tokens == 0


def test_packed_lists_round_trip():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64) * np.uint64(2))
    assert (lm._unpacked(lm._packed(keys)) == keys).all()
    counts = np.arange(5000)
    assert (lm._unpacked_counts(lm._packed_counts(counts)) == counts).all()
