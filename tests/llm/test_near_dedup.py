import random

import numpy as np
import pytest

from loomcast.llm import near_dedup
from loomcast.llm.components import components
from loomcast.llm.shingles import shingle_sets
from tests.llm.conftest import no_documents, some_words

import pyarrow as pa
import re


def shingles(text):
    words = [w for w in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = {i: i for i, _ in rows}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((top(rows[a][0]), top(rows[b][0])))
                root[y] = x
    return sorted((i, len(s), top(i), top(i) == i) for (i, _), s in zip(rows, sets))


def changed(words, draw, times):
    words = list(words)
    for _ in range(times):
        words[draw.randrange(len(words))] = draw.choice(["new", "other", "third"]) + str(draw.randrange(1000))
    return words


@pytest.fixture(scope="module")
def groups():
    """A large group round one text, chains, texts at 0.6 to 0.9 of a template, exact and cased copies."""
    draw, rows = random.Random(3), []
    base = some_words(5, 300)
    rows += [" ".join(changed(base, draw, draw.randrange(0, 9))) for _ in range(90)]
    chain = some_words(6, 200)
    for _ in range(25):
        chain = changed(chain, draw, 2)
        rows.append(" ".join(chain))
    frame = some_words(7, 150)
    rows += [" ".join(frame + some_words(100 + k, 40)) for k in range(40)]
    rows += ["A b c d e f", "a B c d e f", "a b c d e f g", "a b", "A  b", "", None, " ".join(base).upper()]
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block, hubs", [(512, 3), (8, 1), (16, 0)])
def test_components_equal_brute_force(spark, groups, monkeypatch, block, hubs):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "HUB_ROUNDS", hubs)
    monkeypatch.setattr(near_dedup, "TASK_ROWS", 500)
    monkeypatch.setattr(near_dedup, "FIRST_CHECKS", 1)
    table = spark.createDataFrame(groups, "doc_id long, text string")
    assert sorted(map(tuple, near_dedup.near_duplicates(table).collect())) == brute(groups)


def test_odd_texts(odd):
    table, rows = odd
    assert sorted(map(tuple, near_dedup.near_duplicates(table).collect())) == brute_of_rows(rows)
    left = near_dedup.without_near_copies(table)
    assert left.columns == table.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(x[0] for x in brute_of_rows(rows) if x[3])


def brute_of_rows(rows):
    by_id = {x[0]: x for x in brute(sorted(dict(rows).items()))}
    return sorted(by_id[i] for i, _ in rows)


def test_empty_table_and_null_ids(spark):
    assert near_dedup.near_duplicates(no_documents(spark)).count() == 0
    table = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (2, "a b c")], "doc_id long, text string")
    got = [(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(table).collect()]
    assert sorted(got, key=str) == sorted([(None, None, True), (None, None, True), (2, 2, True)], key=str)


def test_sketch_estimates(spark):
    draw = random.Random(1)
    base = some_words(9, 2000)
    for times in (0, 10, 60, 200):
        a, b = shingle_sets(pa.array([" ".join(base), " ".join(changed(base, draw, times))]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        codes = [near_dedup.registers(x)[None] for x in (a, b)]
        sizes = [np.array([float(len(x))]) for x in (a, b)]
        got = near_dedup.worth_checking(*codes, *sizes)[0]
        assert (got >= 0 or true < 0.85) and (got < 0 or abs(got - true) < 0.2)
    assert (near_dedup.registers(a[:0]) == near_dedup.EMPTY).all()


def test_contraction_finds_components(spark):
    draw = random.Random(4)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, k) for k in range(1900, 1950)]
    root = {}
    top = lambda k: k if root.setdefault(k, k) == k else top(root[k])
    for a, b in links:
        if a != b:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == {k: top(k) for k in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def blocks_written(spark, rows, monkeypatch):
    """The result, and the rows that were written for the block comparison."""
    counts, keep = {}, near_dedup.keep

    def counted(df, name):
        out = keep(df, name)
        counts[name] = out.count() if name == "blocks" else 0
        return out

    monkeypatch.setattr(near_dedup, "keep", counted)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    monkeypatch.setattr(near_dedup, "keep", keep)
    return sorted(map(tuple, got)), counts["blocks"]


def test_a_common_template_does_not_grow_with_the_square(spark, monkeypatch):
    """Texts at 0.6 of each other, with a few links among them."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    monkeypatch.setattr(near_dedup, "ODD_BLOCKS", 4, raising=False)
    frame, draw = some_words(8, 150), random.Random(9)
    texts = [frame + some_words(900_000 + k, 40) for k in range(320)]
    texts += [changed(texts[k], draw, 1) for k in range(0, 320, 20)]
    rows = [(k, " ".join(words)) for k, words in enumerate(texts)]
    got, blocks = blocks_written(spark, rows, monkeypatch)
    assert got == brute(rows)
    assert blocks < 10 * len(rows)


def test_many_outsiders_equal_brute_force(spark, groups, monkeypatch):
    """Rare shingles in place of bands, with groups that stay large under them as well."""
    monkeypatch.setattr(near_dedup, "HUB_ROUNDS", 0)
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    for most in (1, 8):
        monkeypatch.setattr(near_dedup, "ODD_BLOCKS", most)
        got, _ = blocks_written(spark, groups, monkeypatch)
        assert got == brute(groups)
