import numpy as np
import pytest

from loomcast.llm import topk


def brute(rows, asked, k=10):
    whole = lambda v: [int(np.floor(1024 * float(x))) for x in v]
    usable = lambda v: v is not None and all(x is not None and np.isfinite(x) for x in v)
    left = [(i, whole(v)) for i, v in rows if i is not None and usable(v)]
    out = []
    for q, v in asked:
        if q is not None and usable(v):
            best = sorted((-sum(a * b for a, b in zip(whole(v), w)), i) for i, w in left if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def shapes():
    draw = np.random.default_rng(1)
    for case, width in enumerate((8, 16, 2, 5)):
        base = draw.normal(size=(12, width))
        rows = base[draw.integers(0, 12, 1500)] + 0.1 * draw.normal(size=(1500, width))
        if case == 1:
            rows *= draw.lognormal(0, 1.0, size=(1500, 1))  # lengths vary: the length rule
        if case == 2:
            rows = np.round(rows)  # ties
        if case == 3:
            rows[:600] = rows[0]  # one very common vector
            rows[600:605] = 0
        yield [(k, [float(x) for x in v]) for k, v in enumerate(rows)]


@pytest.mark.parametrize("case", range(4))
@pytest.mark.parametrize("gain", [0.0, 0.25, 2.0])
def test_equals_brute_force(spark, monkeypatch, case, gain):
    for name, value in (("SEEDS", 64), ("CELL_VECTORS", 400), ("CELL_QUERIES", 10)):
        monkeypatch.setattr(topk, name, value)
    rows = list(shapes())[case]
    # the kernel itself, with either rule for candidates
    ids = np.array([k for k, _ in rows])
    points = np.floor(1024 * np.array([v for _, v in rows]))
    lengths = np.sqrt((points**2).sum(axis=1))
    monkeypatch.setattr(topk, "GAIN", gain)
    asked = np.flatnonzero(ids % 50 == 0)
    best = topk.Best(len(asked), 10, np.full(len(asked), -np.inf))
    order = np.lexsort((ids, -lengths))
    for start in range(0, len(order), 150):
        part = order[start : start + 150]
        topk.Bucket(ids[part], points[part], lengths[part]).search(points[asked], lengths[asked], ids[asked], best)
    got = [(int(ids[q]), r + 1, int(i), int(s)) for q, (scores, found) in zip(asked, best.found) for r, (s, i) in enumerate(zip(scores, found))]
    want = brute(rows, [rows[q] for q in asked])
    assert sorted(got) == want
    if gain == 0.25:
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        assert sorted(map(tuple, topk.top_products(table, table.filter("vec_id % 50 = 0")).collect())) == want


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (6, [0.0, 0.0]), (7, [3.0]), (None, [9.0, 9.0]), (8, [1.0, 2.0]), (8, [1.0, 2.0]), (100, [-1.0, 0.5])]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, score string, slot string")
    asked = [r for r in rows if r[0] is not None and r[0] % 4 == 0]
    got = sorted(map(tuple, topk.top_products(table, table.filter("vec_id % 4 = 0")).collect()))
    assert got == brute(rows, list({r[0]: r for r in asked}.values()))
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_products(none, none).count() == 0 and topk.top_products(table, none).count() == 0


def test_products_refuse_to_overflow():
    big = np.full((1, 2), 2.0**40)
    with pytest.raises(ValueError):
        topk.products(big, big)
    assert topk.products(np.full((1, 1), 2.0**30), np.full((1, 1), 2.0**30))[0, 0] == 2**60
