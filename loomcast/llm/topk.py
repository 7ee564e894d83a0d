"""Exact top-k inner products by buckets of vectors of similar length.

Vectors are sorted by length and cut into buckets. A query that already has k products
of at least t needs, in a bucket whose longest vector has length b, a cosine of at least
t / (|q| b). From this local threshold the bucket is skipped, or candidates are chosen by
length (vectors of at least t / |q|) or by coordinates (the query's strongest coordinates
confine those of a candidate to a range), whichever leaves fewer. Candidates' integer
products are then computed exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomcast.llm.common import keep, python_ready

K = 10
SCALE = 1024
#: Vectors of a bucket; vectors and queries of one cell of the grid.
BUCKET, CELL_VECTORS, CELL_QUERIES = 1024, 32_768, 4096
#: Longest vectors whose products give each query its first threshold.
SEEDS = 2048
#: Coordinates that confine candidates, and the share of the length rule's candidates
#: below which the coordinate rule is taken.
FOCUS, GAIN = 3, 0.25


def integer_vectors(column: pa.Array) -> np.ndarray:
    """floor(1024 x) of each component as doubles; shorter vectors are padded with zeros."""
    lists = [np.asarray(v, dtype=np.float64) for v in column.to_pylist()]
    out = np.zeros((len(lists), max((len(v) for v in lists), default=0)))
    for k, v in enumerate(lists):
        out[k, : len(v)] = np.floor(SCALE * v)
    return out


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer products (rows: queries)."""
    width = max(queries.shape[1], vectors.shape[1])
    queries, vectors = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (queries, vectors))
    largest = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(1, width)
    if largest < 2**53:
        return (queries @ vectors.T).astype(np.int64)
    if largest >= 2**62:
        raise ValueError("products of these vectors do not fit into a long")
    return queries.astype(np.int64) @ vectors.astype(np.int64).T


class Best:
    """The k best (score, id) of each query so far; ties to the smaller id."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k = k
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * queries
        self.floor = floor.astype(float)  # no lower score can be among the k best

    def offer(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.floor[query]
        if not good.any():
            return
        held, names = self.found[query]
        scores, ids = np.concatenate([held, scores[good]]), np.concatenate([names, ids[good]])
        if len(scores) > self.k:
            least = np.partition(scores, -self.k)[-self.k]
            scores, ids = scores[scores >= least], ids[scores >= least]
        order = np.lexsort((ids, -scores))[: self.k]
        self.found[query] = scores[order], ids[order]
        if len(order) == self.k:
            self.floor[query] = max(self.floor[query], float(scores[order[-1]]))


class Bucket:
    """Vectors of similar length, longest first, with their sorted coordinates."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray):
        self.ids, self.vectors, self.lengths = ids, vectors, lengths
        unit = vectors / np.maximum(lengths, 1e-300)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.sorted = np.take_along_axis(unit, self.order, axis=0)

    def ranges(self, unit: np.ndarray, cosine: float) -> list[tuple[int, int, int]]:
        """(coordinate, first, last) in the sorted coordinates for the query's strongest ones."""
        out = []
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            if f < self.sorted.shape[1]:
                q = float(unit[f])
                reach = math.sqrt(max(0.0, (1 - q * q) * (1 - cosine * cosine)))
                low, high = q * cosine - reach - 1e-9, q * cosine + reach + 1e-9
                # beyond the best cosine the range ends where the coordinate itself does
                low, high = (low, max(high, 1.0) if q * q >= cosine * cosine and q > 0 else high)
                low = min(low, -1.0) if q * q >= cosine * cosine and q < 0 else low
                column = self.sorted[:, f]
                out.append((int(f), int(np.searchsorted(column, low)), int(np.searchsorted(column, high, "right"))))
        return sorted(out, key=lambda x: x[2] - x[1])

    def search(self, vectors: np.ndarray, lengths: np.ndarray, names: np.ndarray, best: Best) -> None:
        """Offer all that this bucket has for the queries."""
        need = np.where(lengths > 0, best.floor / np.maximum(lengths, 1e-300), np.where(best.floor > 0, np.inf, -np.inf))
        by_length: list[int] = []
        for q in np.flatnonzero(need <= self.lengths[0] * (1 + 1e-12)):
            cosine = need[q] / self.lengths[0] if self.lengths[0] > 0 else 0.0
            if 0 < cosine <= 1:
                long_enough = int(np.searchsorted(-self.lengths, -need[q] * (1 - 1e-12), "right"))
                confined = self.ranges(vectors[q] / lengths[q], cosine)
                if confined and confined[0][2] - confined[0][1] < GAIN * long_enough:
                    mark = np.zeros(len(self.ids), dtype=np.int64)
                    for f, first, last in confined:
                        mark[self.order[first:last, f]] += 1
                    rows = np.flatnonzero(mark == len(confined))
                    rows = rows[(rows < long_enough) & (self.ids[rows] != names[q])]
                    if len(rows):
                        best.offer(q, products(vectors[q : q + 1], self.vectors[rows])[0], self.ids[rows])
                    continue
            by_length.append(int(q))
        if by_length:
            least = need[by_length].min()
            upto = len(self.ids) if least <= 0 else int(np.searchsorted(-self.lengths, -least * (1 - 1e-12), "right"))
            scores = products(vectors[by_length], self.vectors[:upto])
            for row, q in enumerate(by_length):
                others = self.ids[:upto] != names[q]
                best.offer(q, scores[row][others], self.ids[:upto][others])


def _valid(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)))


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = table.column("vec_id").combine_chunks().to_numpy()
    vectors = integer_vectors(table.column("vector").combine_chunks())
    return ids, vectors, np.sqrt((vectors * vectors).sum(axis=1))


def top_products(
    vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """For each query its k highest integer products: query_id, rank, vec_id, score.

    Candidates are all rows of ``vectors`` but those with the query's own id; ties go to the
    smaller id. Rows whose id or vector is null, or whose vector holds a null or non-finite
    component, take no part. Vectors of fewer components count as padded with zeros.
    A repeated candidate row can hold several ranks; of queries that share an id the
    smallest vector is asked. Other columns are ignored, whatever their names. Empty tables
    give an empty result. Raises if products could leave the range of a long.
    """
    rows = python_ready(_valid(vectors, id_col, vector_col))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    asked = keep(_valid(queries, id_col, vector_col).groupBy("vec_id").agg(F.min("vector").alias("vector")), "queries")
    n_rows, n_asked = rows.count(), asked.count()
    # the longest rows, a fixed number of them, show each query what it can expect
    seeds = rows.orderBy(length.desc(), "vec_id").limit(SEEDS).toArrow()
    seed_ids, seed_vectors, _ = _arrays(seeds)
    cells, groups = max(1, math.ceil(n_rows / CELL_VECTORS)), max(1, math.ceil(n_asked / CELL_QUERIES))
    slots = max(cells, vectors.sparkSession.sparkContext.defaultParallelism)

    def cell(table_of, queries_of):
        out = {"query_id": [], "vec_id": [], "score": []}
        if table_of.num_rows and queries_of.num_rows:
            ids, points, lengths = _arrays(table_of)
            names, asked_for, sizes = _arrays(queries_of)
            first = products(asked_for, seed_vectors)
            floor = np.full(len(names), -np.inf)
            for q, name in enumerate(names):
                own = first[q][seed_ids != name]
                if len(own) >= k:
                    floor[q] = np.partition(own, -k)[-k]
            best = Best(len(names), k, floor)
            order = np.lexsort((ids, -lengths))
            for start in range(0, len(order), BUCKET):
                part = order[start : start + BUCKET]
                if (lengths[part[0]] * sizes >= best.floor * (1 - 1e-12)).any() or (best.floor <= 0).any():
                    Bucket(ids[part], points[part], lengths[part]).search(asked_for, sizes, names, best)
            for name, (scores, found) in zip(names.tolist(), best.found):
                out["query_id"] += [name] * len(scores)
                out["vec_id"] += found.tolist()
                out["score"] += scores.tolist()
        return pa.table({c: pa.array(v, type=pa.int64()) for c, v in out.items()})

    # a grid: each cell holds a share of the vectors, bucketed by length there, and a share of the queries
    placed = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(slots)).cast("int").alias("slot"), "vec_id", "vector")
    placed = placed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    dealt = asked.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int"))
    dealt = dealt.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    keys = ["slot", "part"]
    found = placed.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(cell, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

