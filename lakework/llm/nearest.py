"""Approximate nearest neighbours with an inverted multi-index (operator 9).

Unit vectors are cut in two halves, each quantised by its own centroids; a
cell is a pair of centroids.  A query walks the pairs by the sum of both half
distances, smallest first, with a heap over the two sorted lists (the
multi-sequence order), until the cells it has seen hold a share of all vectors.  The
vectors of these cells are ranked by their exact cosine, in double precision.
The share is fitted with the centroids: within the sample, cells are walked as
far as ``RECALL`` of the true neighbours need.  Clustered vectors need little, vectors
without any structure about half.

Equal vectors are one entry that carries its smallest ids: more ids than a
query asks for (and its own) cannot be among its nearest, ties going to smaller ids.
Cells meet queries in blocks of bounded size on both sides.

Edge cases: vectors that are null, zero, hold null or non-finite
components, or differ in length from most, take no part, nor do rows with a null id; a query
gets fewer than ``k`` rows if there are fewer candidates.  Rows that repeat an
id and vector count once.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakework.llm.common import materialize, python_workers, smallest

#: Centroids of each half, fitted on at most ``SAMPLE`` distinct vectors; all vectors are indexed.
CENTROIDS = 16
SAMPLE = 20_000
ITERATIONS = 12
#: Share of a sample's true neighbours that the walk must reach, and the sample queries that measure it.
RECALL = 0.955
RECALL_QUERIES = 400
#: Largest number of vectors, and of queries, that meet in one task's matrix product.
BLOCK = 2048


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def entries(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v (array<double>) and a 128-bit key of the vector, of the rows that take part."""
    plain = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    # Adding zero turns -0.0 into 0.0.
    rows = plain.filter(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").limit(1).collect()
    if sizes:
        rows = rows.filter(F.size("v") == sizes[0]["n"])
    return rows.select("id", F.xxhash64("v").alias("k1"), F.xxhash64(F.lit("second"), "v").alias("k2"), "v")


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def centroids(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's iterations from k-means++ seeds."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    c = x[[rng.integers(len(x))]]
    near = ((x - c[0]) ** 2).sum(axis=1)
    for _ in range(k - 1):
        pick = rng.choice(len(x), p=near / near.sum()) if near.sum() > 0 else rng.integers(len(x))
        c = np.vstack([c, x[pick]])
        near = np.minimum(near, ((x - x[pick]) ** 2).sum(axis=1))
    for _ in range(ITERATIONS):
        of = distances(x, c).argmin(axis=1)
        for j in range(k):
            if (of == j).any():
                c[j] = x[of == j].mean(axis=0)
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(axis=1)[:, None] + (c**2).sum(axis=1) - 2 * x @ c.T, 0)


@dataclass
class MultiIndex:
    left: np.ndarray
    right: np.ndarray
    #: Distinct vectors in each cell, filled when all are assigned.
    sizes: np.ndarray
    #: Share of the vectors that a query's cells must hold.
    share: float = 1.0

    @property
    def half(self) -> int:
        return self.left.shape[1]

    def parts(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return distances(unit[:, : self.half], self.left), distances(unit[:, self.half :], self.right)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        a, b = self.parts(unit)
        return a.argmin(axis=1) * len(self.right) + b.argmin(axis=1)

    def walk(self, a: np.ndarray, b: np.ndarray, probe: int) -> list[int]:
        """Non-empty cells by summed distance until they hold ``probe`` vectors (multi-sequence order)."""
        i_of, j_of = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        heap, seen, out, held = [(a[i_of[0]] + b[j_of[0]], 0, 0)], {(0, 0)}, [], 0
        while heap and held < probe:
            _, i, j = heapq.heappop(heap)
            cell = int(i_of[i]) * len(b) + int(j_of[j])
            if n := int(self.sizes[cell]):
                out.append(cell)
                held += n
            for p, q in ((i + 1, j), (i, j + 1)):
                if p < len(a) and q < len(b) and (p, q) not in seen:
                    seen.add((p, q))
                    heapq.heappush(heap, (a[i_of[p]] + b[j_of[q]], p, q))
        return out


def fit(sample: np.ndarray, k: int = CENTROIDS, nearest: int = 5) -> MultiIndex:
    """Centroids and the share to walk, from a bounded sample."""
    unit = _unit(sample)
    half = max(1, unit.shape[1] // 2)
    left = centroids(unit[:, :half], k, 1)
    right = centroids(unit[:, half:], k, 2) if unit.shape[1] > half else np.zeros((1, 0))
    model = MultiIndex(left, right, np.zeros(len(left) * len(right), np.int64))
    cells = model.cells(unit)
    model.sizes = np.bincount(cells, minlength=len(model.sizes))
    needs = []
    for i in range(0, len(unit), max(1, len(unit) // RECALL_QUERIES)):
        score = unit @ unit[i]
        score[i] = -np.inf
        true = np.argpartition(-score, min(nearest, len(unit) - 1))[:nearest]
        order = model.walk(*(d[0] for d in model.parts(unit[i : i + 1])), len(unit))
        held = np.zeros(len(model.sizes))
        held[order] = np.cumsum(model.sizes[order]) - model.sizes[order]
        needs += [(held[cells[j]] + 1) / len(unit) for j in true if j != i]
    model.share = float(np.quantile(needs, RECALL)) if needs else 1.0
    model.sizes = np.zeros_like(model.sizes)
    return model


def search(vectors: DataFrame, query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest found for every row that ``query`` (over id) selects."""
    spark = vectors.sparkSession
    python_workers(spark, BLOCK)
    rows = materialize(entries(vectors, id_col, vector_col), "vectors")
    key = ["k1", "k2"]
    by_id = Window.partitionBy(*key).orderBy("id")
    firsts = rows.distinct().withColumn("no", F.row_number().over(by_id)).filter(F.col("no") <= k + 1)
    index = materialize(firsts.groupBy(*key).agg(F.array_sort(F.collect_list("id")).alias("ids"), F.first("v").alias("v")), "distinct-vectors")
    asked = materialize(rows.filter(query).select("id", *key).distinct(), "queries")
    n_distinct = index.count()
    sample = smallest(index.select("k1", "k2", "v"), ["k1", "k2"], {None: SAMPLE}, {None: n_distinct})
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not sample:
        return empty
    model = fit(np.array([r["v"] for r in sample]), nearest=k)

    def assign(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            cells = model.cells(_unit(_matrix(b.column(3)))) if b.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells.astype(np.int32))], ["k1", "k2", "ids", "v", "cell"])

    celled = materialize(index.mapInArrow(assign, "k1 long, k2 long, ids array<long>, v array<double>, cell int"), "cells")
    # One number for each pair of centroids, whatever the size of the table.
    for r in celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():
        model.sizes[r["cell"]] = r["n"]
    probe = max(k + 1, int(np.ceil(model.share * model.sizes.sum())))

    def visits(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if not b.num_rows:
                continue
            v = _matrix(b.column(2))
            a, c = model.parts(_unit(v))
            lists = [model.walk(x, y, probe) for x, y in zip(a, c)]
            at = pa.array(np.repeat(np.arange(len(lists)), [len(x) for x in lists]))
            cells = np.concatenate([np.array(x, np.int32) for x in lists])
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), b.column(2).take(at), pa.array(cells)], ["q1", "q2", "q", "cell"])

    distinct = index.join(asked.select(*key).distinct(), key, "left_semi").select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("v").alias("q"))
    visited = materialize(distinct.mapInArrow(visits, "q1 long, q2 long, q array<double>, cell int"), "visits")
    callers = np.zeros(len(model.sizes), np.int64)
    for r in visited.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():
        callers[r["cell"]] = r["n"]
    blocks = [int(-(-n // BLOCK)) or 1 for n in model.sizes]
    turns = [int(-(-n // BLOCK)) or 1 for n in callers]
    of = lambda values: F.element_at(F.lit(values), F.col("cell") + 1)
    every = lambda values, name: F.explode(F.sequence(F.lit(0), of(values) - 1)).alias(name)
    one = lambda values, *on: F.pmod(F.xxhash64(*on), of(values).cast("long")).cast("int")
    group = ["cell", "block", "turn"]
    left = celled.withColumn("block", one(blocks, *key)).select("cell", "block", every(turns, "turn"), "ids", "v")
    right = visited.withColumn("turn", one(turns, "q1", "q2")).select("cell", every(blocks, "block"), "turn", "q1", "q2", "q")

    def rank(held: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if held.empty or asks.empty:
            return pd.DataFrame({"q1": [], "q2": [], "vec_id": [], "score": []}).astype({"q1": "int64", "q2": "int64", "vec_id": "int64"})
        v, q = np.stack(held["v"].to_numpy()), np.stack(asks["q"].to_numpy())
        least = np.array([ids[0] for ids in held["ids"]])
        norms = np.linalg.norm(v, axis=1)
        score = (q @ v.T) / (np.linalg.norm(q, axis=1)[:, None] * norms)
        out = []
        for i, s in enumerate(score):
            if len(s) > k + 1:
                bound = np.partition(s, len(s) - k - 1)[len(s) - k - 1]
                near = np.flatnonzero(s >= bound - 1e-12)  # ties included
            else:
                near = np.arange(len(s))
            near = near[np.lexsort((least[near], -s[near]))]
            found = [(s[j], x) for j in near for x in held["ids"].iat[j]]
            found.sort(key=lambda p: (-p[0], p[1]))
            out += [(asks["q1"].iat[i], asks["q2"].iat[i], x, p) for p, x in found[: k + 1]]
        return pd.DataFrame(out, columns=["q1", "q2", "vec_id", "score"])

    near = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(rank, "q1 long, q2 long, vec_id long, score double")
    best = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "vec_id")
    top = materialize(near.withColumn("no", F.row_number().over(best)).filter(F.col("no") <= k + 1).drop("no"), "nearest")
    own = asked.select(F.col("id").alias("query_id"), F.col("k1").alias("q1"), F.col("k2").alias("q2"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    joined = own.join(top, ["q1", "q2"]).filter("vec_id <> query_id")
    ranked = joined.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
