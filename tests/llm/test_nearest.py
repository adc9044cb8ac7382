import numpy as np
from pyspark.sql import functions as F

from lakework.llm import nearest
from lakework.llm.queries import op9_nearest

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, queries, k=5):
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], np.float32).astype(float)
    norm = np.linalg.norm(v, axis=1)
    out = {}
    for q in queries:
        at = int(np.flatnonzero(ids == q)[0])
        score = v @ v[at] / (norm * norm[at])
        best = sorted(((round(-s, 12), i, s) for i, s in zip(ids, score) if i != q))[:k]
        out[q] = [(int(i), s) for _, i, s in best]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_recall(spark):
    for sf in ("sf0.01", "sf0.1"):
        d = f"/root/testdata/{sf}"
        rows = [(r[0], r[1]) for r in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()]
        found = got(op9_nearest(spark, d))
        want = brute(rows, [i for i, _ in rows if i % 50 == 0])
        assert set(found) == set(want) and all(len(x) == 5 for x in found.values())
        hit = np.mean([len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / 5 for q in want])
        assert hit >= 0.9, hit
        exact = {q: dict(x) for q, x in want.items()}
        assert all(abs(s - exact[q][i]) < 1e-12 for q, x in found.items() for i, s in x if i in exact[q])


def test_copies_ties_and_own_row(spark):
    rng = np.random.default_rng(0)
    same = [1.0, 2.0, 0.0, -1.0]
    rows = [(i, same) for i in range(0, 400)] + [(1000 + i, rng.normal(size=4).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = got(nearest.search(df, F.col("id") % 50 == 0))
    want = brute(rows, [i for i, _ in rows if i % 50 == 0])
    for q in range(0, 400, 50):
        assert [i for i, _ in found[q]] == [i for i, _ in want[q]] == [i for i in range(7) if i != q][:5]


def test_blocks_do_not_change_results(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = got(nearest.search(df, F.col("id") % 5 == 0))
    monkeypatch.setattr(nearest, "BLOCK", 3)
    small = got(nearest.search(df, F.col("id") % 5 == 0))
    assert {q: [i for i, _ in x] for q, x in whole.items()} == {q: [i for i, _ in x] for q, x in small.items()}


def test_edge_rows(spark):
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [1.0, None]),
        (None, [1.0, 1.0]), (6, [1.0, 1.0, 1.0]), (7, [0.0, 1.0]), (8, [-0.0, 2.0]), (50, [1.0, 1.0]), (100, []),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("cell", F.lit(1))
    found = got(nearest.search(df, F.col("id") % 50 == 0))
    assert [i for i, _ in found[0]] == [50, 7, 8] and [i for i, _ in found[50]] == [0, 7, 8] and set(found) == {0, 50}
    assert nearest.search(df.limit(0), F.col("id") % 50 == 0).collect() == []


def test_walk_goes_by_summed_distance():
    model = nearest.MultiIndex(np.zeros((3, 1)), np.zeros((3, 1)), np.ones(9, int))
    a, b = np.array([0.3, 0.1, 0.7]), np.array([0.5, 0.2, 0.9])
    sums = [a[c // 3] + b[c % 3] for c in model.walk(a, b, 9)]
    assert sums == sorted(sums) and len(sums) == 9 and len(model.walk(a, b, 4)) == 4
