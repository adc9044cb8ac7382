import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakework.llm import graph, neardup
from tests.llm.conftest import EDGE_ROWS


def brute(rows):
    """Classes over all pairs, by union and find."""
    sets = [set(neardup.shingles(t or "")[0].tolist()) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= neardup.SIMILARITY * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    out = []
    for i, (doc, _) in enumerate(rows):
        own = members[find(i)]
        rep = min((x for x in own if x is not None), default=None)
        out.append((doc, rep, len(own), doc == rep))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["id"], r["class_id"], r["class_size"], r["kept"]) for r in df.collect()), key=str)


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(0)
    sets = []
    for shared in (50, 80, 95):
        common = rng.integers(0, 1 << 63, shared).astype(np.uint64)
        for _ in range(2):
            own = rng.integers(0, 1 << 63, 100 - shared).astype(np.uint64)
            h = np.concatenate([common, own])
            sets.append((h, np.where(np.arange(100) < shared, 2.0, 1.0)))
    kept = neardup.registers(sets)
    for k, shared in enumerate((50, 80, 95)):
        total = 2 * shared + (100 - shared)
        # Shingles of both have equal weights and equal totals.
        want = 2 * shared / (total + (100 - shared))
        assert abs((kept[2 * k] == kept[2 * k + 1]).mean() - want) < 4 * math.sqrt(want * (1 - want) / neardup.REGISTERS)


def test_batches_do_not_change_registers():
    rng = np.random.default_rng(1)
    sets = [(rng.integers(0, 1 << 63, n).astype(np.uint64), np.ones(n)) for n in (1, 3, 40, 500)]
    together = neardup.registers(sets)
    assert all((neardup.registers([s])[0] == row).all() for s, row in zip(sets, together))


def test_documents(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert got(neardup.classes(documents)) == brute(rows)


def test_edge_rows(edge, nothing):
    assert got(neardup.classes(edge)) == brute([r[:2] for r in EDGE_ROWS])
    assert neardup.classes(nothing).collect() == []
    kept = neardup.drop_near_copies(edge)
    assert kept.columns == edge.columns and kept.filter("doc_id = 1").count() == 1 and kept.filter("doc_id = 2").count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_large_group_and_chains(spark, seed):
    """Copies with edits, chains whose ends are unlike, and pairs just below and above the threshold."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(150)]
    rows = []
    for _ in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = word()
        rows.append(" ".join(w))
    chain = [word() for _ in range(200)]
    for _ in range(12):
        rows.append(" ".join(chain))
        chain = chain[8:] + [word() for _ in range(8)]
    rows += [" ".join(word() for _ in range(rng.randint(1, 40))) for _ in range(30)]
    rows += rows[:5]
    data = list(enumerate(rows))
    assert got(neardup.classes(spark.createDataFrame(data, "doc_id long, text string"))) == brute(data)


def test_unequal_repetition(spark):
    """Copies of which one repeats a passage many times: alike as sets, far apart as weighted sets."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = []
    for _ in range(20):
        w = [word() for _ in range(100)]
        rows += [" ".join(w), " ".join(w[:70] + w[70:] * 200 + [word() for _ in range(6)])]
    data = list(enumerate(rows))
    want = brute(data)
    assert all(size == 2 for _, _, size, _ in want)
    assert got(neardup.classes(spark.createDataFrame(data, "doc_id long, text string"))) == want


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(50)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["label"] for r in graph.components(df).collect()}
    around = defaultdict(set)
    for a, b in edges:
        if a != b:
            around[a].add(b)
            around[b].add(a)
    seen = {}
    for node in around:
        if node not in seen:
            todo = [node]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen[x] = node
                    todo += around[x]
    assert set(found) == set(around)
    pairs = Counter((seen[n], found[n]) for n in found)
    assert len(pairs) == len({s for s, _ in pairs}) == len({f for _, f in pairs})
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []
