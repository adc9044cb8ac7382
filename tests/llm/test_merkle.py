import hashlib
import zlib

import pytest

from lakework.llm import merkle
from lakework.llm.queries import op11_merkle
from tests.llm.conftest import SF

COLS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """Levels from nodes to their root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha(*last[i : i + 16]) for i in range(0, len(last), 16)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        begin = at - at % 16
        out.append((level[begin:at], level[at + 1 : begin + 16]))
        at //= 16
    return out


def brute(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    leaf = lambda r: sha(*map(field, r))
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {s: sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in names}
    trees = {s: climb([leaf(r) for r in ordered[s]]) for s in names}
    above = climb([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for at, r in enumerate(ordered[s]):
            steps = path(trees[s], at) + path(above, k)
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                node = leaf((*r[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4])))
            for before, after in steps:
                node = sha(*before, node, *after)
            proof = sha(*("".join(b + a) for b, a in steps))
            out.append((r[0], leaf(r), trees[s][-1][0], above[-1][0], proof, node, node == above[-1][0]))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def shown(df):
    return got(df.drop("sn", "rank"))


def test_documents(spark, documents):
    want = brute([tuple(r) for r in documents.select(*COLS).collect()])
    assert got(op11_merkle(spark, SF)) == want
    assert {r[6] for r in want} == {True, False}


def test_edge_rows(edge, nothing):
    rows = [tuple(r) for r in edge.select(*COLS).collect()]
    assert shown(merkle.manifest(edge)) == brute(rows)
    assert merkle.manifest(nothing).collect() == []
    assert shown(merkle.manifest(edge.filter("doc_id = 5"))) == brute([r for r in rows if r[0] == 5])


@pytest.mark.parametrize("sources", ["'only'", "concat('s', id % 3)", "if(id % 3 = 0, null, concat('s', id % 300))", "concat('s', id)"])
def test_many_levels(spark, sources, monkeypatch):
    """Small partitions, so that the exchange has several rounds, with partitions of all numbers of members."""
    monkeypatch.setattr(merkle, "LOCAL", 1)
    docs = spark.range(5000).selectExpr("id AS doc_id", f"{sources} AS source", "'en' AS lang", "5L AS n_chars", "concat('Text ', id) AS text")
    assert shown(merkle.manifest(docs)) == brute([tuple(r) for r in docs.select(*COLS).collect()])


def test_equal_rows_are_cut_over_tasks(spark):
    docs = spark.range(3000).selectExpr("1L AS doc_id", "'a' AS source", "'en' AS lang", "5L AS n_chars", "'Same' AS text")
    assert shown(merkle.manifest(docs)) == brute([tuple(r) for r in docs.select(*COLS).collect()])
    assert merkle.tampered_rows(docs).count() in (0, 3000)
