import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from lakework.llm import exact
from lakework.llm.queries import ORACLE_SQL
from tests.llm.conftest import EDGE_ROWS, SF


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_chunks_are_the_whole_text(spark, documents):
    whole = documents.filter(F.concat_ws("", exact.chunks(F.col("text"))) != F.col("text"))
    assert whole.count() == 0


def test_edge_rows(edge, nothing):
    assert got(exact.copies(edge)) == brute([r[:2] for r in EDGE_ROWS])
    assert exact.copies(nothing).collect() == []


def test_documents(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert got(exact.copies(documents)) == brute(rows)


def test_chunks_that_share_a_hash_are_told_apart(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    weak = lambda c: (F.length(c) % 3).cast("long")
    assert got(exact.copies(documents, hasher=weak)) == brute(rows)


def test_one_row_of_each_group_stays(edge):
    kept = exact.drop_copies(edge)
    assert kept.columns == edge.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({t or "" for _, t, *_ in EDGE_ROWS})
    assert [r["doc_id"] for r in kept.filter("text like 'The quick%'").collect()] == [2]


def test_sql(spark, documents):
    import duckdb

    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    assert got(exact.copies(documents)) == sorted(c.execute(ORACLE_SQL["op2_exact_dedup"]).fetchall(), key=str)


def test_plan_has_no_python(documents):
    plan = exact.copies(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
