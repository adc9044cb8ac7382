"""Catalogue queries against their DuckDB oracles on the smallest driver tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from lakework.plans import catalog
from lakework.plans.roles import BASE_TABLES
from tools.compare_oracle import digest

SF = "/root/testdata/sf0.001"
@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_works_without_the_optional_operators(tmp_path):
    """The entry imports and lists the catalogue where the optional subpackage and its pipeline are not installed."""
    root = Path(entry.__file__).parent
    for name in ("__spark_entry__.py", *(str(f.relative_to(root)) for f in root.glob("lakework/**/*.py") if "llm" not in f.parts)):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text((root / name).read_text())
    code = "import __spark_entry__ as e; assert len(e.queries()) == len(e.oracle_sql()) >= 70"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


#: Whole jobs, run twice each; test_jobs has them on small inputs.
JOBS = {"eligibility_job", "invoice_job_v1", "invoice_job_v2"}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - JOBS))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    o_cols, o_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(s_cols, s_rows)[0] == digest(o_cols, o_rows)[0]


def test_entry_runs(spark):
    out = entry.entry(spark)
    assert out.count() >= 0 and "approved_to_invoice" in out.columns
