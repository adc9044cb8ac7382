import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from lakework.llm import urls
from lakework.llm.queries import ORACLE_SQL, SITE_RULES, op10_urls
from tests.llm.conftest import SF


def pattern(glob):
    parts = re.findall(r"\*\*|\*|[^*]", glob)
    return re.compile("".join(".*" if p == "**" else "[^/]*" if p == "*" else re.escape(p) for p in parts), re.DOTALL)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab/*.", max_size=70), min_size=1, max_size=6), st.lists(st.text("ab/.é", max_size=12), min_size=1, max_size=8))
def test_automaton_is_the_patterns(globs, texts):
    globs = [re.sub(r"\*{3,}", "**", g) for g in globs]
    got = urls.Automaton(globs).run(texts)
    assert got.tolist() == [[bool(pattern(g).fullmatch(t)) for g in globs] for t in texts]


def test_pages_by_sql(spark):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    want = sorted(c.execute(ORACLE_SQL["op10_urls"]).fetchall(), key=str)
    assert sorted(map(tuple, op10_urls(spark, SF).collect()), key=str) == want


def test_edge_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "example.com/en/"), (4, "http://"), (5, "HTTP://WWW.Example.COM/en/x?q#f"), (6, "x://example.com"),
        (7, "x://com/"), (8, "x://xcom/"), (9, "x://a.example.com/en/"), (10, "x://evil.org/a.com/"), (11, "x://a.net/es/1"), (12, "x://a.net/ES/1"),
        (13, "x://a.net?/es/"), (14, "x://a://b.com/"), (15, "x://b.com/\nnew" + "y" * 50_000), (15, "x://b.com/"), (None, "x://é.net/fr/é"),
        (16, "x://notexample.com/en/"), (17, "x://www.www.example.com/en/"),
    ]
    df = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, host string")
    rules = [urls.site_rule(*r) for r in SITE_RULES]
    got = {(r["id"], r["path"]): r for r in urls.judge(df, rules).collect()}
    by = {i: r for (i, _), r in got.items()}
    for i in (1, 2, 3, 4):
        assert (by[i]["host"], by[i]["path"], by[i]["rule"], by[i]["verdict"]) == ("", "", None, "allow")
    assert (by[5]["host"], by[5]["path"], by[5]["rule"], by[5]["verdict"]) == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert by[6]["rule"] is None and by[7]["rule"] == "com/" and by[8]["rule"] is None
    assert (by[9]["rule"], by[9]["verdict"]) == ("example.com/en/", "block")
    assert by[10]["rule"] is None and (by[11]["rule"], by[11]["verdict"]) == ("net/es/", "block") and by[12]["rule"] is None and by[13]["rule"] is None
    assert (by[14]["host"], by[14]["path"], by[14]["rule"]) == ("a:", "//b.com/", None)
    assert by[None]["rule"] == "net/fr/" and by[16]["rule"] == "com/" and by[17]["rule"] == "www.example.com/en/"
    assert len(got) == len(rows) and urls.judge(df.limit(0), rules).collect() == []
