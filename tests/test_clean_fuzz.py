"""Scalar functions against small Python statements of the same rules, on random text."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from lakework.functions import clean as C

WS = "\t\n\x0b\x0c\r \x85\xa0 　"
text = st.text(alphabet=st.sampled_from(list("ab1.-,$ ") + list(WS) + ["é", "N", "A", "/"]), max_size=12)


def run(spark, col, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(col.alias("o")).collect()]


@settings(max_examples=5, deadline=None)
@given(st.lists(text, min_size=1, max_size=40))
def test_clean_is_python_strip(spark, values):
    assert run(spark, C.clean("v"), values) == [v.strip() for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(text, min_size=1, max_size=40))
def test_null_tokens(spark, values):
    tokens = {"", "null", "none", "nan", "na", "n/a"}
    want = [None if v.strip().lower() in tokens else v.strip() for v in values]
    assert run(spark, C.null_tokens("v"), values) == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(text, st.integers(-1000, 1000).map(str), st.floats(-1e4, 1e4, allow_nan=False).map(lambda f: f"{f:.3f}")), min_size=1, max_size=40))
def test_int_truncating(spark, values):
    def py(v):
        s = v.strip()
        try:
            return int(float(s)) if s and re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", s) else 0
        except ValueError:
            return 0
    assert run(spark, C.to_int_truncating("v"), values) == [py(v) for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(text, min_size=1, max_size=40))
def test_number_in_text(spark, values):
    def py(v):
        m = re.search(r"(-?\d+(?:\.\d+)?)", v.replace(",", ""))
        return float(m.group(1)) if m else None
    assert run(spark, C.number_in_text("v"), values) == [py(v) for v in values]
