import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakework.operators.common import joined_unique, number_rows, top1
from tests.conftest import rows


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 500)), min_size=1, max_size=120, unique_by=lambda t: t))
def test_number_rows_matches_row_number(spark, data):
    df = spark.createDataFrame(data, "g string, pos int").repartition(random.choice([1, 3, 7]))
    got = rows(number_rows(df, ["g"], "pos", bucket_size=16), "g", "pos", "line_number")
    w = Window.partitionBy("g").orderBy("pos")
    want = rows(df.withColumn("line_number", F.row_number().over(w)), "g", "pos", "line_number")
    assert got == want


def test_top1_hot_key_and_total_order(spark):
    data = [("hot", i, f"x{i % 5}") for i in range(3000)] + [("cold", 1, "y")]
    df = spark.createDataFrame(data, "k string, v int, t string").repartition(8)
    out = top1(df, ["k"], [F.col("v").desc(), F.col("t").asc()])
    assert rows(out) == [("cold", 1, "y"), ("hot", 2999, "x4")]


def test_joined_unique_first_appearance(spark):
    df = spark.createDataFrame([("g", 3, "b"), ("g", 1, "a"), ("g", 2, "b"), ("g", 4, None), ("h", 1, None)], "g string, p int, v string")
    out = joined_unique(df.repartition(3), ["g"], {"vals": F.col("v")}, F.col("p"))
    assert rows(out) == [("g", "a;b")]


def test_joined_unique_in_one_shuffle_of_rows(spark):
    """Rows are unpivoted before the first shuffle, which carries distinct values and not combinations of them."""
    df = spark.createDataFrame([("g", i, f"a{i % 3}", f"b{i % 5}") for i in range(40)] + [("h", 50, None, None)], "g string, p int, v string, w string")
    out = joined_unique(df, ["g"], {"vs": F.col("v"), "ws": F.col("w")}, F.col("p"), stats={"n": ("count", F.col("v")), "last": ("max", F.col("p"))})
    assert rows(out) == [("g", "a0;a1;a2", "b0;b1;b2;b3;b4", 40, 39), ("h", None, None, 0, 50)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2
