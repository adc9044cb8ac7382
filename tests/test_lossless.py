"""Loads and sheets that used to lose data: other columns, reruns, other spellings, late headers."""

from pyspark.sql import functions as F

from lakework.functions.clean import loose_date
from lakework.functions.columns import conform
from lakework.operators import invoices as I
from lakework.sources import publish as PB
from lakework.sources import readers as RD
from tests.conftest import rows


def test_accumulating_current_keeps_columns_of_either_side(spark, tmp_path):
    for buckets in (None, 4):
        root = f"{tmp_path}/{buckets}"
        loads = [
            spark.createDataFrame([("a", 1, "x", 1), ("b", 2, "y", 1)], "k string, v int, extra string, __load_seq int"),
            spark.createDataFrame([("b", 3, 2), ("c", 4, 2)], "k string, v int, __load_seq int"),
            spark.createDataFrame([("c", 5, True, 3)], "k string, v int, late boolean, __load_seq int"),
        ]
        for i, load in enumerate(loads):
            out = PB.publish_accumulating(spark, load, root, "gold", "t", ["k"], run_id=f"r{i}", buckets=buckets)
        assert rows(out, "k", "v", "extra", "late") == [("a", 1, "x", None), ("b", 3, None, None), ("c", 5, None, True)]


def test_rerun_replaces_its_own_history(spark, tmp_path):
    df = spark.createDataFrame([("A", 1)], "vendor string, v int")
    for run in ("r1", "r2", "r1"):
        PB.publish_history(df, str(tmp_path), "gold", "t", run_date="2026-01-01", run_id=run, partitions=["vendor"])
    assert rows(RD.read_history(spark, str(tmp_path), "gold", "t"), "run_id", "v") == [("r1", 1), ("r2", 1)]


def test_previous_run_is_before_the_current_one(spark):
    h = spark.createDataFrame([("r1", "2026-01-01", 1), ("r2", "2026-01-02", 2), ("r3", "2026-01-03", 3)], "run_id string, run_date string, v int")
    assert rows(RD.previous_run(h, "r2"), "v") == [(1,)]
    assert rows(RD.previous_run(h, "new"), "v") == [(3,)]
    assert rows(RD.previous_run(h, "r1"), "v") == []


def test_sheet_spellings_and_late_headers(spark):
    sheet = [("m", 200, 0, "FLOC ID"), ("m", 200, 1, "FlightDate"), ("m", 200, 2, "BLOCK_ID"), ("m", 201, 0, "XX-1"), ("m", 201, 1, "1/2/2026"), ("m", 201, 2, "D1")]
    cells = spark.createDataFrame(sheet, "message_id string, row_idx int, col_idx int, value string")
    lines = I.canonical_lines_v2(I.line_table(cells, I.header_row_v2(cells), I.LINE_COLS_V1))
    assert rows(lines, "floc_id", "flight_date", "block_id", "floc_is_valid_oh") == [("XX-1", "1/2/2026", "D1", False)]


def test_dirty_values_and_bare_years(spark):
    df = spark.createDataFrame([("12", "2026"), ("x", "x12026-01-015"), (None, "sent 2026-01-05.")], "n string, d string")
    out, missing, extra = conform(df, spark.createDataFrame([], "n int, z string").schema)
    assert rows(out, "n") == [(12,), (None,), (None,)] and missing == ["z"] and extra == ["d"]
    assert rows(df.select(loose_date(F.col("d")).alias("d")), "d") == [("2026",), ("2026-01-05",), ("x12026-01-015",)]


def test_delta_compares_columns_not_joined_text(spark):
    from lakework.operators.delta import key_delta

    schema = "_key string, _is_active boolean, a string, b string"
    prev = spark.createDataFrame([("k", True, "a|b", "c"), ("l", True, None, "x")], schema)
    cur = spark.createDataFrame([("k", True, "a", "b|c"), ("l", True, "", "x")], schema)
    assert rows(key_delta(prev, cur), "_key", "_delta_type") == [("k", "updated_active")]


def test_scratch_on_a_cluster_needs_a_shared_folder():
    import pytest

    from lakework.session import checkpoint_dir

    class Conf(dict):
        pass

    class Cluster:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(ValueError):
        checkpoint_dir(Cluster())
