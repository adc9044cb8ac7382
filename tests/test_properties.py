
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tools.compare_oracle import digest

SF = "/root/testdata/sf0.001"


def _digest(df):
    return digest(df.columns, [tuple(r) for r in df.collect()])[0]


@pytest.mark.parametrize("name,keys", [
    ("latest_event", ["vendor", "scope_floc_key"]),
    ("preferred_assignment", ["vendor", "scope_floc_key"]),
    ("scope_assignment_current", ["asset_class", "vendor", "scope_floc_key"]),
    ("deliveries_line", ["asset_class", "vendor", "floc", "folder"]),
    ("floc_dim_ranked", ["floc"]),
    ("invoice_upsert_current", ["message_id"]),
])
def test_top1_outputs_are_unique(spark, name, keys):
    df = entry.queries()[name](spark, SF)
    assert df.groupBy(*keys).count().filter("count > 1").count() == 0


def test_v2_approved_iff_no_blocker(spark):
    line = entry.queries()["invoice_eligibility_line"](spark, SF)
    bad = line.filter(
        (F.col("approved_to_invoice") & (F.col("block_reasons") != ""))
        | (~F.col("approved_to_invoice") & (F.col("block_reasons") == "") & (F.col("program_acronym") != "DIST_OTHER"))
    )
    assert bad.count() == 0
    assert line.filter((F.col("program_acronym") == "DIST_OTHER") & F.col("approved_to_invoice")).count() == 0


def test_summary_adds_up(spark):
    s = entry.queries()["eligibility_scope_summary"](spark, SF)
    assert s.filter(F.col("approved_count") + F.col("blocked_count") != F.col("floc_count")).count() == 0


@pytest.mark.parametrize("name", ["scope_assignment_current", "survey_rollup", "unit_price", "snapshot_delta", "invoice_lines_v1"])
def test_invariant_to_shuffle_partitions(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = _digest(entry.queries()[name](spark, SF))
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        b = _digest(entry.queries()[name](spark, SF))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b
