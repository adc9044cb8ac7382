"""Plan shapes that the scale design relies on (read from explain output)."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from lakework.operators import pricing as P
from lakework.plans import catalog

SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", ["latest_event", "preferred_assignment", "deliveries_line", "floc_dim_ranked", "keep_last_per_message"])
def test_top1_limits_before_the_shuffle(spark, name):
    text = plan_text(catalog.QUERIES[name](spark, SF))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_no_python_evaluation_in_any_query(spark):
    for name, fn in catalog.QUERIES.items():
        if fn.__module__.endswith("lake_queries"):  # these publish when called; their plans are reads of what was published
            continue
        text = plan_text(fn(spark, SF))
        assert not any(p in text for p in ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "CartesianProduct")), name
        assert "RoundRobinPartitioning" not in text, name


def scans(df) -> int:
    """Table reads of a plan, those that another one's exchange serves included."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


@pytest.mark.parametrize("name,most", [
    ("invoice_eligibility_line", 8), ("eligibility_scope_summary", 8), ("scope_assignment_current", 2), ("survey_rollup", 1), ("profile", 2),
    ("floc_attributes_dim", 1), ("deliveries_agg", 1),
])
def test_tables_are_read_once(spark, name, most):
    assert scans(catalog.QUERIES[name](spark, SF)) <= most


def test_assignments_are_shuffled_once_by_their_key(spark):
    """W2, J-a and J-c use one exchange of the assignment lines; the joins on floc another."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        tree = catalog.QUERIES["invoice_eligibility_line"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    exchanges = [line for line in tree.split("\n") if "Exchange hashpartitioning" in line]
    by_key = [x for x in exchanges if "hashpartitioning(asset_class" in x and "scope_floc_key" in x]
    # The lines and the latest events; the deliveries stay where their aggregation put them.
    assert len(by_key) == 2, exchanges


def test_invoice_lines_gather_each_sheet_once(spark):
    """Sheets are views of two tables; beside them the line job reads attachments and e-mails."""
    df = catalog.QUERIES["invoice_lines_v1"](spark, SF)
    df.collect()
    executed = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert executed.count("FileScan parquet") <= 6 and "ReusedExchange" in executed


@pytest.mark.parametrize("name", ["profile", "survey_rollup"])
def test_statistics_without_expand(spark, name):
    assert "Expand" not in plan_text(catalog.QUERIES[name](spark, SF))


def test_pricing_deals_a_hot_bucket_over_many_keys(spark):
    """Without a broadcast, a bucket that holds half of the rows is not one task's work."""
    rules = spark.createDataFrame([("V", "HOT", None, None, 1.0, 1), ("V", "B1", None, None, 2.0, 2)], "vendor string, billing_bucket string, object_type string, voltage string, unit_price double, rule_pos long")
    data = spark.range(8000).selectExpr("id", "'V' AS vendor", "if(id % 2 = 0, 'HOT', concat('B', id % 30)) AS billing_bucket", "'ED_POLE' AS object_type", "CAST(NULL AS STRING) AS voltage")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, ("-1", "false", "64")):
            spark.conf.set(k, v)
        priced = P.attach_unit_price(data, rules)
        assert "BroadcastHashJoin" not in plan_text(priced)
        parts = priced.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
        assert sum(r["count"] for r in parts) == 8000 and max(r["count"] for r in parts) < 800
        assert priced.filter("billing_bucket = 'HOT' AND unit_price = 1.0").count() == 4000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    hinted = P.attach_unit_price(data, rules, broadcast_max_bytes=1 << 20)
    assert "BroadcastHashJoin" in plan_text(hinted) and hinted.filter("unit_price = 1.0").count() == 4000


def test_pricing_is_one_join_without_candidates(spark):
    tree = plan_text(catalog.QUERIES["unit_price"](spark, SF)).split("\n\n")[0]
    # The one generator repeats the rule index for the parts of the join; it stands above the scan of the rate card.
    assert "Window" not in tree and tree.count("Generate") == 1
    rows_side, rules_side = tree[: tree.index("Generate")], tree[tree.index("Generate") :]
    assert rows_side.count("Scan parquet") == 1 and rules_side.count("Scan parquet") == 1
