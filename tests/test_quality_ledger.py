import tempfile

import pytest
from pyspark.sql import functions as F

from lakework.operators import ledger as L
from lakework.operators import quality as Q
from lakework.sources import publish as PB
from lakework.sources import readers as RD
from tests.conftest import rows


def test_release_contracts(spark):
    dist = spark.createDataFrame([("A1", None)], "floc string, scope_id string")
    Q.require_contract(dist, Q.RELEASE_CONTRACTS["Distribution"])  # names are case-insensitive; blank scope allowed
    trans = spark.createDataFrame([("T1", "x")], "FLOC string, other string")
    with pytest.raises(ValueError, match="any_of_regex"):
        Q.require_contract(trans, Q.RELEASE_CONTRACTS["Transmission"])
    empty_floc = spark.createDataFrame([(None, "D1")], "FLOC string, SCOPE_ID string")
    with pytest.raises(ValueError, match="not_all_null FLOC"):
        Q.require_contract(empty_floc, Q.contracts_for("move_to_helo")["Distribution"])


def test_domain_check_hints(spark):
    vals = spark.createDataFrame([("VendorA",), ("Vendr B",), ("Other",)], "vendor string")
    out = Q.domain_check(vals, Q.vendor_list(spark, ["VendorA", "VendorB", "Alpha"]))
    assert rows(out) == [("Other", ""), ("Vendr B", "VendorA;VendorB")]


def test_run_ledger_state(spark):
    path = tempfile.mkdtemp(prefix="lw-ledger-", dir="/tmp") + "/ledger"
    L.append_run_record(L.run_record(spark, "r1", L.RUNNING, pipeline="p", run_date="2026-01-01"), path)
    L.append_run_record(L.run_record(spark, "r1", L.SUCCEEDED, pipeline="p", run_date="2026-01-01", metrics={"rows": 3}), path)
    L.append_run_record(L.run_record(spark, "r2", L.RUNNING, pipeline="p", run_date="2026-01-02"), path)
    state = L.run_latest_state(spark.read.parquet(path))
    assert rows(state, "run_id", "status", "event_count") == [("r1", "SUCCEEDED", 2), ("r2", "RUNNING", 1)]


def test_vendor_export_csv(spark):
    root = tempfile.mkdtemp(prefix="lw-export-", dir="/tmp")
    df = spark.createDataFrame([("V0", "k1", True), ("V1", "k2", False)], "vendor string, scope_floc_key string, ready boolean")
    PB.vendor_export(df, root, "approved", run_date="2026-02-01", run_id="r1")
    PB.vendor_export(df.filter("vendor = 'V0'").withColumn("scope_floc_key", F.lit("k9")), root, "approved", run_date="2026-02-02", run_id="r2")
    cur = spark.read.option("header", True).csv(f"{root}/export/approved/CURRENT")
    assert rows(cur, "vendor", "scope_floc_key") == [("V0", "k9"), ("V1", "k2")]
    hist = spark.read.option("header", True).csv(f"{root}/export/approved/HISTORY")
    assert hist.count() == 3
