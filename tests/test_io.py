import hashlib
import os
import tempfile

from pyspark.sql import functions as F

from lakework.operators import ledger as L
from lakework.sources import publish as PB
from lakework.sources import readers as RD
from lakework.streaming.drops import upsert_stream
from tests.conftest import rows


def _tmp():
    return tempfile.mkdtemp(prefix="lw-test-", dir="/tmp")


def test_read_optional_missing_gives_empty(spark):
    df = RD.read_optional(spark, _tmp() + "/nope", spark.createDataFrame([], "a string, b long").schema)
    assert df.count() == 0 and df.columns == ["a", "b"]


def test_archive_manifest_and_newest_drop(spark):
    d = _tmp()
    for name, body in [("inspections_20260101_101500Z.csv", b"a,b\n1,2\n"), ("inspections_20260105_090000Z.csv", b"x"), ("manual.csv", b"zz")]:
        with open(os.path.join(d, name), "wb") as f:
            f.write(body)
    man = PB.archive_manifest(spark, d, run_date="2026-01-06", run_id="r")
    got = {r["file_name"]: (r["length"], r["file_hash"]) for r in man.collect()}
    assert got["manual.csv"] == (2, hashlib.sha256(b"zz").hexdigest())
    newest = RD.newest_drop_file(RD.list_files(spark, d)).collect()
    assert [r["file_name"] for r in newest] == ["inspections_20260105_090000Z.csv"]


def test_read_documents_whole_text(spark):
    d = _tmp()
    with open(os.path.join(d, "email__M1_.html"), "w") as f:
        f.write("<p>a</p>\n<p>b</p>")
    docs = RD.read_documents(spark, d).collect()
    assert docs[0]["file_name"] == "email__M1_.html" and docs[0]["text"] == "<p>a</p>\n<p>b</p>"


def test_load_header(spark):
    raw = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "x int, y string")
    line = raw.filter("x > 1")
    h = PB.load_header(raw, line, dataset="d", run_date="2026-01-01", run_id="r").first()
    assert (h["raw_rows"], h["raw_cols"], h["silver_rows"]) == (3, 2, 2)


def test_accumulating_publish_is_idempotent_and_keeps_last(spark):
    root = _tmp()
    a = spark.createDataFrame([("m1", 1, 10.0), ("m2", 1, 20.0)], "message_id string, __load_seq long, total double")
    b = spark.createDataFrame([("m2", 2, 21.0), ("m3", 2, 30.0)], "message_id string, __load_seq long, total double")
    PB.publish_accumulating(spark, a, root, "silver", "inv", ["message_id"], run_id="1")
    PB.publish_accumulating(spark, b, root, "silver", "inv", ["message_id"], run_id="2")
    out = PB.publish_accumulating(spark, b, root, "silver", "inv", ["message_id"], run_id="3")
    assert rows(out, "message_id", "total") == [("m1", 10.0), ("m2", 21.0), ("m3", 30.0)]


def test_dynamic_overwrite_keeps_other_vendors(spark):
    root = _tmp()
    df = spark.createDataFrame([("V0", 1), ("V1", 2)], "vendor string, x int")
    PB.publish_current(df, root, "silver", "t", partitions=["vendor"])
    PB.publish_current(spark.createDataFrame([("V0", 9)], "vendor string, x int"), root, "silver", "t", partitions=["vendor"])
    got = RD.read_current(spark, root, "silver", "t", schema=df.schema)
    assert rows(got, "vendor", "x") == [("V0", 9), ("V1", 2)]


def test_upsert_keep_last_and_upsert(spark):
    base = spark.createDataFrame([("h1", "LOADED", "p1"), ("h2", "FAILED", "p2")], "file_hash string, status string, path string")
    upd = spark.createDataFrame([("h2", "LOADED", 5), ("h3", "LOADED", 1)], "file_hash string, status string, n int")
    out = L.upsert(base, upd, ["file_hash"])
    assert rows(out, "file_hash", "status", "path", "n") == [("h1", "LOADED", "p1", None), ("h2", "LOADED", "p2", 5), ("h3", "LOADED", None, 1)]
    todo = L.not_yet_loaded(spark.createDataFrame([("h1",), ("h2",), ("h9",)], "file_hash string"), base)
    assert rows(todo) == [("h2",), ("h9",)]


def test_drop_stream_upserts_each_file_once(spark):
    root, src = _tmp(), _tmp()
    schema = "message_id string, ts timestamp_ntz, total double"
    spark.createDataFrame([("m1", None, 1.0)], schema).withColumn("ts", F.to_timestamp_ntz(F.lit("2026-01-01 00:00:00"))) \
        .write.mode("append").parquet(src)
    s = spark.createDataFrame([], schema).schema
    q = upsert_stream(spark, src, s, root=root, layer="silver", dataset="d", keys=["message_id"], checkpoint=root + "/ck", order_col="ts", buckets=8)
    q.awaitTermination()
    spark.createDataFrame([("m1", None, 2.0), ("m2", None, 3.0)], schema).withColumn("ts", F.to_timestamp_ntz(F.lit("2026-01-02 00:00:00"))) \
        .write.mode("append").parquet(src)
    q = upsert_stream(spark, src, s, root=root, layer="silver", dataset="d", keys=["message_id"], checkpoint=root + "/ck", order_col="ts", buckets=8)
    q.awaitTermination()
    cur = RD.read_current(spark, root, "silver", "d")
    assert rows(cur, "message_id", "total") == [("m1", 2.0), ("m2", 3.0)]


def test_bucketed_accumulating_publish_rewrites_only_touched_buckets(spark):
    root = _tmp()
    first = spark.range(0, 200).select(F.col("id").cast("string").alias("k"), F.lit(1).cast("bigint").alias("__load_seq"), F.lit("a").alias("v"))
    PB.publish_accumulating(spark, first, root, "silver", "acc", ["k"], run_id="1", buckets=16)
    second = spark.createDataFrame([("5", 2, "b"), ("500", 2, "c")], "k string, __load_seq long, v string")
    out = PB.publish_accumulating(spark, second, root, "silver", "acc", ["k"], run_id="2", buckets=16)
    assert out.count() == 201
    got = {r["k"]: r["v"] for r in out.filter(F.col("k").isin("5", "6", "500")).collect()}
    assert got == {"5": "b", "6": "a", "500": "c"}
