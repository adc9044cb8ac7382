"""Versioned publishing: readers see all of a publication or nothing of it."""

import os

import pytest

from lakework.sources import commits, versions
from lakework.sources import publish as PB
from lakework.sources import readers as RD
from tests.conftest import rows
from tests.test_plans import plan_text


class Killed(Exception):
    pass


def kill_before_commit(monkeypatch):
    def killed(*_):
        raise Killed

    monkeypatch.setattr(commits, "append", killed)


def folders(root):
    return sorted(d for d, _, _ in os.walk(root) if "__version=" in d)


def test_a_run_killed_between_the_writes_leaves_the_old_table(spark, tmp_path, monkeypatch):
    root, schema = str(tmp_path), "vendor string, v int"
    old = spark.createDataFrame([("A", 1), ("B", 2)], schema)
    PB.publish_whole_table(old, root, "gold", "whole", run_date="d", run_id="r1")
    PB.publish_vendor_partitioned(old, root, "gold", "parts", run_date="d", run_id="r1")
    PB.publish_accumulating(spark, old, root, "gold", "acc", ["vendor"], run_id="r1")
    new = spark.createDataFrame([("A", 9), ("C", 9)], schema)
    with monkeypatch.context() as m:
        kill_before_commit(m)
        for publish in (
            lambda: PB.publish_whole_table(new, root, "gold", "whole", run_date="d", run_id="r2"),
            lambda: PB.publish_vendor_partitioned(new, root, "gold", "parts", run_date="d", run_id="r2"),
            lambda: PB.publish_accumulating(spark, new, root, "gold", "acc", ["vendor"], run_id="r2"),
        ):
            with pytest.raises(Killed):
                publish()
    for dataset in ("whole", "parts", "acc"):
        assert rows(RD.read_current(spark, root, "gold", dataset), "vendor", "v") == [("A", 1), ("B", 2)]
    # The next run takes effect as a whole and removes what the killed one left.
    PB.publish_whole_table(new, root, "gold", "whole", run_date="d", run_id="r3")
    PB.publish_vendor_partitioned(new, root, "gold", "parts", run_date="d", run_id="r3")
    PB.publish_accumulating(spark, new, root, "gold", "acc", ["vendor"], run_id="r3")
    assert rows(RD.read_current(spark, root, "gold", "whole"), "vendor", "v") == [("A", 9), ("C", 9)]
    assert rows(RD.read_current(spark, root, "gold", "parts"), "vendor", "v") == [("A", 9), ("B", 2), ("C", 9)]
    assert rows(RD.read_current(spark, root, "gold", "acc"), "vendor", "v") == [("A", 9), ("B", 2), ("C", 9)]
    assert len(folders(f"{root}/gold/whole")) == 2
    assert not [d for d, _, _ in os.walk(root) if "staging" in d]


def test_an_unfinished_entry_does_not_count(spark, tmp_path):
    root = str(tmp_path)
    PB.publish_current(spark.createDataFrame([(1,)], "v int"), root, "gold", "t")
    with open(f"{root}/gold/t/CURRENT/_pointer/000000002.json", "w") as f:
        f.write('{"parts": {"": {"vers')
    assert rows(RD.read_current(spark, root, "gold", "t")) == [(1,)]
    PB.publish_current(spark.createDataFrame([(2,)], "v int"), root, "gold", "t")
    assert rows(RD.read_current(spark, root, "gold", "t")) == [(2,)]


def test_of_two_writers_one_fails(spark, tmp_path):
    log = f"{tmp_path}/log"
    commits.append(spark, log, 1, {"a": 1})
    with pytest.raises(Exception, match="exist"):
        commits.append(spark, log, 1, {"a": 2})
    assert commits.entries(spark, log) == [{"a": 1, "number": 1}]


def test_a_rerun_with_fewer_vendors_leaves_no_rows_of_the_others(spark, tmp_path):
    root, schema = str(tmp_path), "vendor string, v int"
    run = lambda data, run_id: PB.publish_vendor_partitioned(
        spark.createDataFrame(data, schema), root, "gold", "t", run_date="2026-01-01", run_id=run_id
    )
    run([("A", 1), ("B", 1)], "r1")
    run([("B", 2), ("C", 2)], "r2")
    run([("C", 3)], "r2")
    # r2 never published B: what r1 published is B again.
    assert rows(RD.read_current(spark, root, "gold", "t"), "vendor", "v", "run_id") == [("A", 1, "r1"), ("B", 1, "r1"), ("C", 3, "r2")]
    assert rows(RD.read_history(spark, root, "gold", "t"), "vendor", "v", "run_id") == [("A", 1, "r1"), ("B", 1, "r1"), ("C", 3, "r2")]


def test_extra_keys_vanish_with_a_rerun(spark, tmp_path):
    schema = "vendor string, kind string, v int"
    for data in ([("A", "x", 1), ("A", "y", 1)], [("A", "y", 2)]):
        PB.publish_vendor_partitioned(spark.createDataFrame(data, schema), str(tmp_path), "gold", "t", run_date="d:1", run_id="r/1", extra=["kind"])
    assert rows(RD.read_current(spark, str(tmp_path), "gold", "t"), "vendor", "kind", "v") == [("A", "y", 2)]
    assert rows(RD.read_history(spark, str(tmp_path), "gold", "t"), "kind", "v", "run_id") == [("y", 2, "r/1")]


def test_empty_tables_and_new_columns(spark, tmp_path):
    root = str(tmp_path)
    PB.publish_whole_table(spark.createDataFrame([], "v int"), root, "gold", "t", run_date="d", run_id="r1")
    assert RD.read_current(spark, root, "gold", "t").collect() == []
    PB.publish_vendor_partitioned(spark.createDataFrame([("A", 1)], "vendor string, v int"), root, "gold", "p", run_date="d", run_id="r1")
    PB.publish_vendor_partitioned(spark.createDataFrame([("B", "x")], "vendor string, w string"), root, "gold", "p", run_date="d", run_id="r2")
    assert rows(RD.read_current(spark, root, "gold", "p"), "vendor", "v", "w") == [("A", 1, None), ("B", None, "x")]


def test_only_the_newest_publications_are_kept(spark, tmp_path):
    root = str(tmp_path)
    for k in range(5):
        PB.publish_current(spark.createDataFrame([("A", k)], "vendor string, v int"), root, "gold", "t", partitions=["vendor"], run_id=f"r{k}")
    assert len(folders(f"{root}/gold/t/CURRENT")) == versions.RETAIN == len(os.listdir(f"{root}/gold/t/CURRENT/_pointer")) // 2
    assert rows(RD.read_current(spark, root, "gold", "t"), "v") == [(4,)]


def test_the_plan_runs_once(spark, tmp_path):
    """HISTORY and CURRENT of one publication: the rows are computed one time."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(100).repartition(4).mapInArrow(count, "id long")
    PB.publish_whole_table(df, str(tmp_path), "gold", "t", run_date="d", run_id="r")
    assert seen.value == 100 and RD.read_current(spark, str(tmp_path), "gold", "t").count() == 100


def test_previous_run_reads_its_own_folders(spark, tmp_path):
    root, schema = str(tmp_path), "vendor string, v int"
    for k in (1, 2, 3):
        df = spark.createDataFrame([("A", k), *([("B", k)] if k == 1 else [])], schema)
        PB.publish_history(df, root, "silver", "t", run_date=f"2026-01-0{k}", run_id=f"r{k}", partitions=["vendor"])
    path, own = RD.dataset_path(root, "silver", "t", "HISTORY"), df.schema
    previous = RD.read_previous_run(spark, path, own, "r3", by_vendor=True)
    assert rows(previous, "vendor", "v", "run_id") == [("A", 2, "r2")]
    text = plan_text(previous)
    assert "run_id=r2" in text and "r1" not in text and "Join" not in text
    assert rows(RD.read_previous_run(spark, path, own, "r3", by_vendor=True, vendor="B"), "v") == [(1,)]
    assert rows(RD.read_previous_run(spark, path, own, "new", by_vendor=True), "v") == [(3,)]
    assert rows(RD.read_previous_run(spark, path, own, "r1", by_vendor=True), "v") == []
    started = spark.createDataFrame([("r1", "2026-01-09"), ("r2", "2026-01-01")], "run_id string, started_at string").selectExpr("run_id", "timestamp(started_at) started_at")
    assert rows(RD.runs(spark, path, by_vendor=True).join(started, "run_id", "left"), "run_id") == [("r1",), ("r2",), ("r3",)]


def test_a_load_reads_only_the_buckets_it_touches(spark, tmp_path):
    root = str(tmp_path)
    first = spark.range(200).selectExpr("cast(id AS string) AS k", "1L AS __load_seq", "'a' AS v")
    PB.publish_accumulating(spark, first, root, "silver", "acc", ["k"], run_id="1", buckets=16)
    before = {d.rsplit("/", 1)[0]: d for d in folders(root)}
    out = PB.publish_accumulating(spark, spark.createDataFrame([("5", 2, "b")], "k string, __load_seq long, v string"), root, "silver", "acc", ["k"], run_id="2", buckets=99)
    entry = versions.newest(spark, RD.dataset_path(root, "silver", "acc", "CURRENT"))
    moved = [n for n, p in entry["parts"].items() if not before[f"{root}/silver/acc/CURRENT/{n}"].endswith(p["version"])]
    assert entry["buckets"] == 16 and len(moved) == 1 and out.count() == 200


def test_vendor_export_twice(spark, tmp_path):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "vendor string, v int")
    for data in (df, df, df.filter("vendor = 'A'")):
        history, current = PB.vendor_export(data, str(tmp_path), "approved", run_date="2026-01-01", run_id="r1")
    csv = lambda p: spark.read.option("header", True).csv(p)
    assert rows(csv(history), "vendor", "v", "run_id") == [("A", "1", "r1"), ("A", "2", "r1")]
    assert rows(csv(current), "vendor", "v") == [("A", "1"), ("A", "2"), ("B", "3")]


def test_paths_in_other_spellings(spark, tmp_path):
    """A root given as a URI, with values in partition names that a path must escape."""
    for root in (f"file://{tmp_path}/a", f"file:{tmp_path}/b/", f"{tmp_path}/c"):
        for k in (1, 2):
            df = spark.createDataFrame([("A b/c:1%", k), ("D", k), *([("E*", k)] if k == 1 else [])], "vendor string, v int")
            PB.publish_vendor_partitioned(df, root, "gold", "t", run_date="2026-01-01", run_id="r:1")
        assert rows(RD.read_current(spark, root, "gold", "t"), "vendor", "v", "run_id") == [("A b/c:1%", 2, "r:1"), ("D", 2, "r:1")]
        assert rows(RD.read_history(spark, root, "gold", "t"), "vendor", "v", "run_id") == [("A b/c:1%", 2, "r:1"), ("D", 2, "r:1")]
        path, schema = RD.dataset_path(root, "gold", "t", "HISTORY"), df.schema
        assert rows(RD.read_previous_run(spark, path, schema, "r9", by_vendor=True, vendor="A b/c:1%"), "vendor", "v") == [("A b/c:1%", 2)]
