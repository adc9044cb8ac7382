"""Assignment history and conflicts, published snapshots."""

import pytest
from pyspark.sql import functions as F

from lakework.operators import history as H
from lakework.plans import catalog
from lakework.sources import commits
from lakework.sources import snapshots as SN
from tests.conftest import rows
from tests.test_plans import SF, plan_text

RELEASES = [
    # vendor A: three releases; F1 moves from D1 to D2, F2 leaves and comes back, F3 is in two packages at once.
    ("A", "F1", "D1", 1), ("A", "F1", "D1", 2), ("A", "F1", "D2", 3),
    ("A", "F2", "D1", 1), ("A", "F2", "D1", 3),
    ("A", "F3", "D1", 1), ("A", "F3", "D2", 1), ("A", "F3", "D2", 2), ("A", "F3", "D2", 2),
    # vendor B releases at other times; F1 is with both vendors.
    ("B", "F1", "D9", 2), ("B", "F4", "D9", 4),
]


@pytest.fixture(scope="module")
def history(spark):
    return H.assignment_history(spark.createDataFrame(RELEASES, "vendor string, floc string, scope_id string, effective_ts int"))


def test_intervals(history):
    assert rows(history, "vendor", "floc", "scope_id", "effective_start_ts", "effective_end_ts", "release_count", "is_current") == [
        ("A", "F1", "D1", 1, 3, 2, False),
        ("A", "F1", "D2", 3, None, 1, True),
        ("A", "F2", "D1", 1, 2, 1, False),
        ("A", "F2", "D1", 3, None, 1, True),
        ("A", "F3", "D1", 1, 2, 1, False),
        ("A", "F3", "D2", 1, 3, 2, False),
        ("B", "F1", "D9", 2, 4, 1, False),
        ("B", "F4", "D9", 4, None, 1, True),
    ]


def test_conflicts(history):
    assert rows(H.assignment_conflicts(history), "floc", "conflict_start_ts", "conflict_end_ts", "n_assignments", "assignments") == [
        ("F1", 2, 3, 2, "A/D1;B/D9"),
        ("F1", 3, 4, 2, "A/D2;B/D9"),
        ("F3", 1, 2, 2, "A/D1;A/D2"),
    ]


LINE = "asset_class string, vendor string, scope_id string, scope_floc_key string, approved_to_invoice boolean"


def publish(spark, root, sid, ts, approved):
    line = spark.createDataFrame([("distribution", "A", "D1", "D1|F1", approved), ("distribution", "A", "D1", "D1|F2", None)], LINE)
    SN.publish(line, root, snapshot_id=sid, as_of_ts=ts, rule_version="v2")


def test_snapshots_are_immutable_and_found_by_time(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(LookupError):
        SN.read(spark, root)
    publish(spark, root, "s1", "2026-02-01 06:00:00", True)
    publish(spark, root, "s2", "2026-02-02 06:00:00", False)
    with pytest.raises(ValueError, match="published already"):
        publish(spark, root, "s1", "2026-02-03 06:00:00", False)
    assert rows(SN.read(spark, root), "scope_floc_key", "approved_to_invoice", "snapshot_id") == [("D1|F1", False, "s2"), ("D1|F2", None, "s2")]
    assert rows(SN.read(spark, root, as_of_ts="2026-02-01 23:00:00"), "snapshot_id", "approved_to_invoice") == [("s1", True), ("s1", None)]
    assert rows(SN.read(spark, root, dataset=SN.SUMMARY), "snapshot_id", "floc_count", "approved_count", "blocked_count") == [("s2", 2, 0, 2)]
    assert rows(SN.registry(spark, root), "snapshot_id", "rule_version", "line_rows") == [("s1", "v2", 2), ("s2", "v2", 2)]


def test_a_killed_publication_is_not_a_snapshot(spark, tmp_path, monkeypatch):
    from lakework.sources import commits

    root = str(tmp_path)
    publish(spark, root, "s1", "2026-02-01 06:00:00", True)
    with monkeypatch.context() as m:
        m.setattr(commits, "append", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            publish(spark, root, "s2", "2026-02-02 06:00:00", True)
    assert rows(SN.read(spark, root), "snapshot_id") == [("s1",), ("s1",)]
    publish(spark, root, "s2", "2026-02-02 06:00:00", False)
    assert rows(SN.read(spark, root), "snapshot_id", "approved_to_invoice") == [("s2", False), ("s2", None)]


def test_the_ledger_reads_one_snapshot_and_no_eligibility_work(spark):
    text = plan_text(catalog.ledger_current(spark, SF))
    assert text.count("snapshot_id=snap-2026-02-02") and "snap-2026-02-01" not in text
    # The snapshot and the invoice lines, nothing else.
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == 2 and "Window" not in text


def test_views_split_the_ledger(spark):
    ledger = catalog.ledger_current(spark, SF)
    parts = [H.approved_view(ledger), H.blocked_view(ledger), H.invoiced_paid_view(ledger)]
    assert sum(p.count() for p in parts) == ledger.count()
    assert ledger.filter(F.col("paid_flg") & ~F.col("invoiced_flg")).count() == 0


def test_snapshots_share_one_gathering_of_evidence(spark, monkeypatch):
    """Both rule versions are published from evidence that was gathered once."""
    calls, real = [], catalog.E.eligibility_evidence
    monkeypatch.setattr(catalog.E, "eligibility_evidence", lambda *a, **k: calls.append(1) or real(*a, **k))
    monkeypatch.setattr(catalog, "_PUBLISHED", {})
    first = catalog.snapshot_as_of(spark, SF)
    assert len(calls) == 1
    v1 = catalog.eligibility_v1(spark, SF)
    assert first.drop("snapshot_id", "as_of_ts", "rule_version").exceptAll(v1).isEmpty() and first.count() == v1.count()


def test_evidence_goes_when_its_snapshots_are_published(spark, monkeypatch):
    monkeypatch.setattr(catalog, "_PUBLISHED", {})
    assert not catalog.eligibility_snapshot(spark, SF).isEmpty()
    root = next(iter(catalog._PUBLISHED.values()))
    assert [p.rsplit("/", 1)[-1] for p in commits.matching(spark, f"{root}/*")] == ["gold"]
