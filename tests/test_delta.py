from lakework.operators import delta as D
from tests.conftest import rows

SCHEMA = "FLOC string, SCOPE_ID string, SCOPE_REMOVAL_DATE string, ATTR string"


def test_delta_decision_table(spark):
    prev = spark.createDataFrame(
        [
            ("R1", "D1", "2026-01-01", "a"),   # inactive -> active: reactivated
            ("S1", "D1", None, "a"),           # active -> inactive: removed_soft
            ("M1", "D1", None, "a"),           # active -> absent: removed_missing
            ("U1", "D1", None, "a"),           # active -> active changed: updated
            ("Q1", "D1", None, "a"),           # active -> active same: none
            ("I1", "D1", "2026-01-01", "a"),   # inactive -> absent: none
            ("J1", "D1", "2026-01-01", "a"),   # inactive -> inactive: none
        ],
        SCHEMA,
    )
    cur = spark.createDataFrame(
        [
            ("N1", "D1", None, "a"),           # absent -> active: added_new
            ("X1", "D1", "2026-01-01", "a"),   # absent -> inactive: none
            ("R1", "D1", None, "a"),
            ("S1", "D1", "2026-01-02", "a"),
            ("U1", "D1", None, "b"),
            ("Q1", "D1", None, "a"),
            ("J1", "D1", "2026-01-03", "a"),
        ],
        SCHEMA,
    )
    out = D.key_delta(D.keyed_distribution(prev), D.keyed_distribution(cur))
    assert rows(out, "_key", "change_set", "_delta_type") == [
        ("D1|M1", "REMOVED", "removed_missing_in_current"),
        ("D1|N1", "ADDED", "added_new"),
        ("D1|R1", "ADDED", "reactivated"),
        ("D1|S1", "REMOVED", "removed_soft"),
        ("D1|U1", "UPDATED", "updated_active"),
    ]


def test_delta_of_same_snapshot_is_empty(spark):
    snap = spark.createDataFrame([("A", "D1", None, "x"), ("B", " ", "2026-01-01", "y")], SCHEMA)
    k = D.keyed_distribution(snap)
    assert D.key_delta(k, k).count() == 0


def test_duplicate_keys_fail(spark):
    import pytest

    snap = spark.createDataFrame([("A", "D1", None, "x"), ("A", "D1", None, "y")], SCHEMA)
    with pytest.raises(ValueError, match="duplicate"):
        D.key_delta(D.keyed_distribution(snap), D.keyed_distribution(snap))


def test_transmission_keying(spark):
    raw = spark.createDataFrame([("T1", None, "T100", "T200"), ("T2", None, " ", None)],
                                "FLOC string, Date_Removed string, `Scope Package #1` string, `Scope Package #2` string")
    assert rows(D.keyed_transmission(raw), "_key", "_visit_no") == [("T100|T1", 1), ("T200|T1", 2)]
