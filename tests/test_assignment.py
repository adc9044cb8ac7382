import datetime as dt

from pyspark.sql import functions as F

from lakework.operators import assignment as A
from tests.conftest import rows

RUN = dict(run_date="2026-01-15", run_id="r1", source_file_saved="f.xlsx")


def test_release_line_distribution_fixture(spark):
    raw = spark.createDataFrame(
        [(" A1 ", "D2603", None), ("A2", "  ", None), ("A3", "D2603", "2026-01-05"), ("A4", "D2604", "not a date")],
        "FLOC string, SCOPE_ID string, SCOPE_REMOVAL_DATE string",
    )
    out = A.release_line_distribution(raw, vendor="VendorA", **RUN)
    assert rows(out, "floc", "scope_id", "is_active", "scope_floc_key") == [
        ("A1", "D2603", True, "D2603|A1"),
        ("A2", "COMP", True, "COMP|A2"),
        ("A3", "D2603", False, "D2603|A3"),
        ("A4", "D2604", True, "D2604|A4"),
    ]


def test_release_line_transmission_unpivot(spark):
    raw = spark.createDataFrame(
        [("T1", None, "T100", None), ("T2", "2026-02-01", "T100", "T200"), ("T3", None, "", " ")],
        "FLOC string, Date_Removed string, `Scope Package #1` string, `scope package  # 2` string",
    )
    out = A.release_line_transmission(raw, vendor="V", **RUN)
    assert rows(out, "floc", "scope_id", "visit_no", "is_active") == [
        ("T1", "T100", 1, True),
        ("T2", "T100", 1, False),
        ("T2", "T200", 2, False),
    ]


def _events(spark, data):
    return spark.createDataFrame(
        data,
        "vendor string, scope_floc_key string, event_type string, event_effective_date timestamp_ntz, run_date string, run_id string",
    )


def test_latest_event_ties(spark):
    d = dt.datetime(2026, 1, 5)
    ev = _events(
        spark,
        [
            # same date, later run date: removal beats the earlier move
            ("V", "K1", "move_to_helo", d, "2026-01-05", "a"),
            ("V", "K1", "removal", d, "2026-01-06", "b"),
            # same date and run date: move beats removal
            ("V", "K2", "removal", d, "2026-01-05", "z"),
            ("V", "K2", "move_to_helo", d, "2026-01-05", "a"),
            # a null date loses to any date
            ("V", "K3", "removal", None, "2026-02-01", "z"),
            ("V", "K3", "move_to_helo", d, "2026-01-01", "a"),
        ],
    )
    got = dict(rows(A.latest_events(ev), "scope_floc_key", "event_type"))
    assert got == {"K1": "removal", "K2": "move_to_helo", "K3": "move_to_helo"}


def test_latest_event_invariant_to_partitions(spark):
    d = dt.datetime(2026, 1, 5)
    data = [("V", f"K{i % 7}", ["removal", "move_to_helo"][i % 2], d + dt.timedelta(days=i % 3), "2026-01-05", f"r{i}") for i in range(200)]
    ev = _events(spark, data)
    a = rows(A.latest_events(ev.repartition(1)))
    b = rows(A.latest_events(ev.repartition(7)))
    assert a == b and len(a) == 7


def _assignments(spark, data):
    df = spark.createDataFrame(
        data, "vendor string, scope_floc_key string, assignment_method string, base_is_active boolean"
    )
    return df


def test_event_override_table(spark):
    a = _assignments(
        spark,
        [
            ("V", "K1", "HELO", True), ("V", "K2", "DRONE", True),     # removal
            ("V", "K3", "HELO", False), ("V", "K4", "DRONE", True),    # move_to_helo
            ("V", "K5", "HELO", True), ("V", "K6", "DRONE", True),     # no event
            ("V", "K7", "DRONE", False), ("V", "K8", "DRONE", None),
            ("V", "K9", "DRONE", True),                                 # other text
        ],
    )
    d = dt.datetime(2026, 1, 1)
    ev = _events(
        spark,
        [("V", "K1", "removal", d, "x", "x"), ("V", "K2", "removal", d, "x", "x"),
         ("V", "K3", "move_to_helo", d, "x", "x"), ("V", "K4", "move_to_helo", d, "x", "x"),
         ("V", "K9", "reassign", d, "x", "x")],
    )
    got = {r[0]: (r[1], r[2]) for r in rows(A.apply_events(a, ev), "scope_floc_key", "is_active_assignment", "assignment_status")}
    assert got == {
        "K1": (False, "REMOVED"), "K2": (False, "REMOVED"),
        "K3": (True, "ACTIVE_HELO"), "K4": (False, "MOVED_TO_HELO"),
        "K5": (True, "ACTIVE_HELO"), "K6": (True, "ACTIVE_DRONE"),
        "K7": (False, "INACTIVE"), "K8": (None, None), "K9": (True, None),
    }


def test_preferred_assignment_helo_wins(spark):
    drone = A.release_line_distribution(
        spark.createDataFrame([("A1", "D1", None), ("A2", "D1", None)], "FLOC string, SCOPE_ID string, SCOPE_REMOVAL_DATE string"),
        vendor="V", **RUN,
    )
    helo = A.helo_line(spark.createDataFrame([("A1", "D1")], "FLOC string, SCOPE_ID string"), vendor="V", run_date="2026-01-16", run_id="h")
    cur = A.current_assignment(drone, helo, None, asset_class="Distribution", drone_dataset="d", helo_dataset="h")
    assert rows(cur, "scope_floc_key", "assignment_method", "assignment_status") == [
        ("D1|A1", "HELO", "ACTIVE_HELO"),
        ("D1|A2", "DRONE", "ACTIVE_DRONE"),
    ]


def test_unknown_event_types_leave_the_status_open(spark):
    """An event that is neither removal nor move overrides an older one, keeps the base flag and gives no status."""
    raw = spark.createDataFrame(
        [("Distribution", "removal", "V", "F1", "D1", "2026-01-02", None, None, "2026-01-02", "r1"),
         ("Distribution", "inspected", "V", "F1", "D1", None, None, None, "2026-01-03", "r2"),
         ("Transmission", "move_to_helo", "V", "F2", None, None, None, "T1", "2026-01-02", "r1"),
         ("Transmission", "removal", "V", "F3", None, None, "nonsense", "T1", "2026-01-02", "r1"),
         ("Distribution", "removal", "V", "F4", " ", "1/2/2026 3:04:05", None, None, "2026-01-02", "r1")],
        "asset_class string, event_type string, vendor string, FLOC string, SCOPE_ID string, SCOPE_REMOVAL_DATE string, Date_Removed string, `Scope Package #1` string, run_date string, run_id string",
    )
    events = A.event_lines(raw, run_date=F.col("run_date"), run_id=F.col("run_id"))
    assert rows(events, "scope_floc_key", "event_type", "visit_no", "source_sheet") == [
        ("COMP|F4", "removal", None, "Distribution"), ("D1|F1", "inspected", None, "Distribution"),
        ("D1|F1", "removal", None, "Distribution"), ("T1|F2", "move_to_helo", 1, "Transmission"),
    ]
    sheets = spark.createDataFrame(
        [("Distribution", "DRONE", "V", "F1", "D1", None, None, None), ("Transmission", "DRONE", "V", "F2", None, None, None, "T1"),
         ("Transmission", "HELO", "V", "F2", "T1", None, None, None), ("Transmission", "HELO", "V", "F9", " ", None, None, None),
         ("Distribution", "DRONE", "V", "F5", "D1", "2026-01-01", None, "T7")],
        "asset_class string, assignment_method string, vendor string, FLOC string, SCOPE_ID string, SCOPE_REMOVAL_DATE string, Date_Removed string, `Scope Package #1` string",
    )
    sources = {(c, m): A.Source("2026-01-01", "r0", "f", f"{c}-{m}") for c in ("Distribution", "Transmission") for m in ("DRONE", "HELO")}
    current = A.current_assignments(A.assignment_lines(sheets, sources), A.latest_events(events), gold_run_date="d", gold_run_id="g")
    assert rows(current, "scope_floc_key", "assignment_method", "latest_event_type", "is_active_assignment", "assignment_status", "source_dataset") == [
        ("D1|F1", "DRONE", "inspected", True, None, "Distribution-DRONE"),
        ("D1|F5", "DRONE", None, False, "INACTIVE", "Distribution-DRONE"),
        ("T1|F2", "HELO", "move_to_helo", True, "ACTIVE_HELO", "Transmission-HELO"),
    ]


def test_sheet_facts_are_not_shuffled(spark):
    """What a line says of its sheet is found again from class and method: the same rows, without those columns in the shuffle."""
    from lakework.plans import catalog
    from tests.test_plans import SF

    lines, latest, sources = catalog.assignment_lines(spark, SF), catalog.latest_event(spark, SF), catalog._sources()
    kw = dict(gold_run_date="2026-01-20", gold_run_id="g1")
    carried, found = A.current_assignments(lines, latest, **kw), A.current_assignments(lines, latest, sources=sources, **kw)
    assert found.columns == carried.columns
    assert found.exceptAll(carried).isEmpty() and carried.exceptAll(found).isEmpty()
    old = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        windows = [[line for line in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [" in line and "scope_removal_date" in line]
                   for df in (carried, found)]
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", old)
    assert "run_id" in windows[0][0] and "run_id" not in windows[1][0] and "source_dataset" not in windows[1][0]
