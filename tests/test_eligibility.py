from lakework.operators import eligibility as E
from tests.conftest import rows

RUN = dict(run_date="2026-02-01", run_id="e1", source_system="T", min_images=8)
SCHEMA = "vendor string, scope_id string, floc string, scope_floc_key string, assignment_method string, assignment_status string, is_active_assignment boolean, object_type string, voltage string"


def _case(spark, cases):
    scope, deliv, survey = [], [], []
    for i, (status, scope_id, active, images, aerial, ground, obj) in enumerate(cases):
        floc = f"F{i}"
        key = f"{scope_id}|{floc}"
        scope.append(("V", scope_id, floc, key, "DRONE", status, active, obj, None))
        deliv.append(("V", key, images, 1, images >= 8, images > 0))
        survey.append((floc, aerial or ground, aerial, ground))
    s = spark.createDataFrame(scope, SCHEMA)
    d = spark.createDataFrame(deliv, "vendor string, scope_floc_key string, image_count_total long, folder_count long, has_min_images boolean, has_gcp_delivery boolean")
    z = spark.createDataFrame(survey, "floc string, has_any_mdoc boolean, has_aerial_mdoc boolean, has_ground_mdoc boolean")
    return s, d, z


CASES = [
    ("ACTIVE_DRONE", "D1", True, 8, True, True, "ED_POLE"),
    ("ACTIVE_DRONE", "D1", True, 7, False, False, "ED_POLE"),
    ("ACTIVE_HELO", "D1", True, 8, False, False, "ED_POLE"),
    ("ACTIVE_DRONE", "COMP", True, 0, False, True, "ED_POLE"),
    ("REMOVED", "D1", False, 9, True, True, "ED_POLE"),
    (None, "D1", True, 0, False, False, None),
    ("ACTIVE_DRONE", "D1", True, 8, True, True, "EZ_POLE"),
]


def test_distribution_v2_table(spark):
    s, d, z = _case(spark, CASES)
    out = E.distribution_eligibility(s, d, z, **RUN)
    got = {r[0]: r[1:] for r in rows(out, "floc", "approved_to_invoice", "block_reasons", "billing_bucket")}
    assert got["F0"] == (True, "", "D360")
    assert got["F1"] == (False, "BLOCK_MISSING_GCP_MIN_IMAGES;BLOCK_MISSING_AERIAL_MDOC;BLOCK_MISSING_GROUND_MDOC", "D360")
    assert got["F2"] == (True, "", "HELO")
    assert got["F3"] == (True, "", "ODI")
    assert got["F4"] == (False, "BLOCK_INACTIVE_ASSIGNMENT", "DIST_OTHER")
    assert got["F5"] == (False, "", "DIST_OTHER")
    assert got["F6"] == (False, "BLOCK_EZ_POLE_DIST_NOT_BILLABLE", "NON_BILLABLE")


def test_distribution_v1_differences(spark):
    s, d, z = _case(spark, CASES)
    out = E.distribution_eligibility(s, d, z, rule_version="v1", **RUN)
    got = {r[0]: r[1:] for r in rows(out, "floc", "approved_to_invoice", "program_bucket")}
    assert got["F3"] == (False, "DIST_DRONE")  # DRONE wins over COMP in v1
    assert got["F5"] == (True, "DIST_OTHER")  # active DIST_OTHER is approved in v1
    assert "billing_bucket" not in out.columns


def test_approved_plus_blocked_is_total(spark):
    s, d, z = _case(spark, CASES)
    line = E.distribution_eligibility(s, d, z, **RUN)
    summ = E.scope_summary(line, run_date="x", run_id="y", source_system="T")
    for r in summ.collect():
        assert r["approved_count"] + r["blocked_count"] == r["floc_count"]


def test_transmission(spark):
    s, d, _ = _case(spark, [("ACTIVE_DRONE", "T1", True, 8, False, False, None), ("REMOVED", "T1", False, 3, False, False, None)])
    out = E.transmission_eligibility(s, d, **RUN)
    assert rows(out, "floc", "approved_to_invoice", "block_reasons", "billing_bucket") == [
        ("F0", True, "", "ATI"),
        ("F1", False, "BLOCK_INACTIVE_ASSIGNMENT;BLOCK_MISSING_GCP_MIN_IMAGES", "ATI"),
    ]


def test_unmatched(spark):
    s, d, z = _case(spark, CASES[:2])
    extra_d = spark.createDataFrame([("V", "D9|X", "X", "D9", 1, 10, True, True)],
                                    "vendor string, scope_floc_key string, floc_any string, scope_id_any string, folder_count long, image_count_total long, has_gcp_delivery boolean, has_min_images boolean")
    um = E.unmatched_deliveries(s, extra_d, asset_class="distribution", run_date="x", run_id="y", source_system="T")
    assert rows(um, "scope_floc_key", "floc", "unmatched_reason") == [("D9|X", "X", "VENDOR_SCOPE_KEY_NOT_IN_ASSIGNMENTS")]
    extra_z = z.unionByName(spark.createDataFrame([("ZZ", True, True, False)], z.schema))
    us = E.unmatched_surveys(s, extra_z, run_date="x", run_id="y", source_system="T")
    assert rows(us, "floc") == [("ZZ",)]


def test_line_flags_win_over_survey_flags(spark):
    s, d, z = _case(spark, [("ACTIVE_DRONE", "D1", True, 8, False, False, "ED_POLE")])
    s = s.withColumns({"has_aerial_mdoc": s.is_active_assignment, "has_ground_mdoc": s.is_active_assignment, "has_any_mdoc": s.is_active_assignment})
    out = E.distribution_eligibility(s, d, z, **RUN)
    assert rows(out, "floc", "approved_to_invoice", "has_aerial_mdoc") == [("F0", True, True)]
