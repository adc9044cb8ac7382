"""The lake jobs end to end on small fixtures, in a fresh lake root."""

import tempfile

import pytest
from pyspark.sql import functions as F

from lakework.plans import jobs as J
from lakework.sources import readers as RD
from tests.conftest import rows

REL = "FLOC string, SCOPE_ID string, SCOPE_REMOVAL_DATE string, NOTE string"
SURVEY_COLS = ["flocNumber", "createdAt", "aerialInspectionKind", "aerialMeasurementDocument", "inspectionKind",
               "measurementDocument", "inspectionStatus", "objectType", "workOrderNumber"]


def test_lake_jobs_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="lw-lake-", dir="/tmp")
    r1, r2, r3 = J.Run("2026-01-10", "r1"), J.Run("2026-01-12", "r2"), J.Run("2026-01-15", "r3")

    snap1 = spark.createDataFrame([("A1", "D1", None, "x"), ("A2", "D1", None, "x"), ("A3", "", None, "x")], REL)
    snap2 = spark.createDataFrame([("A1", "D1", None, "y"), ("A3", "", "2026-01-11", "x"), ("A4", "D2", None, "x")], REL)
    assert J.release_intake(spark, snap1, root=root, vendor="V", asset_class="Distribution", run=r1).count() == 0
    m = {}
    delta = J.release_intake(spark, snap2, root=root, vendor="V", asset_class="Distribution", run=r2, metrics=m)
    assert m == {"line_rows": 3, "inactive_rows": 1, "comp_rows": 1}
    assert rows(delta, "_key", "_delta_type") == [
        ("COMP|A3", "removed_soft"), ("D1|A1", "updated_active"), ("D1|A2", "removed_missing_in_current"), ("D2|A4", "added_new"),
    ]
    deltas = RD.read_history(spark, root, "silver", "scope_release_distribution_delta")
    assert deltas.select("change_set").distinct().count() == 3

    J.helo_intake(spark.createDataFrame([("A4", "D2")], "FLOC string, SCOPE_ID string"), root=root, vendor="V", asset_class="Distribution", run=r2)
    J.events_intake(spark.createDataFrame([("A1", "D1", "2026-01-13")], "FLOC string, SCOPE_ID string, SCOPE_REMOVAL_DATE string"),
                    root=root, vendor="V", event_type="removal", asset_class="Distribution", run=r2)
    cur = J.current_assignment_job(spark, root=root, run=r3)
    assert rows(cur["Distribution"], "scope_floc_key", "assignment_method", "assignment_status") == [
        ("COMP|A3", "DRONE", "INACTIVE"), ("D1|A1", "DRONE", "REMOVED"), ("D2|A4", "HELO", "ACTIVE_HELO"),
    ]

    deliv = spark.createDataFrame(
        [("01-02-2026", "1-1-2026", "V", "A4", "D2-0001_Assets_20260101", "9"), ("01-02-2026", "1-1-2026", "V", "ZZ", "D9-1_Assets_20260101", "3")],
        "DateUploaded string, flight_date string, vendor string, structureId string, folder string, imageCount string",
    )
    J.deliveries_intake(deliv, root=root, asset_class="distribution", run=r3)
    J.deliveries_intake(deliv.limit(0), root=root, asset_class="transmission", run=r3)
    survey = spark.createDataFrame([("A4", "1/13/2026 3:24:51PM", "k", None, "g", "GM1", "OK", "ED_POLE", "W1")],
                                   ", ".join(f"{c} string" for c in SURVEY_COLS))
    J.survey_intake(survey, root=root, run=r3)
    lst = spark.createDataFrame([("A4", "EZ_POLE", None), ("A1", "ED_POLE", "12kV")], "FLOC string, Eq_OjType string, Voltage string")
    J.scope_master_job([(lst, "distribution", "DIST_LIST")], root=root, run=r3)
    for ac in ("Transmission",):
        pass
    em = {}
    out = J.eligibility_job(spark, root=root, run=r3, metrics=em)
    assert em["line_rows"] == 3 and em["object_type_nulls"] == 1
    line = out["invoice_eligibility_line"]
    got = {r[0]: r[1:] for r in rows(line, "scope_floc_key", "approved_to_invoice", "billing_bucket", "block_reasons")}
    assert got["D2|A4"] == (False, "NON_BILLABLE", "BLOCK_EZ_POLE_DIST_NOT_BILLABLE")
    assert got["D1|A1"][0] is False and "BLOCK_INACTIVE_ASSIGNMENT" in got["D1|A1"][2]
    assert rows(out["unmatched_gcp_distribution"], "scope_floc_key") == [("D9|ZZ",)]
    summ = out["eligibility_scope_summary"].agg(F.sum("floc_count")).first()[0]
    assert summ == line.count()

    rc = spark.createDataFrame([("V", "HELO", None, None, "10")], "vendor string, billing_bucket string, object_type string, voltage string, unit_price string")
    J.rate_card_job(rc, root=root, run=r3, position=F.lit(1))
    priced = J.pricing_job(spark, spark.createDataFrame([("V", "HELO", "ED_POLE", None)], "vendor string, billing_bucket string, object_type string, voltage string"), root=root)
    assert rows(priced, "pricing_match_status", "unit_price") == [("MATCHED", 10.0)]


def test_invoice_intake_v1_accumulates(spark):
    root = tempfile.mkdtemp(prefix="lw-inv-", dir="/tmp")
    cells = spark.createDataFrame(
        [("M1", 0, 0, "INVOICE NUMBER"), ("M1", 0, 1, "INV-1"), ("M1", 2, 0, "FLOC_ID"), ("M1", 2, 1, "SCE_STRUCT"), ("M1", 2, 2, "PHOTO_LOC"),
         ("M1", 2, 3, "FLIGHT_DATE"), ("M1", 2, 4, "UPLOAD_DATE"), ("M1", 2, 5, "VENDOR_STATUS"), ("M1", 2, 6, "BLOCK_ID"), ("M1", 2, 7, "UNIT_RATE"),
         ("M1", 3, 0, "OH-1"), ("M1", 3, 7, "$1,000.50"), ("M1", 4, 1, "S2"), ("M1", 5, 0, "OH-3"),
         ("M2", 0, 0, "nothing here")],
        "message_id string, row_idx int, col_idx int, value string",
    )
    att = spark.createDataFrame([("att__M1__INV-1.xlsx",), ("att__M2__X.xlsx",), ("att__M3__Y.xlsx",)], "file_name string")
    em = spark.createDataFrame([("email__M1_.html", "<span>Supplier</span><span>ACME</span>"), ("email__M2_.html", "")], "file_name string, html string")
    out = J.invoice_intake_v1(spark, cells, att, em, root=root, run=J.Run("2026-02-01", "i1"), load_seq=1)
    assert rows(out["vendor_invoice_file_status"], "message_id", "status", "lines") == [
        ("M1", "OK", 2), ("M2", "SKIPPED_BAD_FORMAT", None), ("M3", "SKIPPED_NO_HTML", None),
    ]
    assert rows(out["vendor_invoice_line_v1"], "floc_id", "line_number", "unit_rate") == [("OH-1", 1, 1000.5), ("OH-3", 3, None)]
    out2 = J.invoice_intake_v1(spark, cells, att, em, root=root, run=J.Run("2026-02-02", "i2"), load_seq=2)
    assert out2["vendor_invoice_header_v1"].count() == 1
    assert rows(out2["vendor_invoice_header_v1"], "invoice_number", "supplier") == [("INV-1", "ACME")]


def test_invoice_intake_v2_twice(spark):
    """A rerun leaves one copy of everything; a sheet without a line table fails."""
    root = tempfile.mkdtemp(prefix="lw-inv2-", dir="/tmp")
    cells = spark.createDataFrame(
        [("M1", 0, 0, "Invoice Number"), ("M1", 0, 1, "INV-1"), ("M1", 90, 0, "Floc ID"), ("M1", 90, 1, "SCE_STRUCT__"), ("M1", 90, 3, "BlockID"),
         ("M1", 91, 0, "OH-1"), ("M1", 91, 1, "S1"), ("M1", 91, 3, "D2603-0001"), ("M1", 92, 2, "junk"), ("M1", 93, 0, "OH-3"),
         ("M2", 0, 0, "nothing here"), ("M3", 0, 0, "FLOCID"), ("M3", 1, 0, "XX-1")],
        "message_id string, row_idx int, col_idx int, value string",
    )
    att = spark.createDataFrame([(f"att__M{k}__INV.xlsx",) for k in (1, 2, 3)], "file_name string")
    em = spark.createDataFrame([(f"email__M{k}_.html", "<span>Supplier</span><span>ACME</span>") for k in (1, 2, 3)], "file_name string, html string")
    for _ in range(2):
        out = J.invoice_intake_v2(cells, att, em, root=root, run=J.Run("2026-02-01", "i1"))
    assert rows(out["vendor_invoices_file_manifest"], "message_id", "status", "bad_floc_sample") == [
        ("M1", "PARSED_OK", None), ("M2", "FAILED_VALIDATION_NO_LINES", None), ("M3", "FAILED_VALIDATION_BAD_FLOC", "XX-1"),
    ]
    assert rows(out["vendor_invoice_line"], "floc_id", "sce_struct", "scope_id", "line_number", "supplier") == [
        ("OH-1", "S1", "D2603", 1, "ACME"), ("OH-3", None, None, 2, "ACME"),
    ]
    assert rows(out["vendor_invoice_header"], "message_id", "invoice_number_xlsx") == [("M1", "INV-1")]
    history = RD.read_history(spark, root, "silver", "vendor_invoice_line")
    assert history.count() == 2


def test_a_missing_sheet_is_skipped(spark):
    root = tempfile.mkdtemp(prefix="lw-wb-", dir="/tmp")
    sheet = spark.createDataFrame([("A1", "D1", "2026-01-13")], "FLOC string, SCOPE_ID string, SCOPE_REMOVAL_DATE string")
    metrics = {}
    run = J.Run("2026-01-15", "w1")
    out = J.events_workbook_intake({"Distribution": sheet, "Notes": sheet}, root=root, vendor="V", event_type="removal", run=run, metrics=metrics)
    assert rows(out, "scope_floc_key", "source_sheet") == [("D1|A1", "Distribution")] and metrics == {"Transmission__skipped": "missing sheet"}
    for book, what in (({}, "none of the sheets"), ({"Distribution": sheet.drop("FLOC")}, "required FLOC")):
        with pytest.raises(ValueError, match=what):
            J.events_workbook_intake(book, root=root, vendor="V", event_type="removal", run=run)


def test_the_eligibility_job_aggregates_deliveries_once(spark, monkeypatch):
    real, seen = J.V.deliveries_agg, spark.sparkContext.accumulator(0)

    def counted(line, **kw):
        def count(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        return real(line.mapInArrow(count, line.schema), **kw)

    monkeypatch.setattr(J.V, "deliveries_agg", counted)
    root, run = tempfile.mkdtemp(prefix="lw-once-", dir="/tmp"), J.Run("2026-02-01", "e1")
    raw = spark.createDataFrame(
        [("V", f"A{k}", f"D{k}-B_Assets_20260113", "9", "01-13-2026", "01-13-2026") for k in range(4)],
        "vendor string, structureId string, folder string, imageCount string, DateUploaded string, flight_date string",
    )
    for asset_class in ("distribution", "transmission"):
        J.deliveries_intake(raw, root=root, asset_class=asset_class, run=run)
    J.current_assignment_job(spark, root=root, run=run)
    empty = spark.createDataFrame([], "floc string, object_type string, voltage string")
    J.PB.publish_whole_table(empty, root, "silver", J.FLOC_DIM, run_date=run.run_date, run_id=run.run_id)
    flags = "floc string, has_any_mdoc boolean, has_aerial_mdoc boolean, has_ground_mdoc boolean"
    J.PB.publish_whole_table(spark.createDataFrame([], flags), root, "silver", J.SURVEY_FLOC, run_date=run.run_date, run_id=run.run_id)
    out = J.eligibility_job(spark, root=root, run=run)
    assert out["unmatched_gcp_distribution"].count() == out["unmatched_gcp_transmission"].count() == 4
    assert seen.value == 8
