import datetime as dt

from pyspark.sql import functions as F

from lakework.operators import evidence as V
from tests.conftest import rows

DELIV = "DateUploaded string, flight_date string, vendor string, structureId string, folder string, imageCount string"


def test_deliveries_latest_upload_and_agg(spark):
    raw = spark.createDataFrame(
        [
            ("01-02-2026", "1-1-2026", "VendorA", "A1", "D2603-0001_Assets_20260101", "8"),
            ("01-05-2026", "1-1-2026", "VendorA", "A1", "D2603-0001_Assets_20260101", "5"),   # later upload wins
            ("01-02-2026", "1-1-2026", "VendorA", "A1", "D2603-0002_Assets_20260102", "8.9"),
            ("01-02-2026", "1-1-2026", "VendorA", "A2", "nodash_Assets_20260101", "x"),
        ],
        DELIV,
    )
    line = V.deliveries_line(raw, asset_class="Distribution", run_date="d", run_id="r", source_system="GCP")
    assert rows(line, "floc", "folder", "image_count", "date_uploaded") == [
        ("A1", "D2603-0001_Assets_20260101", 5, dt.date(2026, 1, 5)),
        ("A1", "D2603-0002_Assets_20260102", 8, dt.date(2026, 1, 2)),
        ("A2", "nodash_Assets_20260101", 0, dt.date(2026, 1, 2)),
    ]
    agg = V.deliveries_agg(line, min_images=8)
    assert rows(agg, "scope_floc_key", "folder_count", "image_count_total", "has_gcp_delivery", "has_min_images") == [
        ("D2603|A1", 2, 13, True, True),
        ("nodash|A2", 1, 0, False, False),
    ]


SURVEY_COLS = ["flocNumber", "createdAt", "aerialInspectionKind", "aerialMeasurementDocument", "inspectionKind",
               "measurementDocument", "inspectionStatus", "objectType", "workOrderNumber"]


def test_survey_rollup_first_appearance(spark):
    prefix = "stg_azure_inspectapp_inspections_all_"
    data = [
        ("F1", "1/13/2026 3:24:51PM", "b", "M1", "g", "N/A", "OK", "ED_POLE", "W1", 1),
        ("F1", "1/14/2026 3:24:51PM", "a", "n/a", "g", "G2", "OK", "ED_POLE", "W2", 2),
        ("F1", "1/15/2026 3:24:51PM", "b", None, "g", None, "DONE", "ET_POLE", "W1", 3),
        ("null", "1/15/2026 3:24:51PM", "b", None, "g", None, "DONE", "ET_POLE", "W1", 4),
    ]
    cols = [prefix + c + (";" if i == 0 else "") for i, c in enumerate(SURVEY_COLS)] + ["pos"]
    raw = spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols[:-1]) + ", pos int")
    line = V.survey_line(raw, run_date="d", run_id="r", source_system="AZ", position=F.col("pos"))
    assert line.count() == 3
    roll = V.survey_rollup(line, run_date="d", run_id="r").first()
    assert roll["aerial_inspection_kinds"] == "b;a"
    assert roll["aerial_measurement_documents"] == "M1"
    assert roll["ground_measurement_documents"] == "G2"
    assert roll["inspection_statuses"] == "OK;DONE"
    assert roll["object_type_count"] == 2 and roll["row_count"] == 3
    assert roll["has_aerial_mdoc"] and roll["has_ground_mdoc"] and roll["has_any_mdoc"]
    assert roll["created_at_min"] == dt.datetime(2026, 1, 13, 15, 24, 51)
