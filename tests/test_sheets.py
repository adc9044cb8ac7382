"""Sheets meet in one shuffle by message; loads, exports and page files at scale."""

import glob

from pyspark.sql import functions as F

from lakework.operators import invoices as I
from lakework.plans import catalog
from lakework.plans import jobs as J
from lakework.sources import publish as PB
from tests.conftest import rows

CELLS = "message_id string, row_idx int, col_idx int, value string"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def sheet(spark):
    head = [("A", 3, c, n) for c, n in enumerate(I.LINE_COLS_V1)]
    body = [("A", r, c, f"{n}{r}") for r in (4, 6) for c, n in enumerate(("OH-", "S", "D1_", "f", "u", "st", "b", "$"))]
    top = [("A", 0, 0, "PO"), ("A", 0, 2, "old"), ("A", 1, 0, "Po Number"), ("A", 1, 1, "  "), ("A", 1, 4, "far"), ("A", 1, 3, "near"), ("A", 2, 0, "CWA")]
    blank = [("A", 5, c, " ") for c in range(8)] + [("A", 6, 0, "zz"), ("B", 0, 0, None), (None, 0, 0, "PO")]
    return spark.createDataFrame([*head, *body, *top, *blank], CELLS).repartition(5)


def test_cells_are_not_gathered_before_they_meet(spark):
    cells = sheet(spark)
    for df in (I.header_row_v1(cells), I.header_row_v2(cells), I.header_kv_v2(cells), I.line_table_v1(cells), I.line_table_v2(cells)):
        assert "collect_list" not in plan(df)


def test_last_label_and_first_value_to_its_right(spark):
    kv = I.header_kv_v1(sheet(spark))
    assert rows(kv, "message_id", "purchase_order_number", "cwa_number") == [("A", "near", None), ("B", None, None)]
    kept = I.header_kv_v1(sheet(spark), max_rows=1)
    assert rows(kept, "message_id", "purchase_order_number") == [("A", "old"), ("B", None)]


def test_lines_and_headers(spark):
    cells = sheet(spark)
    assert rows(I.header_row_v1(cells)) == [("A", 3)]
    assert rows(I.header_row_v2(cells)) == [("A", 3), ("B", None)]
    lines = I.number_lines(I.line_table_v1(cells))
    assert rows(lines, "row_idx", "FLOC_ID", "UNIT_RATE", "line_number") == [(4, "OH-4", "$4", 1), (6, "OH-6", "$6", 2)]


def test_a_load_writes_one_file_for_each_bucket(spark, tmp_path):
    new = spark.range(4000).select(F.col("id").cast("string").alias("k"), F.lit(1).cast("long").alias("__load_seq")).repartition(6)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = PB.publish_accumulating(spark, new, str(tmp_path), "silver", "t", ["k"], run_id="1", buckets=4)
        assert out.count() == 4000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert len(glob.glob(f"{tmp_path}/silver/t/CURRENT/*/*/*.parquet")) == 4


def test_an_export_computes_its_rows_once(spark, tmp_path):
    df = spark.range(20).select(F.concat(F.lit("V"), F.col("id") % 2).alias("vendor"), F.expr("uuid()").alias("v"))
    history, current = PB.vendor_export(df, str(tmp_path), "x", run_date="2026-01-01", run_id="r1")
    read = lambda p: rows(spark.read.option("header", True).csv(p), "vendor", "v")
    assert len(read(current)) == 20 and read(history) == read(current) and not df.is_cached


def test_page_files_are_in_one_folder(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u1", "h"), (2, "u2", "h"), (2, "u2", "h"), (3, None, "h")], "page_id long, url string, html string")
    pages.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    df = catalog.QUERIES["whole_documents"](spark, str(tmp_path))
    assert rows(df) == [("\n",), ("u1\n",), ("u2\nu2\n",)]
    assert not any("page_id=" in f for f in df.inputFiles())


def cells_shuffled(df) -> int:
    """Cells written to shuffles by message when the frame is run (an exchange that is read again is written once)."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    text = text.partition("== Initial Plan ==")[0]
    return sum("Exchange hashpartitioning(message_id" in x and "REPARTITION_BY_COL" in x and "Reused" not in x for x in text.splitlines())


def test_what_reads_whole_sheets_shares_one_shuffle(spark):
    cells = sheet(spark)
    kv, lines = I.header_kv_v1(cells), I.line_table_v1(cells)
    assert [cells_shuffled(df) for df in (kv, lines, kv.join(lines, "message_id"))] == [1, 1, 1]


def test_cells_keep_their_values_when_they_meet(spark):
    odd = [("A", 0, 0, "a|b|"), ("A", 0, 1, ""), ("A", 0, 2, None), ("A", None, 3, "|"), ("A", -1, None, "x\ny"), (None, 0, 0, "gone")]
    met = I.met_cells(spark.createDataFrame(odd, CELLS))
    assert rows(met) == sorted(odd[:-1], key=lambda t: tuple((x is None, str(x)) for x in t))
    assert I.met_cells(met) is met


def test_names_with_odd_blanks_are_found(spark):
    names = ["\u2003Floc \xa0 ID\x1c", "sce\tstruct__", "PHOTO_LOC", "FLIGHTDATE", "upload date", "Vendor  Status", "block_id", "unit_rate\n"]
    cells = [("A", 2, c, n) for c, n in enumerate(names)] + [("A", 3, 0, "OH-1"), ("B", 0, 0, "xfloc_id"), ("B", 1, 0, "flo cid")]
    df = spark.createDataFrame(cells, CELLS)
    for own in (df, I.met_cells(df)):
        assert rows(I.header_v2(own).select("message_id", "header_row", "at.*")) == [("A", 2, *range(8))]


def test_a_job_reads_sheets_once_and_only_those_it_loads(spark, tmp_path):
    cells, seen = sheet(spark), spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    counted = cells.mapInArrow(count, CELLS)
    files = spark.createDataFrame([("att__A__INV-1.xlsx",), ("att__C__INV-2.xlsx",)], "file_name string")
    emails = spark.createDataFrame([("email__A_.html", "<span>Supplier</span><b></b><span>ACME</span>")], "file_name string, html string")
    out = J.invoice_intake_v1(spark, counted, files, emails, root=f"{tmp_path}/1", run=J.Run("2026-01-01", "r1"), load_seq=1)
    assert seen.value == cells.count()
    assert rows(out["vendor_invoice_line_v1"], "floc_id", "line_number", "supplier") == [("OH-4", 1, "ACME"), ("OH-6", 2, "ACME")]
    assert rows(out["vendor_invoice_file_status"], "message_id", "status", "lines") == [("A", "OK", 2), ("C", "SKIPPED_NO_HTML", None)]
    out = J.invoice_intake_v2(counted, files, emails, root=f"{tmp_path}/2", run=J.Run("2026-01-01", "r1"))
    assert seen.value == 2 * cells.count()
    assert rows(out["vendor_invoice_line"], "floc_id", "line_number", "supplier") == [("OH-4", 1, "ACME"), ("OH-6", 2, "ACME")]
