"""Catalogue queries of readers, publishing and whole jobs: each fills a fresh lake below the scratch folder from the
fixture views and returns what a reader of it finds."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from lakework.functions import columns as COL
from lakework.operators import delta as D
from lakework.operators import eligibility as E
from lakework.operators import evidence as V
from lakework.operators import quality as Q
from lakework.plans import jobs as J
from lakework.plans.roles import MIN_IMAGES, RUNS, SOURCE_SYSTEM
from lakework.session import checkpoint_dir
from lakework.sources import publish as PB
from lakework.sources import readers as RD

Role = Callable[[SparkSession, str, str], DataFrame]


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared location that the cluster names in spark.checkpoint.dir."""
    return f"{checkpoint_dir(spark).rstrip('/')}/lakework-roundtrip/{name}-{uuid.uuid4().hex[:12]}"


def queries(role: Role, base: Callable[[SparkSession, str, str], DataFrame], own: dict[str, Callable]) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """``role`` gives a fixture view, ``base`` a driver table, ``own`` the catalogue's other queries by name."""

    def optional_read(spark, sf) -> DataFrame:
        """A dataset that was never published reads as empty, one that was as what was published."""
        root, supplier = scratch(spark, "optional"), base(spark, sf, "supplier")
        PB.publish_current(supplier, root, "silver", "supplier")
        parts = [RD.read_optional(spark, RD.dataset_path(root, "silver", name, "CURRENT"), supplier.schema) for name in ("supplier", "never")]
        return parts[0].unionByName(parts[1])

    def schema_misfits(spark, sf) -> DataFrame:
        """What a schema would lose of the survey export's text columns."""
        raw = role(spark, sf, "survey_raw").select("createdAt", "readyToSync", F.col("src_pos").cast("string").alias("src_pos"))
        return COL.misfits(raw, _parse_datatype_string("createdAt timestamp_ntz, readyToSync boolean, src_pos int, absent int"))

    def newest_drop(spark, sf) -> DataFrame:
        """The newest of many drop files, of which some carry no time in their name."""
        return RD.newest_drop_file(role(spark, sf, "drop_listing"))

    def _files(spark, sf) -> str:
        """One text file per page: its URL."""
        path = scratch(spark, "files")
        # Files of one folder, made and committed by many tasks: no folder for each page to make, list and move.
        text = F.array_join(F.sort_array(F.collect_list(F.coalesce("url", F.lit("")))), "\n").alias("text")
        pages = base(spark, sf, "pages").groupBy("page_id").agg(text).select("text")
        pages.repartition(4 * spark.sparkContext.defaultParallelism).write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path)
        return path

    def whole_documents(spark, sf) -> DataFrame:
        """One row per file, with its whole text."""
        return RD.read_documents(spark, _files(spark, sf)).select("text")

    def archive_receipts(spark, sf) -> DataFrame:
        """Size and content hash of every file."""
        found = PB.archive_manifest(spark, _files(spark, sf), run_date="2026-02-04", run_id="arc-0001")
        return found.select("length", "file_hash", "run_date", "run_id")

    def publish_whole_roundtrip(spark, sf) -> DataFrame:
        """K1: CURRENT holds the last run alone, HISTORY both."""
        root, supplier = scratch(spark, "whole"), base(spark, sf, "supplier").select("s_suppkey", "s_name")
        PB.publish_whole_table(supplier, root, "silver", "supplier", run_date="2026-02-01", run_id="r1")
        PB.publish_whole_table(supplier.filter("s_suppkey % 2 = 0"), root, "silver", "supplier", run_date="2026-02-02", run_id="r2")
        schema = supplier.schema.add("run_date", "string").add("run_id", "string")
        current = RD.read_current(spark, root, "silver", "supplier").withColumn("version", F.lit("CURRENT"))
        return current.unionByName(RD.read_history(spark, root, "silver", "supplier", schema=schema).withColumn("version", F.lit("HISTORY")))

    def vendor_history(spark, sf) -> DataFrame:
        """HISTORY by vendor, run and event type, read for a list of vendors."""
        root, lines = scratch(spark, "events"), own["events_history"](spark, sf).drop("run_date", "run_id")
        PB.publish_vendor_partitioned(lines, root, "silver", "scope_events", run_date="2026-02-01", run_id="r1", extra=["event_type"])
        schema = lines.schema.add("run_date", "string").add("run_id", "string")
        found = RD.read_history(spark, root, "silver", "scope_events", schema=schema, vendors=["V0", "V2"])
        return found.groupBy("vendor", "event_type", "run_id").agg(F.count(F.lit(1)).alias("row_count"))

    def publish_rerun_history(spark, sf) -> DataFrame:
        """K2: a run is repeated without one of its vendors; neither HISTORY nor CURRENT keeps rows of it from that run."""
        root, line = scratch(spark, "rerun"), own["release_line_distribution"](spark, sf).drop("run_date", "run_id")
        publish = lambda df, run_id: PB.publish_vendor_partitioned(df, root, "silver", "line", run_date="2026-02-01", run_id=run_id)
        publish(line, "r1")
        publish(line, "r2")
        publish(line.filter("vendor <> 'V1'"), "r2")
        schema = line.schema.add("run_date", "string").add("run_id", "string")
        both = RD.read_history(spark, root, "silver", "line", schema=schema).withColumn("version", F.lit("HISTORY"))
        both = both.unionByName(RD.read_current(spark, root, "silver", "line", schema=schema).withColumn("version", F.lit("CURRENT")))
        return both.groupBy("version", "vendor", "run_id").agg(F.count(F.lit(1)).alias("row_count"))

    def delta_history(spark, sf) -> DataFrame:
        """K6: the change sets of a delta as one table."""
        root, delta = scratch(spark, "delta"), own["snapshot_delta"](spark, sf)
        PB.publish_delta(delta, root, "orders", vendor="V9", run_date="2026-02-01", run_id="r1")
        schema = delta.schema.add("vendor", "string").add("run_date", "string").add("run_id", "string")
        found = RD.read_history(spark, root, "silver", "orders_delta", schema=schema)
        return found.groupBy("vendor", "change_set", "_delta_type").agg(F.count(F.lit(1)).alias("row_count"))

    def transmission_scope_fallback(spark, sf) -> DataFrame:
        """A transmission sheet without package slots is keyed by its scope column."""
        return D.keyed_transmission(role(spark, sf, "helo_trans_raw")).select("_key", "_floc", "_scope_id", "_visit_no", "_is_active")

    def transmission_keys_by_visit(spark, sf) -> DataFrame:
        """D3 with the visit in the key."""
        keyed = D.keyed_transmission(role(spark, sf, "snapshot_trans_cur_raw"), key_cols=("_scope_id", "_floc", "_visit_no"))
        return keyed.select("_key", "_visit_no", "_is_active")

    def event_contracts(spark, sf) -> DataFrame:
        """Q2: the contract of every event sheet."""
        out = None
        for kind, event_type in (("removal", "removal"), ("move", "move_to_helo")):
            for asset_class, short in (("Distribution", "dist"), ("Transmission", "trans")):
                part = Q.contract_report(role(spark, sf, f"events_{kind}_{short}_raw"), Q.contracts_for(event_type)[asset_class])
                out = part if out is None else out.unionByName(part)
        return out

    def deliveries_agg_raw_names(spark, sf) -> DataFrame:
        """Evidence with the export's own column names."""
        line = own["deliveries_line"](spark, sf).withColumnsRenamed({"floc": "structureId", "image_count": "imageCount"})
        return V.deliveries_agg(line.filter("asset_class = 'distribution'"), min_images=MIN_IMAGES)

    def eligibility_defaults(spark, sf) -> DataFrame:
        """Assignments without status and attributes take the defaults."""
        rd, rid = RUNS["eligibility"]
        current = own["scope_assignment_current"](spark, sf).filter("asset_class = 'Transmission'").drop("assignment_status", "is_active_assignment", "asset_class")
        evidence = own["deliveries_agg"](spark, sf).filter("asset_class = 'transmission'")
        return E.transmission_eligibility(current, evidence, min_images=MIN_IMAGES, run_date=rd, run_id=rid, source_system=SOURCE_SYSTEM)

    def workbook_events(spark, sf) -> DataFrame:
        """A workbook without its transmission sheet: the sheet is skipped, and said to be."""
        root, metrics = scratch(spark, "workbook"), {}
        book = {"Distribution": role(spark, sf, "events_removal_dist_raw").drop("run_date", "run_id", "vendor")}
        run = J.Run("2026-02-01", "wb-0001")
        lines = J.events_workbook_intake(book, root=root, vendor="V7", event_type="removal", run=run, metrics=metrics)
        skipped = ";".join(f"{k}={v}" for k, v in sorted(metrics.items()))
        return lines.groupBy("vendor", "source_sheet", "run_id").agg(F.count(F.lit(1)).alias("row_count"), F.lit(skipped).alias("skipped"))

    def eligibility_job(spark, sf) -> DataFrame:
        """The job over published inputs, run twice under one run id."""
        root, run = scratch(spark, "eligibility"), J.Run(*RUNS["eligibility"])
        lin = dict(run_date="2026-01-31", run_id="in-0001")
        current = own["scope_assignment_current"](spark, sf).drop("run_date", "run_id")
        for asset_class, dataset in J.GOLD_CURRENT.items():
            PB.publish_whole_table(current.filter(F.col("asset_class") == asset_class), root, "gold", dataset, **lin)
        line = own["deliveries_line"](spark, sf).drop("run_date", "run_id")
        for asset_class, dataset in J.DELIVERIES.items():
            PB.publish_vendor_partitioned(line.filter(F.col("asset_class") == asset_class), root, "silver", dataset, **lin)
        PB.publish_whole_table(own["survey_rollup"](spark, sf).drop("run_date", "run_id"), root, "silver", J.SURVEY_FLOC, **lin)
        PB.publish_whole_table(own["floc_attributes_dim"](spark, sf), root, "silver", J.FLOC_DIM, **lin)
        for _ in range(2):
            out = J.eligibility_job(spark, root=root, run=run, min_images=MIN_IMAGES, source_system=SOURCE_SYSTEM)
        return out["invoice_eligibility_line"]

    def _invoice_inputs(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
        return role(spark, sf, "invoice_cells"), role(spark, sf, "invoice_attachment_files"), role(spark, sf, "invoice_email_files")

    def invoice_job_v2(spark, sf) -> DataFrame:
        """The second variant's job: the lines of the files that are valid."""
        root = scratch(spark, "invoices2")
        J.invoice_intake_v2(*_invoice_inputs(spark, sf), root=root, run=J.Run(*RUNS["invoices"]))
        return RD.read_current(spark, root, "silver", "vendor_invoice_line").select("message_id", "line_number", "floc_id", "scope_id", "unit_rate", "supplier")

    def invoice_job_v1(spark, sf) -> DataFrame:
        """The first variant's job, two loads: CURRENT keeps the last version of each line."""
        root, (cells, files, emails) = scratch(spark, "invoices1"), _invoice_inputs(spark, sf)
        J.invoice_intake_v1(spark, cells, files, emails, root=root, run=J.Run("2026-02-01", "i1"), load_seq=1)
        out = J.invoice_intake_v1(spark, cells, files.filter("file_name like '%1.xlsx'"), emails, root=root, run=J.Run("2026-02-02", "i2"), load_seq=2)
        return out["vendor_invoice_line_v1"].select("message_id", "line_number", "floc_id", "unit_rate", "run_id", F.col("__load_seq").alias("load_seq"))

    def invoice_upsert_current(spark, sf) -> DataFrame:
        """K5: two overlapping loads through the accumulating publish."""
        root = scratch(spark, "upsert")
        for k in (1, 2):
            load = role(spark, sf, f"invoice_load_{k}")
            current = PB.publish_accumulating(spark, load, root, "silver", "invoices", ["message_id"], run_id=f"load-{k}", order="load_seq")
        return current

    return {name: f for name, f in locals().items() if callable(f) and not name.startswith("_") and name not in ("role", "base")}
