"""

Each job is a plain function of DataFrames (sheets, exports, documents arrive as
DataFrames; the caller reads them in their declared format) and lake locations.
Run values are arguments, so a job is deterministic and can be rerun; HISTORY
appends are keyed by run id, CURRENT replacements are idempotent.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.operators import assignment as A
from lakework.operators import delta as D
from lakework.operators import dimension as M
from lakework.operators import eligibility as E
from lakework.operators import evidence as V
from lakework.operators import invoices as I
from lakework.operators import pricing as P
from lakework.operators import quality as Q
from lakework.sources import publish as PB
from lakework.sources import readers as RD


@dataclass(frozen=True)
class Run:
    run_date: str
    run_id: str


# Dataset names (lake layout).
RELEASE = {"Distribution": "scope_release_distribution", "Transmission": "scope_release_transmission"}
HELO = {"Distribution": "helo_scope_distribution", "Transmission": "helo_scope_transmission"}
EVENTS = "scope_events"
GOLD_CURRENT = {"Distribution": "scope_assignment_current_distribution", "Transmission": "scope_assignment_current_transmission"}
DELIVERIES = {"distribution": "gcp_deliveries_distribution", "transmission": "gcp_deliveries_transmission"}
SURVEY_LINE, SURVEY_FLOC = "azure_inspections_line", "azure_inspections_floc"
SCOPE_MASTER, FLOC_DIM = "scope_master_line", "floc_attributes_dim"
RATE_CARD = "pricing_rate_card"


def _strings(df: DataFrame) -> DataFrame:
    """Bronze keeps every raw column; cast to text so runs with different inferred types still append."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def release_intake(
    spark: SparkSession, raw: DataFrame, *, root: str, vendor: str, asset_class: str, run: Run, source_file: str = "", metrics: dict | None = None
) -> DataFrame:
    """Bronze copy, key delta against the previous snapshot, silver line and load header.

    Returns the delta (empty when there is no previous snapshot).  ``metrics``
    (K12) receives line counts observed while the line is written (no extra job).
    """
    ds = RELEASE[asset_class]
    bronze = _strings(raw).withColumn("vendor", F.lit(vendor))
    PB.publish_history(bronze, root, "bronze", ds, run_date=run.run_date, run_id=run.run_id, partitions=["vendor"])
    history = RD.dataset_path(root, "bronze", ds, "HISTORY")
    own = dict(by_vendor=True, vendor=vendor)
    keyed = D.keyed_distribution if asset_class == "Distribution" else D.keyed_transmission
    cur_raw = RD.read_run(spark, history, bronze.schema, run_date=run.run_date, run_id=run.run_id, **own).drop("vendor", "run_date", "run_id")
    prev_raw = RD.read_previous_run(spark, history, bronze.schema, run.run_id, **own).drop("vendor", "run_date", "run_id")
    first = prev_raw.isEmpty()
    delta = D.key_delta(keyed(prev_raw), keyed(cur_raw), check_unique=not first)
    if first:  # no previous snapshot: the delta is skipped, as in the reference
        delta = spark.createDataFrame([], delta.schema)
    else:
        PB.publish_delta(delta, root, ds, vendor=vendor, run_date=run.run_date, run_id=run.run_id)
    builder = A.release_line_distribution if asset_class == "Distribution" else A.release_line_transmission
    line = builder(raw, run_date=run.run_date, run_id=run.run_id, source_file_saved=source_file, vendor=vendor)
    obs = Observation(f"release_line_{run.run_id}")
    observed = line.observe(
        obs,
        F.count(F.lit(1)).alias("line_rows"),
        F.count_if(~F.col("is_active")).alias("inactive_rows"),
        F.count_if(F.col("scope_id") == "COMP").alias("comp_rows"),
    )
    PB.publish_history(observed.drop("run_date", "run_id"), root, "silver", f"{ds}_line", run_date=run.run_date, run_id=run.run_id,
                       partitions=["vendor"])
    written = RD.read_run(spark, RD.dataset_path(root, "silver", f"{ds}_line", "HISTORY"), line.schema, run_date=run.run_date, run_id=run.run_id, **own)
    PB.publish_current(written, root, "silver", f"{ds}_line", partitions=["vendor"], run_id=run.run_id)
    if metrics is not None:
        metrics.update(obs.get)
    header = PB.load_header(cur_raw, written, dataset=ds, run_date=run.run_date, run_id=run.run_id, vendor=vendor)
    PB.publish_history(header.drop("run_date", "run_id", "vendor").withColumn("vendor", F.lit(vendor)), root, "silver", f"{ds}_header",
                       run_date=run.run_date, run_id=run.run_id, partitions=["vendor"])
    return delta


def events_intake(raw: DataFrame, *, root: str, vendor: str, event_type: str, asset_class: str, run: Run, source_file: str = "") -> DataFrame:
    """Removal / move_to_helo events, HISTORY partitioned by vendor and event type (K3)."""
    ev = A.events_line(raw, event_type=event_type, asset_class=asset_class, run_date=run.run_date, run_id=run.run_id,
                       source_file_saved=source_file, vendor=vendor)
    PB.publish_history(ev.drop("run_date", "run_id"), root, "silver", EVENTS, run_date=run.run_date, run_id=run.run_id,
                       partitions=["vendor", "event_type"])
    return ev


SHEETS = ("Distribution", "Transmission")


def events_workbook_intake(
    workbook: dict[str, DataFrame], *, root: str, vendor: str, event_type: str, run: Run, source_file: str = "", metrics: dict | None = None
) -> DataFrame:
    """J2 over a workbook (sheet name → rows): every sheet that is there, checked against its contract (Q2).

    S9: a missing sheet is skipped and noted in ``metrics``; a workbook without any is an error.
    """
    lines = None
    for sheet in SHEETS:
        if sheet not in workbook:
            if metrics is not None:
                metrics[f"{sheet}__skipped"] = "missing sheet"
            continue
        Q.require_contract(workbook[sheet], Q.contracts_for(event_type)[sheet])
        part = A.events_line(workbook[sheet], event_type=event_type, asset_class=sheet, run_date=run.run_date, run_id=run.run_id,
                             source_file_saved=source_file, vendor=vendor)
        lines = part if lines is None else lines.unionByName(part)
    if lines is None:
        raise ValueError(f"the workbook has none of the sheets {SHEETS}")
    PB.publish_history(lines.drop("run_date", "run_id"), root, "silver", EVENTS, run_date=run.run_date, run_id=run.run_id,
                       partitions=["vendor", "event_type"])
    path = RD.dataset_path(root, "silver", EVENTS, "HISTORY")
    return RD.read_run(lines.sparkSession, path, lines.schema, run_date=run.run_date, run_id=run.run_id, by_vendor=True, vendor=vendor)


def helo_intake(raw: DataFrame, *, root: str, vendor: str, asset_class: str, run: Run, source_file: str = "") -> DataFrame:
    """HELO assignment line, vendor-partitioned HISTORY and CURRENT."""
    line = A.helo_line(raw, run_date=run.run_date, run_id=run.run_id, source_file_saved=source_file, source_sheet=asset_class, vendor=vendor)
    PB.publish_vendor_partitioned(line.drop("run_date", "run_id"), root, "silver", f"{HELO[asset_class]}_line", run_date=run.run_date, run_id=run.run_id)
    return line


def _line_schema() -> T.StructType:
    return A.LINE_SCHEMA


def current_assignment_job(spark: SparkSession, *, root: str, run: Run, vendors=None) -> dict[str, DataFrame]:
    """Latest event per key from all event history, then per asset class union → W2 → J-a → D8; gold publish."""
    ev_schema = A.EVENT_SCHEMA
    events = RD.read_optional(spark, RD.dataset_path(root, "silver", EVENTS, "HISTORY"), ev_schema)
    if vendors:
        events = events.filter(F.col("vendor").isin(list(vendors)))
    latest = A.latest_events(events)
    out = {}
    for ac in ("Distribution", "Transmission"):
        drone = RD.read_optional(spark, RD.dataset_path(root, "silver", f"{RELEASE[ac]}_line", "CURRENT"), _line_schema())
        helo = RD.read_optional(spark, RD.dataset_path(root, "silver", f"{HELO[ac]}_line", "CURRENT"), _line_schema())
        if vendors:
            drone, helo = drone.filter(F.col("vendor").isin(list(vendors))), helo.filter(F.col("vendor").isin(list(vendors)))
        gold = A.current_assignment(drone, helo, latest, asset_class=ac, drone_dataset=RELEASE[ac], helo_dataset=HELO[ac],
                                    gold_run_date=run.run_date, gold_run_id=run.run_id)
        PB.publish_whole_table(gold.drop("run_date", "run_id"), root, "gold", GOLD_CURRENT[ac], run_date=run.run_date, run_id=run.run_id)
        out[ac] = RD.read_current(spark, root, "gold", GOLD_CURRENT[ac])
    return out


def deliveries_intake(raw: DataFrame, *, root: str, asset_class: str, run: Run, source_system: str = "GCP", vendors=None) -> DataFrame:
    """Deliveries line (vendor list filter first), vendor-partitioned publish."""
    if vendors:
        raw = raw.filter(F.trim(F.col("vendor")).isin([v.strip() for v in vendors]))
    line = V.deliveries_line(raw, asset_class=asset_class, run_date=run.run_date, run_id=run.run_id, source_system=source_system)
    PB.publish_vendor_partitioned(line.drop("run_date", "run_id"), root, "silver", DELIVERIES[asset_class.lower()], run_date=run.run_date, run_id=run.run_id)
    return line


def survey_intake(raw: DataFrame, *, root: str, run: Run, source_system: str = "AZURE", position=None) -> DataFrame:
    """Survey line and floc rollup, whole-table publishes."""
    line = V.survey_line(raw, run_date=run.run_date, run_id=run.run_id, source_system=source_system, position=position)
    roll = V.survey_rollup(line, run_date=run.run_date, run_id=run.run_id)
    PB.publish_whole_table(line.drop("run_date", "run_id", "src_pos"), root, "silver", SURVEY_LINE, run_date=run.run_date, run_id=run.run_id)
    PB.publish_whole_table(roll.drop("run_date", "run_id"), root, "silver", SURVEY_FLOC, run_date=run.run_date, run_id=run.run_id)
    return roll


def scope_master_job(lists: list[tuple[DataFrame, str, str]], *, root: str, run: Run, source_system: str = "SCOPE_MASTER") -> DataFrame:
    """Three official lists → union → floc attribute dimension; whole-table publishes."""
    lines = [M.scope_list_line(df, asset_class=ac, scope_list=sl, run_date=run.run_date, run_id=run.run_id, source_system=source_system,
                               position=F.monotonically_increasing_id()) for df, ac, sl in lists]
    master = M.scope_master_union(lines)
    dim = M.floc_attributes_dim(master)
    PB.publish_whole_table(master.drop("src_pos", "run_date", "run_id"), root, "silver", SCOPE_MASTER, run_date=run.run_date, run_id=run.run_id)
    PB.publish_whole_table(dim, root, "silver", FLOC_DIM, run_date=run.run_date, run_id=run.run_id)
    return dim


def rate_card_job(raw: DataFrame, *, root: str, run: Run, source_system: str = "FINANCE", position=None) -> DataFrame:
    """Normalised rate card, whole-table publish."""
    rc = P.rate_card(raw, run_date=run.run_date, run_id=run.run_id, source_system=source_system, position=position)
    PB.publish_whole_table(rc, root, "silver", RATE_CARD, run_date=run.run_date, run_id=run.run_id)
    return rc


def eligibility_job(
    spark: SparkSession, *, root: str, run: Run, min_images: int = 8, source_system: str = "INTERNAL", metrics: dict | None = None
) -> dict[str, DataFrame]:
    """Eligibility lines (both classes), unmatched evidence, scope summary; five publishes.

    ``metrics`` (K12/Q9) receives line counts and the null counts left by the
    dimension join, observed while the line table is written.
    """
    cur = {ac: RD.read_current(spark, root, "gold", GOLD_CURRENT[ac]) for ac in GOLD_CURRENT}
    dim = E.standardize_floc_dim(RD.read_current(spark, root, "silver", FLOC_DIM))
    deliveries = {k: RD.read_optional(spark, RD.dataset_path(root, "silver", ds, "CURRENT"), V.DELIVERY_LINE_SCHEMA) for k, ds in DELIVERIES.items()}
    survey = V.standardize_survey_floc(RD.read_current(spark, root, "silver", SURVEY_FLOC))
    kw = dict(min_images=min_images, run_date=run.run_date, run_id=run.run_id, source_system=source_system)
    with ExitStack() as stack:
        # The lines and the unmatched evidence ask for the same aggregates.
        dagg = {k: stack.enter_context(_kept(V.deliveries_agg(df, min_images=min_images))) for k, df in deliveries.items()}
        dist = E.distribution_eligibility(cur["Distribution"], dagg["distribution"], survey, floc_dim=dim, **kw)
        trans = E.transmission_eligibility(cur["Transmission"], dagg["transmission"], floc_dim=dim, **kw)
        line = dist.unionByName(trans, allowMissingColumns=True)
        obs = Observation(f"eligibility_{run.run_id}")
        line = line.observe(
            obs,
            F.count(F.lit(1)).alias("line_rows"),
            F.count_if(F.col("approved_to_invoice")).alias("approved_rows"),
            F.count_if(F.col("object_type").isNull()).alias("object_type_nulls"),
            F.count_if(F.col("voltage").isNull()).alias("voltage_nulls"),
        )
        lin = dict(run_date=run.run_date, run_id=run.run_id, source_system=source_system)
        publish = lambda name, df: PB.publish_whole_table(df.drop("run_date", "run_id"), root, "gold", name, run_date=run.run_date, run_id=run.run_id)
        publish("invoice_eligibility_line", line)
        if metrics is not None:
            metrics.update(obs.get)
        out = {
            # The summary reads the lines that were just published.
            "eligibility_scope_summary": E.scope_summary(RD.read_current(spark, root, "gold", "invoice_eligibility_line"), **lin),
            "unmatched_gcp_distribution": E.unmatched_deliveries(cur["Distribution"], dagg["distribution"], asset_class="distribution", **lin),
            "unmatched_gcp_transmission": E.unmatched_deliveries(cur["Transmission"], dagg["transmission"], asset_class="transmission", **lin),
            "unmatched_azure_distribution": E.unmatched_surveys(cur["Distribution"], survey, **lin),
        }
        for name, df in out.items():
            publish(name, df)
    return {name: RD.read_current(spark, root, "gold", name) for name in ("invoice_eligibility_line", *out)}


def pricing_job(spark: SparkSession, rows: DataFrame, *, root: str) -> DataFrame:
    """Unit price for rows to accrue, from the CURRENT rate card."""
    return P.attach_unit_price(rows, RD.read_current(spark, root, "silver", RATE_CARD))


@contextmanager
def _kept(df: DataFrame) -> Iterator[DataFrame]:
    """A frame that is computed once for all that the block reads from it; what does not fit in memory goes to disk."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def _paired_cells(cells: DataFrame, attachments: DataFrame, emails: DataFrame) -> DataFrame:
    """The sheets of the attachments that have an e-mail, their cells in one task a message."""
    paired = attachments.select("message_id").join(emails.select("message_id"), "message_id", "left_semi")
    return I.met_cells(cells.join(paired, "message_id", "left_semi"))


def invoice_intake_v2(cells: DataFrame, attachment_files: DataFrame, email_files: DataFrame, *, root: str, run: Run,
                      source_system: str = "ARIBA_EMAIL_EXPORT") -> dict[str, DataFrame]:
    """Manifest (with whole-file validation), header and lines of the valid invoices."""
    att = I.attachment_manifest(attachment_files)
    em = I.email_index(email_files)
    spark, lin = cells.sparkSession, dict(run_date=run.run_date, run_id=run.run_id)

    def publish(df: DataFrame, layer: str, name: str) -> DataFrame:
        PB.publish_whole_table(df.drop("run_date", "run_id"), root, layer, name, **lin)
        return RD.read_current(spark, root, layer, name)

    # Sheets are read once, and their lines made once.
    with _kept(_paired_cells(cells, att, em)) as sheets, _kept(I.number_lines(I.canonical_lines_v2(I.line_table_v2(sheets)))) as canon:
        manifest = publish(I.file_manifest_v2(att, em.drop("html"), canon, source_system=source_system, **lin), "bronze", "vendor_invoices_file_manifest")
        # The verdicts are read back, not derived again.
        ok = manifest.filter(F.col("status") == "PARSED_OK").select("message_id")
        meta = I.email_fields(em.join(ok, "message_id", "left_semi"), "v2")
        header = (att.join(em.select("message_id", "html_file"), "message_id").join(ok, "message_id", "left_semi")
                  .join(meta, "message_id", "left").join(I.header_kv_v2(sheets), "message_id", "left"))
        header = publish(header, "silver", "vendor_invoice_header")
        meta = header.select("message_id", "supplier", "supplier_invoice_number")
        lines = publish(canon.join(ok, "message_id", "left_semi").join(meta, "message_id", "left"), "silver", "vendor_invoice_line")
    return {"vendor_invoices_file_manifest": manifest, "vendor_invoice_header": header, "vendor_invoice_line": lines}


def invoice_intake_v1(spark: SparkSession, cells: DataFrame, attachment_files: DataFrame, email_files: DataFrame, *, root: str, run: Run,
                      load_seq: int, source_system: str = "ARIBA_EMAIL_EXPORT") -> dict[str, DataFrame]:
    """Header and lines of the files that parse; HISTORY per run, CURRENT accumulated.

    CURRENT keeps the last version per message (header) and per (message, line
    number) (lines); ``load_seq`` orders loads (later wins).  Files without an
    e-mail or without a line-table header are reported in the manifest, not
    loaded (a bad file never fails the run).
    """
    att = I.attachment_manifest(attachment_files)
    em = I.email_index(email_files)
    out, lin = {}, dict(run_date=run.run_date, run_id=run.run_id)

    def load(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
        """HISTORY of the run and the accumulated CURRENT; returns the rows of the run as written."""
        history = PB.publish_history(df.drop("run_date", "run_id"), root, "silver", name, **lin)
        written = RD.read_run(spark, history, df.schema, **lin)
        out[name] = PB.publish_accumulating(spark, written.withColumn("__load_seq", F.lit(load_seq).cast("bigint")), root, "silver", name, keys, run_id=run.run_id)
        return written

    # Sheets are read once; e-mails are read for the files that parse.
    with _kept(_paired_cells(cells, att, em)) as sheets:
        hdr_rows = I.header_row_v1(sheets)
        ok = att.join(em.select("message_id"), "message_id", "left_semi").join(hdr_rows.select("message_id"), "message_id", "left_semi")
        fields = I.email_fields(em.join(ok.select("message_id"), "message_id", "left_semi"), "v1")
        header = load(I.invoice_header_v1(I.header_kv_v1(sheets), fields, ok, source_system=source_system, **lin), "vendor_invoice_header_v1", ["message_id"])
        lines = load(I.invoice_lines_v1(I.line_table_v1(sheets), header, source_system=source_system, **lin), "vendor_invoice_line_v1", ["message_id", "line_number"])
        manifest = I.file_manifest_v1(att, em.drop("html"), hdr_rows, lines)
        status = PB.publish_history(manifest, root, "bronze", "vendor_invoice_file_status", **lin)
    return {"vendor_invoice_file_status": RD.read_run(spark, status, manifest.schema, **lin).select(*manifest.columns)} | out
