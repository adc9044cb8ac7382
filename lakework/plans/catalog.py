"""

Each entry is ``(spark, sf_dir) -> DataFrame``: it reads the fixture views of
``roles.py`` (whole tables) and runs the library's operators on them.  Nothing
here collects data; the caller decides what to do with the lazy result.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakework.functions import clean as C
from lakework.functions import html as HT
from lakework.operators import assignment as A
from lakework.operators import delta as D
from lakework.operators import dimension as M
from lakework.operators import eligibility as E
from lakework.operators import evidence as V
from lakework.operators import history as H
from lakework.operators import invoices as I
from lakework.operators import ledger as L
from lakework.operators import quality as Q
from lakework.functions import columns as COL
from lakework.operators import pricing as P
from lakework.plans.lake_queries import queries as lake_queries
from lakework.plans.lake_queries import scratch
from lakework.plans.roles import BASE_TABLES, MIN_IMAGES, ROLE_RENAMES, ROLE_SQL, ROLE_SQL_SPARK, RUNS, SOURCE_SYSTEM

_TABLE_REF = re.compile(r"\bFROM\s+(\w+)\b")


def _view_name(sf_dir: str, table: str) -> str:
    return "lw_" + re.sub(r"\W", "_", sf_dir.rstrip("/").rsplit("/", 1)[-1]) + f"_{abs(hash(sf_dir)) % 10**8}_{table}"


def _register(spark: SparkSession, sf_dir: str, table: str) -> str:
    """A temp view per (data folder, table), resolved once per session."""
    name = _view_name(sf_dir, table)
    if not spark.catalog.tableExists(name):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(name)
    return name


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view over the parquet tables of ``sf_dir``."""

    def ref(m: re.Match) -> str:
        t = m.group(1)
        return f"FROM {_register(spark, sf_dir, t)}" if t in BASE_TABLES else m.group(0)

    df = spark.sql(_TABLE_REF.sub(ref, ROLE_SQL_SPARK.get(name, ROLE_SQL[name])))
    renames = ROLE_RENAMES.get(name)
    return df.withColumnsRenamed(renames) if renames else df


# --- assignment -------------------------------------------------------------


def release_line_distribution(spark, sf) -> DataFrame:
    rd, rid = RUNS["release_dist"]
    return A.release_line_distribution(role(spark, sf, "release_dist_raw"), run_date=rd, run_id=rid, source_file_saved="release_dist.xlsx")


def release_line_transmission(spark, sf) -> DataFrame:
    rd, rid = RUNS["release_trans"]
    return A.release_line_transmission(role(spark, sf, "release_trans_raw"), run_date=rd, run_id=rid, source_file_saved="release_trans.xlsx")


def _helo(spark, sf, asset_class: str) -> DataFrame:
    rd, rid = RUNS["helo"]
    name = "helo_dist_raw" if asset_class == "Distribution" else "helo_trans_raw"
    return A.helo_line(role(spark, sf, name), run_date=rd, run_id=rid, source_file_saved="helo_tracker.xlsx", source_sheet=asset_class)


def helo_line(spark, sf) -> DataFrame:
    return _helo(spark, sf, "Distribution").unionByName(_helo(spark, sf, "Transmission"))


def _events(spark, sf, event_type: str) -> DataFrame:
    """One sheet per asset class."""
    out = None
    for asset_class, short in (("Distribution", "dist"), ("Transmission", "trans")):
        raw = role(spark, sf, f"events_{'removal' if event_type == 'removal' else 'move'}_{short}_raw")
        part = A.events_line(
            raw, event_type=event_type, asset_class=asset_class,
            run_date=F.col("run_date"), run_id=F.col("run_id"), source_file_saved="events.xlsx",
        )
        out = part if out is None else out.unionByName(part)
    return out


def removal_events(spark, sf) -> DataFrame:
    return _events(spark, sf, "removal")


def move_events(spark, sf) -> DataFrame:
    return _events(spark, sf, "move_to_helo")


def events_history(spark, sf) -> DataFrame:
    """Every event of every sheet and type, in one pass over the events."""
    return A.event_lines(role(spark, sf, "events_raw"), run_date=F.col("run_date"), run_id=F.col("run_id"), source_file_saved="events.xlsx")


def latest_event(spark, sf) -> DataFrame:
    return A.latest_events(events_history(spark, sf))


_DATASETS = {
    "Distribution": ("scope_release_distribution", "helo_scope_distribution"),
    "Transmission": ("scope_release_transmission", "helo_scope_transmission"),
}


def preferred_assignment(spark, sf) -> DataFrame:
    drone_ds, helo_ds = _DATASETS["Distribution"]
    d = A.prepare_assignments(release_line_distribution(spark, sf), method="DRONE", asset_class="Distribution", source_dataset=drone_ds)
    h = A.prepare_assignments(_helo(spark, sf, "Distribution"), method="HELO", asset_class="Distribution", source_dataset=helo_ds)
    return A.preferred_assignment(d.unionByName(h))


_FILES = {"Distribution": "release_dist", "Transmission": "release_trans"}


def _sources() -> dict[tuple[str, str], A.Source]:
    sources = {}
    for asset_class, (drone_ds, helo_ds) in _DATASETS.items():
        sources[asset_class, "DRONE"] = A.Source(*RUNS[_FILES[asset_class]], f"{_FILES[asset_class]}.xlsx", drone_ds)
        sources[asset_class, "HELO"] = A.Source(*RUNS["helo"], "helo_tracker.xlsx", helo_ds)
    return sources


def assignment_lines(spark, sf) -> DataFrame:
    """Release and HELO lines of both asset classes, in one pass over the sheets."""
    return A.assignment_lines(role(spark, sf, "assignment_sheets_raw"), _sources())


def scope_assignment_current(spark, sf) -> DataFrame:
    gd, gid = RUNS["gold"]
    return A.current_assignments(assignment_lines(spark, sf), latest_event(spark, sf), gold_run_date=gd, gold_run_id=gid, sources=_sources())


# --- evidence -----------------------------------------------------------------


def deliveries_line(spark, sf) -> DataFrame:
    rd, rid = RUNS["deliveries"]
    raw = role(spark, sf, "deliveries_raw")
    return V.deliveries_line(raw, run_date=rd, run_id=rid, source_system="GCP", source_file_saved="deliveries.csv")


def deliveries_agg(spark, sf) -> DataFrame:
    return V.deliveries_agg(deliveries_line(spark, sf), min_images=MIN_IMAGES, by_class=True)


def survey_line(spark, sf) -> DataFrame:
    rd, rid = RUNS["survey"]
    raw = role(spark, sf, "survey_raw")
    return V.survey_line(raw, run_date=rd, run_id=rid, source_system="AZURE", source_file_saved="survey.csv", position=F.col("src_pos"))


def survey_line_public(spark, sf) -> DataFrame:
    return survey_line(spark, sf).drop("src_pos")


def survey_rollup(spark, sf) -> DataFrame:
    rd, rid = RUNS["survey"]
    return V.survey_rollup(survey_line(spark, sf), run_date=rd, run_id=rid)


# --- scope master, dimension, pricing ----------------------------------------------


def scope_master_union(spark, sf) -> DataFrame:
    """The three official lists, in one pass over the table that they are views of."""
    rd, rid = RUNS["scope_master"]
    lists = [
        (has, {
            "floc": F.col(floc), "object_type": F.col(obj), "voltage": F.col(volt) if volt else F.lit(None).cast("string"),
            "asset_class": F.lit(ac), "scope_list": F.lit(sl), "source_file_saved": F.lit(f"{sl.lower()}.xlsx"), "position": F.col("src_pos"),
        })
        for has, floc, obj, volt, ac, sl in (
            (F.lit(True), "FLOC", "Eq_OjType", "Voltage", "distribution", "DIST_LIST"),
            (F.col("in_trans"), "FLOC_ID", "EqType", "kV", "transmission", "TRANS_LIST"),
            (F.col("in_comp"), "FLOC_ID", "Eq_ObjType", None, "distribution", "COMP_LIST"),
        )
    ]
    return M.scope_lists(role(spark, sf, "scope_lists_raw"), lists, run_date=rd, run_id=rid, source_system="SCOPE_MASTER")


def scope_list_line(spark, sf) -> DataFrame:
    """One list as a sheet of its own, with its column spellings."""
    rd, rid = RUNS["scope_master"]
    raw = role(spark, sf, "scope_list_trans_raw")
    return M.scope_list_line(raw, asset_class="transmission", scope_list="TRANS_LIST", run_date=rd, run_id=rid,
                             source_system="SCOPE_MASTER", source_file_saved="trans_list.xlsx", position=F.col("src_pos"))


def scope_master_public(spark, sf) -> DataFrame:
    return scope_master_union(spark, sf).drop("src_pos")


def floc_attributes_dim(spark, sf) -> DataFrame:
    return M.floc_attributes_dim(scope_master_union(spark, sf))


def floc_dim_ranked(spark, sf) -> DataFrame:
    return E.standardize_floc_dim(floc_attributes_dim(spark, sf))


def rate_card(spark, sf) -> DataFrame:
    rd, rid = RUNS["rate_card"]
    return P.rate_card(role(spark, sf, "rate_card_raw"), run_date=rd, run_id=rid, source_system="FINANCE", position=F.col("rule_pos"))


def unit_price(spark, sf) -> DataFrame:
    return P.attach_unit_price(role(spark, sf, "price_rows"), rate_card(spark, sf))


def pricing_status_counts(spark, sf) -> DataFrame:
    priced = unit_price(spark, sf)
    return priced.groupBy("pricing_match_status").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("unit_price").isNull()).alias("n_price_null"),
    )


# --- eligibility --------------------------------------------------------------------


def _evidence(spark, sf) -> DataFrame:
    """Deliveries by class as the assignments spell it, so that the join on it needs no other shuffle."""
    line = deliveries_line(spark, sf).withColumn("asset_class", F.initcap("asset_class"))
    return V.deliveries_agg(line, min_images=MIN_IMAGES, by_class=True)


def _eligibility_evidence(spark, sf) -> DataFrame:
    surveys = V.standardize_survey_floc(survey_rollup(spark, sf))
    return E.eligibility_evidence(scope_assignment_current(spark, sf), _evidence(spark, sf), surveys, floc_dim=floc_dim_ranked(spark, sf))


def _decided(evidence: DataFrame, rule_version: str) -> DataFrame:
    rd, rid = RUNS["eligibility"]
    return E.decided_lines(evidence, min_images=MIN_IMAGES, run_date=rd, run_id=rid, source_system=SOURCE_SYSTEM, rule_version=rule_version)


def _eligibility(spark, sf, rule_version: str) -> DataFrame:
    return _decided(_eligibility_evidence(spark, sf), rule_version)


def invoice_eligibility_line(spark, sf) -> DataFrame:
    return _eligibility(spark, sf, "v2")


def eligibility_v1(spark, sf) -> DataFrame:
    return _eligibility(spark, sf, "v1")


def eligibility_scope_summary(spark, sf) -> DataFrame:
    rd, rid = RUNS["eligibility"]
    return E.scope_summary(invoice_eligibility_line(spark, sf), run_date=rd, run_id=rid, source_system=SOURCE_SYSTEM)


def unmatched_deliveries(spark, sf) -> DataFrame:
    rd, rid = RUNS["eligibility"]
    return E.unmatched_deliveries(
        scope_assignment_current(spark, sf), _evidence(spark, sf), run_date=rd, run_id=rid, source_system=SOURCE_SYSTEM
    )


def unmatched_surveys(spark, sf) -> DataFrame:
    rd, rid = RUNS["eligibility"]
    return E.unmatched_surveys(
        scope_assignment_current(spark, sf).filter(F.col("asset_class") == "Distribution"),
        V.standardize_survey_floc(survey_rollup(spark, sf)),
        run_date=rd, run_id=rid, source_system=SOURCE_SYSTEM,
    )


# --- snapshots ----------------------------------------------------------------------


def snapshot_delta(spark, sf) -> DataFrame:
    prev = D.keyed_distribution(role(spark, sf, "snapshot_prev_raw"))
    cur = D.keyed_distribution(role(spark, sf, "snapshot_cur_raw"))
    out = D.key_delta(prev, cur, check_unique=False)
    return out.select("change_set", "_delta_type", "_key", "FLOC", "SCOPE_ID", "SCOPE_REMOVAL_DATE", "AMOUNT", "STATUS", "_is_active")


def snapshot_delta_transmission(spark, sf) -> DataFrame:
    prev = D.keyed_transmission(role(spark, sf, "snapshot_trans_prev_raw"))
    cur = D.keyed_transmission(role(spark, sf, "snapshot_trans_cur_raw"))
    out = D.key_delta(prev, cur, check_unique=False)
    return out.select("change_set", "_delta_type", "_key", "FLOC", "Date_Removed", "AMOUNT", "_visit_no", "_is_active")


def release_load_header(spark, sf) -> DataFrame:
    from lakework.sources import publish as PB

    rd, rid = RUNS["release_dist"]
    raw = role(spark, sf, "release_dist_raw")
    return PB.load_header(raw.drop("vendor"), release_line_distribution(spark, sf), dataset="scope_release_distribution",
                          run_date=rd, run_id=rid)


def canonical_keys(spark, sf) -> DataFrame:
    return D.canonical_key_frame(D.keyed_distribution(role(spark, sf, "snapshot_cur_raw")))


def row_signature(spark, sf) -> DataFrame:
    raw = role(spark, sf, "snapshot_cur_raw")
    return raw.select("FLOC", C.row_signature(raw.columns).alias("row_sig"))


# --- invoices -----------------------------------------------------------------------


def html_fields(spark, sf) -> DataFrame:
    pages = role(spark, sf, "html_pages").select("*", HT.lines(HT.tokens(F.col("html"))).alias("lines"))
    return pages.select(
        "page_id",
        "url",
        HT.element_text(F.col("html"), "title").alias("title"),
        HT.element_text(F.col("html"), "h1").alias("h1"),
        F.size("lines").alias("n_lines"),
        F.get("lines", F.lit(0)).alias("first_line"),
    )


def html_lines(spark, sf) -> DataFrame:
    """Every text line of every page."""
    pages = role(spark, sf, "html_pages")
    return pages.select("page_id", F.posexplode(HT.lines(HT.tokens(F.col("html")))).alias("line_no", "line"))


def _cells(spark, sf) -> DataFrame:
    return role(spark, sf, "invoice_cells")


def _attachments(spark, sf) -> DataFrame:
    return I.attachment_manifest(role(spark, sf, "invoice_attachment_files"))


def _emails(spark, sf) -> DataFrame:
    return I.email_index(role(spark, sf, "invoice_email_files"))


def invoice_email_fields(spark, sf) -> DataFrame:
    return I.email_fields(_emails(spark, sf), "v2")


def grid_header_row(spark, sf) -> DataFrame:
    return I.header_row_v1(_cells(spark, sf))


def grid_header_row_v2(spark, sf) -> DataFrame:
    return I.header_row_v2(_cells(spark, sf))


def grid_header_kv(spark, sf) -> DataFrame:
    return I.header_kv_v1(_cells(spark, sf))


def grid_header_kv_v2(spark, sf) -> DataFrame:
    return I.header_kv_v2(_cells(spark, sf))


def grid_lines(spark, sf) -> DataFrame:
    return I.line_table_v1(_cells(spark, sf))


def invoice_header(spark, sf) -> DataFrame:
    rd, rid = RUNS["invoices"]
    return I.invoice_header_v1(
        I.header_kv_v1(_cells(spark, sf)), I.email_fields(_emails(spark, sf), "v1"), _attachments(spark, sf),
        run_date=rd, run_id=rid, source_system="ARIBA_EMAIL_EXPORT",
    )


def invoice_lines_v1(spark, sf) -> DataFrame:
    rd, rid = RUNS["invoices"]
    return I.invoice_lines_v1(I.line_table_v1(_cells(spark, sf)), invoice_header(spark, sf), run_date=rd, run_id=rid, source_system="ARIBA_EMAIL_EXPORT")


def _canonical_v2(spark, sf) -> DataFrame:
    return I.canonical_lines_v2(I.line_table_v2(_cells(spark, sf)))


def file_manifest_status(spark, sf) -> DataFrame:
    rd, rid = RUNS["invoices"]
    return I.file_manifest_v2(
        _attachments(spark, sf), _emails(spark, sf), _canonical_v2(spark, sf),
        run_date=rd, run_id=rid, source_system="ARIBA_EMAIL_EXPORT",
    )


def invoice_lines_v2(spark, sf) -> DataFrame:
    rd, rid = RUNS["invoices"]
    ok = file_manifest_status(spark, sf).filter(F.col("status") == "PARSED_OK").select("message_id")
    meta = I.email_fields(_emails(spark, sf), "v2").select("message_id", "supplier", "supplier_invoice_number")
    lines = _canonical_v2(spark, sf).join(ok, "message_id", "left_semi").join(meta, "message_id", "left")
    numbered = I.number_lines(lines)
    return numbered.withColumns(
        {"run_date": F.lit(rd), "run_id": F.lit(rid), "source_system": F.lit("ARIBA_EMAIL_EXPORT")}
    ).drop("row_idx")


def file_manifest_v1(spark, sf) -> DataFrame:
    cells = I.met_cells(_cells(spark, sf))
    return I.file_manifest_v1(_attachments(spark, sf), _emails(spark, sf).drop("html"), I.header_row_v1(cells), invoice_lines_v1(spark, sf))


def invoice_orphans(spark, sf) -> DataFrame:
    return I.orphans(_attachments(spark, sf), _emails(spark, sf).drop("html"))


# --- quality gates ----------------------------------------------------------------

RELEASE_CONTRACT = Q.Contract(
    name="release_distribution",
    required=("FLOC", "SCOPE_ID", "VENDOR"),
    any_of_regex=(r"removal", r"^scope package"),
    not_all_null=("FLOC", "SCOPE_ID", "SCOPE_REMOVAL_DATE", "EXTRA_COLUMN"),
)
# Fixed parameter of the domain check: the valid vendor list.
VALID_VENDORS = ("V0", "V1", "V2", "v3-legacy")


def contract_report(spark, sf) -> DataFrame:
    return Q.contract_report(role(spark, sf, "release_dist_raw"), RELEASE_CONTRACT)


def duplicate_keys_top10(spark, sf) -> DataFrame:
    return D.duplicate_keys(release_line_distribution(spark, sf), key="scope_floc_key", top=10)


def vendor_domain(spark, sf) -> DataFrame:
    return Q.domain_check(role(spark, sf, "deliveries_raw"), Q.vendor_list(spark, VALID_VENDORS))


def null_rates(spark, sf) -> DataFrame:
    return Q.null_rates(invoice_eligibility_line(spark, sf), ["object_type", "voltage", "assignment_status", "has_any_mdoc"])


def vendor_row_counts(spark, sf) -> DataFrame:
    return L.row_counts_by(deliveries_line(spark, sf), "vendor")


# --- ledgers and accumulating tables ---------------------------------------------


def keep_last_per_message(spark, sf) -> DataFrame:
    cur, new = role(spark, sf, "invoice_load_1"), role(spark, sf, "invoice_load_2")
    return L.keep_last(cur, new, ["message_id"], order="load_seq")


def ledger_upsert(spark, sf) -> DataFrame:
    return L.upsert(role(spark, sf, "file_ledger"), role(spark, sf, "file_ledger_updates"), ["file_hash"])


def not_yet_loaded(spark, sf) -> DataFrame:
    return L.not_yet_loaded(role(spark, sf, "incoming_files"), role(spark, sf, "file_ledger"))


def run_latest_state(spark, sf) -> DataFrame:
    return L.run_latest_state(role(spark, sf, "run_ledger"))


# --- schema helpers, preview and profile -------------------------------------------

SUPPLIER_SCHEMA = "supplier_id bigint, supplier_name string, nation_id int, account_balance double, region string"


def schema_conform(spark, sf) -> DataFrame:
    sup = spark.table(_register(spark, sf, "supplier"))
    renamed = sup.select(
        F.col("s_suppkey").alias(" supplier_id "),
        F.col("s_name").alias("supplier_name"),
        F.col("s_nationkey").alias("nation_id"),
        F.col("s_acctbal").alias("account_balance"),
        F.col("s_acctbal").alias("unused_extra"),
    )
    from pyspark.sql.types import _parse_datatype_string

    out, _missing, _extra = COL.conform(COL.strip_names(renamed), _parse_datatype_string(SUPPLIER_SCHEMA))
    return COL.with_lineage(out, run_date=RUNS["scope_master"][0], run_id=RUNS["scope_master"][1], source_file_saved="supplier.parquet")


def preview(spark, sf) -> DataFrame:
    from lakework.sources import readers as RD

    part = spark.table(_register(spark, sf, "part"))
    return RD.preview(part, ["p_partkey", "p_name", "p_retailprice"], n=200, order=["p_partkey"])


def profile(spark, sf) -> DataFrame:
    from lakework.sources import readers as RD

    return RD.profile(spark.table(_register(spark, sf, "part")))


# --- snapshots, vendor views, history, certified invoices -----------------------------

SNAPSHOTS = (("snap-2026-02-01", "2026-02-01 06:00:00", "v1"), ("snap-2026-02-02", "2026-02-02 06:00:00", "v2"))


_PUBLISHED: dict[tuple[str, str], str] = {}


def _published(spark, sf) -> str:
    """A lake with both snapshots published, once in a Spark application for each data folder.

    Both rule versions decide on the same evidence: it is gathered once, and each snapshot's lines are made from what was written.
    """
    from lakework.sources import commits
    from lakework.sources import snapshots as SN

    key = (spark.sparkContext.applicationId, sf)
    if key not in _PUBLISHED:
        root = scratch(spark, "snapshots")
        evidence, gathered = f"{root}/evidence", _eligibility_evidence(spark, sf)
        gathered.write.parquet(evidence)
        written = spark.read.schema(gathered.schema).parquet(evidence)
        for sid, ts, rv in SNAPSHOTS:
            SN.publish(_decided(written, rv), root, snapshot_id=sid, as_of_ts=ts, rule_version=rv)
        commits.remove(spark, evidence)  # published whole; nothing reads it again
        _PUBLISHED[key] = root
    return _PUBLISHED[key]


def eligibility_snapshot(spark, sf) -> DataFrame:
    from lakework.sources import snapshots as SN

    return SN.read(spark, _published(spark, sf))


def snapshot_as_of(spark, sf) -> DataFrame:
    """What was approved as of the first snapshot, after the second was published."""
    from lakework.sources import snapshots as SN

    return SN.read(spark, _published(spark, sf), as_of_ts="2026-02-01 23:59:59")


def snapshot_registry(spark, sf) -> DataFrame:
    from lakework.sources import snapshots as SN

    return SN.registry(spark, _published(spark, sf))


def snapshot_summary(spark, sf) -> DataFrame:
    from lakework.sources import snapshots as SN

    return SN.read(spark, _published(spark, sf), dataset=SN.SUMMARY)


def invoice_flags(spark, sf) -> DataFrame:
    return H.invoice_flags(role(spark, sf, "invoice_line_fact"))


def ledger_current(spark, sf) -> DataFrame:
    """The newest published snapshot, read from storage, with its invoice flags."""
    return H.ledger_with_flags(eligibility_snapshot(spark, sf), invoice_flags(spark, sf))


def approved_to_invoice(spark, sf) -> DataFrame:
    return H.approved_view(ledger_current(spark, sf))


def blocked_items(spark, sf) -> DataFrame:
    return H.blocked_view(ledger_current(spark, sf))


def invoiced_paid(spark, sf) -> DataFrame:
    return H.invoiced_paid_view(ledger_current(spark, sf))


def assignment_history(spark, sf) -> DataFrame:
    return H.assignment_history(role(spark, sf, "release_history"))


def assignment_conflicts(spark, sf) -> DataFrame:
    return H.assignment_conflicts(assignment_history(spark, sf))


def vendor_export(spark, sf) -> DataFrame:
    """The approved items as vendor files, exported twice by one run: HISTORY as its readers find it."""
    from lakework.sources import publish as PB

    root = scratch(spark, "export")
    approved = approved_to_invoice(spark, sf).select("vendor", "scope_floc_key", "snapshot_id", "invoice_count").persist()
    try:
        for _ in range(2):
            history, _current = PB.vendor_export(approved, root, "approved_to_invoice", run_date="2026-02-02", run_id="exp-0001")
    finally:
        approved.unpersist()
    columns = "scope_floc_key string, snapshot_id string, invoice_count string, vendor string, run_date string, run_id string"
    return spark.read.option("header", True).schema(columns).csv(history)


def certified_invoice_versions(spark, sf) -> DataFrame:
    return H.certified_versions(role(spark, sf, "invoice_versions"))


def certified_invoice_current(spark, sf) -> DataFrame:
    return H.certified_current(certified_invoice_versions(spark, sf))


def certified_invoice_lines(spark, sf) -> DataFrame:
    return H.certified_lines(role(spark, sf, "invoice_version_lines"), certified_invoice_current(spark, sf))


# --- publishing, CSV sources and the drop stream -----------------------------------
# These write to a fresh folder under the shared scratch location the cluster
# names in spark.checkpoint.dir, then read the result back.


def publish_roundtrip_current(spark, sf) -> DataFrame:
    from lakework.sources import publish as PB
    from lakework.sources import readers as RD

    root = scratch(spark, "current")
    line = release_line_distribution(spark, sf)
    PB.publish_vendor_partitioned(line.drop("run_date", "run_id"), root, "silver", "scope_release_distribution_line",
                                  run_date=RUNS["release_dist"][0], run_id=RUNS["release_dist"][1])
    cur = RD.read_current(spark, root, "silver", "scope_release_distribution_line")
    return cur.select(*[F.col(c) for c in line.columns])


def publish_roundtrip_history(spark, sf) -> DataFrame:
    from lakework.sources import publish as PB
    from lakework.sources import readers as RD

    root = scratch(spark, "history")
    line = release_line_distribution(spark, sf).drop("run_date", "run_id")
    for rd, rid in (("2026-01-10", "r1"), ("2026-01-12", "r2"), ("2026-01-15", "r3")):
        PB.publish_history(line, root, "silver", "release_line", run_date=rd, run_id=rid, partitions=["vendor"])
    schema = line.schema.add("run_date", "string").add("run_id", "string")
    hist = RD.read_history(spark, root, "silver", "release_line", schema=schema)
    return hist.groupBy("vendor", "run_date", "run_id").agg(F.count(F.lit(1)).alias("row_count"), F.count_if("is_active").alias("active_count"))


def previous_run_rows(spark, sf) -> DataFrame:
    from lakework.sources import publish as PB
    from lakework.sources import readers as RD

    root = scratch(spark, "previous")
    line = release_line_distribution(spark, sf).drop("run_date", "run_id")
    for rd, rid in (("2026-01-10", "r1"), ("2026-01-12", "r2"), ("2026-01-15", "r3")):
        PB.publish_history(line.withColumn("source_sheet", F.lit(rid)), root, "silver", "release_line", run_date=rd, run_id=rid, partitions=["vendor"])
    path = RD.dataset_path(root, "silver", "release_line", "HISTORY")
    return RD.read_previous_run(spark, path, line.schema, "r3", by_vendor=True)


def dynamic_overwrite(spark, sf) -> DataFrame:
    from lakework.sources import publish as PB
    from lakework.sources import readers as RD

    root = scratch(spark, "dynamic")
    line = release_line_distribution(spark, sf)
    PB.publish_current(line, root, "silver", "release_line", partitions=["vendor"])
    v0 = line.filter(F.col("vendor") == "V0").withColumn("source_sheet", F.lit("Distribution-v2"))
    PB.publish_current(v0, root, "silver", "release_line", partitions=["vendor"])
    return RD.read_current(spark, root, "silver", "release_line", schema=line.schema).select(*line.columns)


def csv_strings_roundtrip(spark, sf) -> DataFrame:
    from lakework.sources import readers as RD

    path = scratch(spark, "csv") + "/nation_csv"
    nation = spark.table(_register(spark, sf, "nation"))
    out = nation.select(
        "n_nationkey",
        F.when(F.col("n_regionkey") == 0, F.lit(None)).when(F.col("n_regionkey") == 1, F.lit("")).otherwise(F.col("n_name")).alias("n_name"),
        "n_regionkey",
    )
    out.write.option("header", True).csv(path)
    return RD.read_csv_strings(spark, path)


def csv_sniffed(spark, sf) -> DataFrame:
    from lakework.sources import readers as RD

    path = scratch(spark, "csvsemi") + "/nation_semi"
    nation = spark.table(_register(spark, sf, "nation"))
    nation.select(F.col("n_nationkey").alias("n_nationkey;"), F.col("n_name").alias("n_name;"), F.col("n_regionkey").alias("n_regionkey;")) \
        .write.option("header", True).option("sep", ";").csv(path)
    return RD.read_csv_sniffed(spark, path)


def csv_mixed_dialects(spark, sf) -> DataFrame:
    """A folder of files with different separators and columns, and fields with separators, quotes and line breaks."""
    from lakework.sources import readers as RD

    path = scratch(spark, "csvmixed") + "/drop"
    nation = spark.table(_register(spark, sf, "nation")).withColumn("note", F.concat(F.lit('a "q",; '), "n_name", F.lit("\n  second line")))
    for sep, has, columns in ((",", "n_regionkey < 2", ["n_nationkey", "n_name", "note"]), (";", "n_regionkey >= 2", ["n_name", "n_nationkey", "note", "n_regionkey"])):
        w = nation.filter(has).select(*columns).coalesce(1).write.mode("append").option("header", True).option("sep", sep).option("escape", '"')
        w.csv(path)
    return RD.read_csv_sniffed(spark, path)


def events_stream_latest(spark, sf) -> DataFrame:
    from lakework.streaming.drops import upsert_stream

    root = scratch(spark, "stream")
    schema = spark.table(_register(spark, sf, "events")).schema
    q = upsert_stream(
        spark, sf, schema, root=root, layer="silver", dataset="events_latest", keys=["user_id"],
        checkpoint=root + "/_checkpoint", order_col="ts", options={"pathGlobFilter": "events.parquet"}, buckets=64,
    )
    q.awaitTermination()
    from lakework.sources import readers as RD

    return RD.read_current(spark, root, "silver", "events_latest").select(*schema.names)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "invoice_eligibility_line": invoice_eligibility_line,
    "eligibility_v1": eligibility_v1,
    "eligibility_scope_summary": eligibility_scope_summary,
    "scope_assignment_current": scope_assignment_current,
    "latest_event": latest_event,
    "preferred_assignment": preferred_assignment,
    "release_line_distribution": release_line_distribution,
    "release_line_transmission": release_line_transmission,
    "helo_line": helo_line,
    "assignment_lines": assignment_lines,
    "events_history": events_history,
    "removal_events": removal_events,
    "move_events": move_events,
    "deliveries_line": deliveries_line,
    "deliveries_agg": deliveries_agg,
    "survey_line": survey_line_public,
    "survey_rollup": survey_rollup,
    "unmatched_deliveries": unmatched_deliveries,
    "unmatched_surveys": unmatched_surveys,
    "scope_list_line": scope_list_line,
    "scope_master_union": scope_master_public,
    "floc_attributes_dim": floc_attributes_dim,
    "floc_dim_ranked": floc_dim_ranked,
    "rate_card": rate_card,
    "unit_price": unit_price,
    "pricing_status_counts": pricing_status_counts,
    "snapshot_delta": snapshot_delta,
    "row_signature": row_signature,
    "release_load_header": release_load_header,
    "snapshot_delta_transmission": snapshot_delta_transmission,
    "canonical_keys": canonical_keys,
    "html_fields": html_fields,
    "html_lines": html_lines,
    "invoice_email_fields": invoice_email_fields,
    "grid_header_row": grid_header_row,
    "grid_header_row_v2": grid_header_row_v2,
    "grid_header_kv": grid_header_kv,
    "grid_header_kv_v2": grid_header_kv_v2,
    "grid_lines": grid_lines,
    "invoice_header": invoice_header,
    "invoice_lines_v1": invoice_lines_v1,
    "invoice_lines_v2": invoice_lines_v2,
    "file_manifest_status": file_manifest_status,
    "invoice_orphans": invoice_orphans,
    "file_manifest_v1": file_manifest_v1,
    "contract_report": contract_report,
    "duplicate_keys_top10": duplicate_keys_top10,
    "vendor_domain": vendor_domain,
    "null_rates": null_rates,
    "vendor_row_counts": vendor_row_counts,
    "keep_last_per_message": keep_last_per_message,
    "ledger_upsert": ledger_upsert,
    "not_yet_loaded": not_yet_loaded,
    "run_latest_state": run_latest_state,
    "schema_conform": schema_conform,
    "preview": preview,
    "profile": profile,
    "eligibility_snapshot": eligibility_snapshot,
    "snapshot_summary": snapshot_summary,
    "snapshot_registry": snapshot_registry,
    "snapshot_as_of": snapshot_as_of,
    "invoice_flags": invoice_flags,
    "ledger_current": ledger_current,
    "approved_to_invoice": approved_to_invoice,
    "blocked_items": blocked_items,
    "invoiced_paid": invoiced_paid,
    "vendor_export": vendor_export,
    "assignment_history": assignment_history,
    "assignment_conflicts": assignment_conflicts,
    "certified_invoice_versions": certified_invoice_versions,
    "certified_invoice_current": certified_invoice_current,
    "certified_invoice_lines": certified_invoice_lines,
    "publish_roundtrip_current": publish_roundtrip_current,
    "publish_roundtrip_history": publish_roundtrip_history,
    "previous_run_rows": previous_run_rows,
    "dynamic_overwrite": dynamic_overwrite,
    "csv_strings_roundtrip": csv_strings_roundtrip,
    "csv_sniffed": csv_sniffed,
    "csv_mixed_dialects": csv_mixed_dialects,
    "events_stream_latest": events_stream_latest,
}
QUERIES |= lake_queries(role, lambda spark, sf, table: spark.table(_register(spark, sf, table)), QUERIES)
