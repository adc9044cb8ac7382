"""Invoice eligibility: distribution and transmission rules, unmatched evidence, scope summary.

keeps the older precedence and approval rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakework.functions.clean import clean, clean_column, false_if_null, reasons, safe_ratio
from lakework.functions.columns import col_or_default, keep_existing, rename_if_absent
from lakework.operators.assignment import CLASS_KEY, KEY
from lakework.operators.common import broadcast_if_small, top1

# --- fixed values that must equal the reference's -------------------------
PROGRAM_ACRONYM = {"DIST_DRONE": "D360", "DIST_COMP": "ODI", "DIST_HELO": "HELO", "DIST_OTHER": "DIST_OTHER"}
DIST_BLOCKERS = (
    "BLOCK_INACTIVE_ASSIGNMENT",
    "BLOCK_MISSING_GCP_MIN_IMAGES",
    "BLOCK_MISSING_AERIAL_MDOC",
    "BLOCK_MISSING_GROUND_MDOC",
    "BLOCK_EZ_POLE_DIST_NOT_BILLABLE",
)
DIST_BLOCKERS_V1 = DIST_BLOCKERS[:4]
NOT_BILLABLE_OBJECT_TYPE = "EZ_POLE"
TRANSMISSION_PROGRAM = "ATI"
# Object-type rank used to keep one attribute row per floc (higher wins).
OBJECT_TYPE_RANK = {"EZ_POLE": 4, "ET_TOWER": 3, "ET_POLE": 2, "ED_POLE": 1}
# Columns of the eligibility line.
LINE_COLS = (
    "asset_class",
    "program_bucket",
    "program_acronym",
    "billing_bucket",
    "is_work_complete",
    "is_billable",
    "vendor",
    "scope_id",
    "floc",
    "scope_floc_key",
    "object_type",
    "voltage",
    "assignment_method",
    "assignment_status",
    "is_active_assignment",
    "image_count_total",
    "folder_count",
    "has_aerial_mdoc",
    "has_ground_mdoc",
    "has_any_mdoc",
    "azure_join_method",
    "approved_to_invoice",
    "block_reasons",
    "needs_review",
    "eligibility_run_date",
    "eligibility_run_id",
    "eligibility_source_system",
)
# ---------------------------------------------------------------------------

V1_COLS = tuple(
    c
    for c in LINE_COLS
    if c not in ("program_acronym", "billing_bucket", "is_work_complete", "is_billable", "object_type", "voltage")
)


def standardize_floc_dim(dim: DataFrame) -> DataFrame:
    """One attribute row per floc, the highest ranked object type first.

    Ties on rank resolve by object type, then voltage, so the pick is total.
    """
    if "floc" not in dim.columns or "object_type" not in dim.columns:
        raise ValueError("floc attribute dimension needs floc and object_type")
    volt = F.nullif(clean("voltage"), F.lit("")) if "voltage" in dim.columns else F.lit(None).cast("string")
    df = dim.select(clean("floc").alias("floc"), clean("object_type").alias("object_type"), volt.alias("voltage"))
    rank = F.lit(0)
    for k, v in sorted(OBJECT_TYPE_RANK.items(), key=lambda kv: kv[1]):
        rank = F.when(F.col("object_type") == k, F.lit(v)).otherwise(rank)
    order = [rank.desc(), F.col("object_type").asc_nulls_last(), F.col("voltage").asc_nulls_last()]
    return top1(df, ["floc"], order)


def attach_floc_attributes(assignments: DataFrame, dim_std: DataFrame, broadcast_max_rows: int | None = None) -> DataFrame:
    """J-b: left join of the (one row per floc) attribute dimension.

    No hint by default: Spark broadcasts the dimension when its estimated size
    is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE converts the
    join at run time from the measured shuffle size; both are size checks.
    ``broadcast_max_rows`` adds an explicit hint behind a bounded row count.
    """
    d = dim_std if broadcast_max_rows is None else broadcast_if_small(dim_std, broadcast_max_rows)
    return assignments.join(d, "floc", "left")


def _join_deliveries(df: DataFrame, deliveries: DataFrame, rule_version: str, keys: Sequence[str] = KEY) -> DataFrame:
    """J-c: left join on (vendor, scope_floc_key); missing evidence reads as 0 / false (v1: no folder count).

    Plain equality keeps the join on the columns the assignment side is already
    hash-partitioned by (W2), so it adds no shuffle on that side.
    """
    d = deliveries.select(*keys, "image_count_total", "folder_count", "has_min_images", "has_gcp_delivery")
    out = df.join(d, list(keys), "left")
    return out.withColumns(
        {
            "image_count_total": F.coalesce(F.col("image_count_total"), F.lit(0)).cast("bigint"),
            "folder_count": (F.col("folder_count") if rule_version == "v1" else F.coalesce(F.col("folder_count"), F.lit(0))).cast("bigint"),
            "has_min_images": F.coalesce(F.col("has_min_images"), F.lit(False)),
            "has_gcp_delivery": F.coalesce(F.col("has_gcp_delivery"), F.lit(False)),
        }
    )


def _lineage(run_date: str, run_id: str, source_system: str) -> dict[str, Column]:
    return {
        "eligibility_run_date": F.lit(run_date),
        "eligibility_run_id": F.lit(run_id),
        "eligibility_source_system": F.lit(source_system),
    }


def _trim_keys(df: DataFrame) -> DataFrame:
    cols = [c for c in ("vendor", "scope_id", "floc", "scope_floc_key", "assignment_status", "assignment_method") if c in df.columns]
    return df.withColumns({c: clean(c) for c in cols})


def _with_defaults(df: DataFrame) -> DataFrame:
    """What an assignment need not carry."""
    defaults = {"object_type": None, "voltage": None, "assignment_status": ""}
    return df.withColumns({c: col_or_default(df, c, value, "string") for c, value in defaults.items()})


def distribution_eligibility(
    scope_current: DataFrame,
    deliveries: DataFrame,
    survey_floc: DataFrame,
    *,
    min_images: int,
    run_date: str,
    run_id: str,
    source_system: str,
    rule_version: str = "v2",
    trim_keys: bool = False,
    broadcast_max_rows: int | None = None,
    floc_dim: DataFrame | None = None,
) -> DataFrame:
    """D12 (v2) / D13 (v1): distribution eligibility line.

    Join order: deliveries on (vendor, scope_floc_key) first, on the hash
    partitioning the assignments already have; then the floc attribute
    dimension (``floc_dim``, J-b) and the survey evidence (J-d), both on floc,
    so that if neither is broadcast one shuffle by floc serves both.
    ``trim_keys`` re-trims the key columns as the reference does on arbitrary
    input; frames built by this library are already trimmed.
    """
    df = scope_current
    if trim_keys:
        df = _trim_keys(df)
    df = df.withColumn("asset_class", F.lit("distribution"))
    df = _join_deliveries(df, deliveries, rule_version)
    if floc_dim is not None:
        df = attach_floc_attributes(df, floc_dim, broadcast_max_rows)
    df = _with_defaults(df)
    z = survey_floc.select("floc", "has_any_mdoc", "has_aerial_mdoc", "has_ground_mdoc")
    if broadcast_max_rows is not None:  # otherwise Spark's own size checks decide (see J-b)
        z = broadcast_if_small(z, broadcast_max_rows)
    # J-d: floc only.  Where the line already has a flag, the line's column wins
    # and the survey's is kept as ``<name>_az``.
    clash = [c for c in ("has_any_mdoc", "has_aerial_mdoc", "has_ground_mdoc") if c in df.columns]
    if clash:
        z = z.withColumnsRenamed({c: f"{c}_az" for c in clash})
    df = df.join(z, "floc", "left")
    df = df.withColumns({c: false_if_null(c) for c in MDOC_FLAGS})
    df = df.withColumn("azure_join_method", F.lit("FLOC_ONLY"))

    return _rules(df, rule_version, min_images, _lineage(run_date, run_id, source_system))


MDOC_FLAGS = ("has_any_mdoc", "has_aerial_mdoc", "has_ground_mdoc")


def _rules(df: DataFrame, rule_version: str, min_images: int, lineage: dict[str, Column]) -> DataFrame:
    """The decisions of both asset classes on rows with their evidence: program, blockers, approval.

    Distribution: what is required depends on the program, v2 does not bill EZ poles, v1 lets DRONE win over COMP.
    Transmission: images only; program and bucket ATI (v2).
    """
    trans = F.col("asset_class") == "transmission"
    status, scope = F.col("assignment_status"), F.col("scope_id")
    by_status = F.when(status == "ACTIVE_DRONE", F.lit("DIST_DRONE")).when(status == "ACTIVE_HELO", F.lit("DIST_HELO"))
    comp, other = F.when(scope == "COMP", F.lit("DIST_COMP")), F.lit("DIST_OTHER")
    # v2: COMP overrides everything; v1: the status wins.
    bucket = F.coalesce(comp, by_status, other) if rule_version == "v2" else F.coalesce(by_status, comp, other)
    pb = F.col("program_bucket")
    df = df.withColumn("program_bucket", F.when(trans, F.lit("TRANS")).otherwise(bucket))
    active = F.coalesce(F.col("is_active_assignment").cast("boolean"), F.lit(False)) if "is_active_assignment" in df.columns else F.lit(True)
    flag = lambda c: false_if_null(col_or_default(df, c, False, "boolean"))
    few_images = pb.isin("DIST_DRONE", "DIST_HELO", "TRANS") & (F.col("image_count_total") < min_images)
    no_aerial = (pb == "DIST_DRONE") & ~flag("has_aerial_mdoc")
    no_ground = pb.isin("DIST_DRONE", "DIST_COMP") & ~flag("has_ground_mdoc")
    meets = ~few_images & ~no_aerial & ~no_ground
    ez = ~trans & (F.coalesce(clean("object_type"), F.lit("")) == NOT_BILLABLE_OBJECT_TYPE)
    df = df.withColumns(
        {
            "is_active_assignment": active,
            "BLOCK_INACTIVE_ASSIGNMENT": ~active,
            "BLOCK_MISSING_GCP_MIN_IMAGES": few_images,
            "BLOCK_MISSING_AERIAL_MDOC": no_aerial,
            "BLOCK_MISSING_GROUND_MDOC": no_ground,
            "BLOCK_EZ_POLE_DIST_NOT_BILLABLE": ez,
            "is_work_complete": meets,
        }
    )
    if rule_version == "v2":
        names = F.create_map(*[F.lit(x) for kv in (PROGRAM_ACRONYM | {"TRANS": TRANSMISSION_PROGRAM}).items() for x in kv])
        acronym = F.element_at(names, pb)
        df = df.withColumns(
            {
                "program_acronym": acronym,
                "billing_bucket": F.when(ez, F.lit("NON_BILLABLE")).otherwise(acronym),
                "is_billable": ~ez & active & (acronym != "DIST_OTHER"),
            }
        )
        df = df.withColumn("approved_to_invoice", F.col("is_work_complete") & F.col("is_billable"))
    else:
        df = df.withColumn("approved_to_invoice", active & meets)
    df = df.withColumns(
        {
            "block_reasons": reasons(DIST_BLOCKERS if rule_version == "v2" else DIST_BLOCKERS_V1),
            "needs_review": ~F.col("approved_to_invoice"),
            **lineage,
        }
    )
    return keep_existing(df, LINE_COLS if rule_version == "v2" else V1_COLS)


def eligibility_lines(
    current: DataFrame,
    deliveries: DataFrame,
    survey_floc: DataFrame,
    *,
    floc_dim: DataFrame,
    min_images: int,
    run_date: str,
    run_id: str,
    source_system: str,
    rule_version: str = "v2",
) -> DataFrame:
    """D12, D13 and D14 for both asset classes at once: ``current`` and ``deliveries`` carry their asset class, spelt alike."""
    evidence = eligibility_evidence(current, deliveries, survey_floc, floc_dim=floc_dim)
    return decided_lines(evidence, min_images=min_images, run_date=run_date, run_id=run_id, source_system=source_system, rule_version=rule_version)


def eligibility_evidence(current: DataFrame, deliveries: DataFrame, survey_floc: DataFrame, *, floc_dim: DataFrame) -> DataFrame:
    """The assignments of both classes with their deliveries, attributes and surveys: all that a rule version decides on.

    The deliveries join finds the assignments where W2 put them; the two joins on floc share one shuffle.  Survey evidence
    counts for distribution only, so transmission lines have none of its columns.
    """
    df = _join_deliveries(current, deliveries, "v1", CLASS_KEY).withColumn("asset_class", F.lower("asset_class"))
    df = df.join(floc_dim, "floc", "left").join(survey_floc.select("floc", *MDOC_FLAGS), "floc", "left")
    trans = F.col("asset_class") == "transmission"
    flags = {c: F.when(~trans, F.coalesce(F.col(c), F.lit(False))) for c in MDOC_FLAGS}
    df = df.withColumns(flags | {"azure_join_method": F.when(~trans, F.lit("FLOC_ONLY"))})
    return keep_existing(df, LINE_COLS)


def decided_lines(evidence: DataFrame, *, min_images: int, run_date: str, run_id: str, source_system: str, rule_version: str = "v2") -> DataFrame:
    """The lines that a rule version makes of ``eligibility_evidence``; v1 leaves a missing folder count null."""
    if rule_version != "v1":
        evidence = evidence.withColumn("folder_count", F.coalesce(F.col("folder_count"), F.lit(0)).cast("bigint"))
    return _rules(evidence, rule_version, min_images, _lineage(run_date, run_id, source_system))


def transmission_eligibility(
    scope_current: DataFrame,
    deliveries: DataFrame,
    *,
    min_images: int,
    run_date: str,
    run_id: str,
    source_system: str,
    rule_version: str = "v2",
    trim_keys: bool = False,
    floc_dim: DataFrame | None = None,
    broadcast_max_rows: int | None = None,
) -> DataFrame:
    """Transmission eligibility: images only; program and bucket ATI (v2).

    Deliveries join first (existing partitioning), then the floc dimension.
    """
    df = scope_current
    if trim_keys:
        df = _trim_keys(df)
    df = df.withColumn("asset_class", F.lit("transmission"))
    df = _join_deliveries(df, deliveries, rule_version)
    if floc_dim is not None:
        df = attach_floc_attributes(df, floc_dim, broadcast_max_rows)
    return _rules(_with_defaults(df), rule_version, min_images, _lineage(run_date, run_id, source_system))


def unmatched_deliveries(
    assignments: DataFrame, deliveries: DataFrame, *, run_date: str, run_id: str, source_system: str, asset_class: str | None = None
) -> DataFrame:
    """D15 / J-g: delivery aggregates whose (vendor, scope_floc_key) has no assignment.

    Without ``asset_class`` both sides carry their own, spelt alike, and it is part of the key.
    """
    own = [] if asset_class else ["asset_class"]
    keys = assignments.select(*own, *[clean_column(c).alias(c) for c in KEY])
    d = deliveries.withColumns({c: clean_column(c) for c in ("vendor", "scope_floc_key", "scope_id_any", "floc_any") if c in deliveries.columns})
    out = d.join(keys, list(KEY if asset_class else CLASS_KEY), "left_anti")
    out = rename_if_absent(out, {"floc_any": "floc", "scope_id_any": "scope_id"})
    out = out.withColumns(
        {
            "asset_class": F.lit(asset_class) if asset_class else F.lower("asset_class"),
            "unmatched_reason": F.lit("VENDOR_SCOPE_KEY_NOT_IN_ASSIGNMENTS"),
            **_lineage(run_date, run_id, source_system),
        }
    )
    preferred = [
        "asset_class", "vendor", "scope_id", "floc", "scope_floc_key", "image_count_total", "folder_count",
        "has_gcp_delivery", "has_min_images", "unmatched_reason",
        "eligibility_run_date", "eligibility_run_id", "eligibility_source_system",
    ]
    return keep_existing(out, preferred, rest=True)


def unmatched_surveys(
    assignments_dist: DataFrame, survey_floc: DataFrame, *, run_date: str, run_id: str, source_system: str
) -> DataFrame:
    """D15 / J-h: survey flocs with no distribution assignment."""
    flocs = assignments_dist.select(clean_column("floc").alias("floc"))
    out = survey_floc.withColumn("floc", clean_column("floc")).join(flocs, "floc", "left_anti")
    out = out.withColumns(
        {
            "asset_class": F.lit("distribution"),
            "unmatched_reason": F.lit("FLOC_NOT_IN_DISTRIBUTION_ASSIGNMENTS"),
            **_lineage(run_date, run_id, source_system),
        }
    )
    preferred = [
        "asset_class", "floc", "has_any_mdoc", "has_ground_mdoc", "has_aerial_mdoc",
        "ground_measurement_documents", "aerial_measurement_documents", "created_at_max", "row_count",
        "object_type_count", "unmatched_reason", "eligibility_run_date", "eligibility_run_id",
        "eligibility_source_system",
    ]
    return keep_existing(out, preferred, rest=True)


def scope_summary(line: DataFrame, *, run_date: str, run_id: str, source_system: str) -> DataFrame:
    """A5: per (asset_class, vendor, scope_id): keys, approved, blocked and the approval rate."""
    df = line.withColumns({c: clean_column(c) for c in ("vendor", "scope_id", "asset_class")})
    approved = F.col("approved_to_invoice") if "approved_to_invoice" in line.columns else F.lit(False)
    out = df.groupBy("asset_class", "vendor", "scope_id").agg(
        F.count("scope_floc_key").alias("floc_count"),
        F.count_if(F.coalesce(approved, F.lit(False))).alias("approved_count"),
    )
    return out.withColumns(
        {
            "blocked_count": F.col("floc_count") - F.col("approved_count"),
            "approved_rate": safe_ratio("approved_count", "floc_count"),
            **_lineage(run_date, run_id, source_system),
        }
    )
