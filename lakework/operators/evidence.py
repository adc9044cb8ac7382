"""Evidence feeds: image deliveries and surveys.

"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.functions.clean import (
    business_key,
    SURVEY_FORMATS,
    clean,
    clean_column,
    folder_parts,
    literal_nulls,
    null_tokens,
    parsed_timestamp,
    to_bool_true_false,
    to_date_mdy_dash,
    to_int_truncating,
)
from lakework.functions.columns import col_or_default, q, rename_if_absent, strip_export_prefix
from lakework.operators.common import joined_unique, top1

# Fixed value: the image threshold default of the eligibility job.
DEFAULT_MIN_IMAGES = 8

DELIVERY_SOURCE_COLS = ("DateUploaded", "flight_date", "vendor", "structureId", "folder", "imageCount")
SURVEY_SOURCE_COLS = (
    "flocNumber",
    "createdAt",
    "aerialInspectionKind",
    "aerialMeasurementDocument",
    "inspectionKind",
    "measurementDocument",
    "inspectionStatus",
    "objectType",
    "workOrderNumber",
)

DELIVERY_LINE_COLS = (
    "asset_class",
    "vendor",
    "floc",
    "scope_id",
    "block_id",
    "scope_floc_key",
    "date_uploaded",
    "flight_date",
    "folder_date",
    "folder",
    "image_count",
    "has_deliveries_evidence",
    "source_system",
    "run_date",
    "run_id",
    "source_file_saved",
)


DELIVERY_LINE_SCHEMA = T.StructType(
    [
        T.StructField("asset_class", T.StringType()),
        T.StructField("vendor", T.StringType()),
        T.StructField("floc", T.StringType()),
        T.StructField("scope_id", T.StringType()),
        T.StructField("block_id", T.StringType()),
        T.StructField("scope_floc_key", T.StringType()),
        T.StructField("date_uploaded", T.DateType()),
        T.StructField("flight_date", T.DateType()),
        T.StructField("folder_date", T.DateType()),
        T.StructField("folder", T.StringType()),
        T.StructField("image_count", T.LongType()),
        T.StructField("has_deliveries_evidence", T.BooleanType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("run_date", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("source_file_saved", T.StringType()),
    ]
)


def require_columns(df: DataFrame, required) -> None:
    """Q3: exact-case required columns."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}; found {df.columns}")


def deliveries_line(
    raw: DataFrame,
    *,
    asset_class: str | None = None,
    run_date: str,
    run_id: str,
    source_system: str,
    source_file_saved: str = "",
    position: Column | None = None,
) -> DataFrame:
    """D10 + W3: delivery evidence line, latest upload per (vendor, floc, folder); without ``asset_class`` the rows carry
    their own, and it is part of the key.

    ``raw`` is the all-string CSV (blanks kept as ``""``).  ``position`` is the
    row's place in the source, used as the last tie-break (the reference's
    stable sort); without it the remaining columns break ties.
    """
    if asset_class is not None:
        asset_class = asset_class.lower().strip()
        if asset_class not in ("distribution", "transmission"):
            raise ValueError(f"asset_class must be distribution or transmission, got {asset_class!r}")
    require_columns(raw, DELIVERY_SOURCE_COLS if asset_class else (*DELIVERY_SOURCE_COLS, "asset_class"))
    floc = q("structureId").cast("string")
    folder = q("folder").cast("string")
    parts = folder_parts(folder, q("vendor"))
    image_count = to_int_truncating(q("imageCount"))
    pos = position if position is not None else F.lit(0)
    line = raw.select(
        (F.lit(asset_class) if asset_class else F.lower(clean("asset_class"))).alias("asset_class"),
        q("vendor").cast("string").alias("vendor"),
        floc.alias("floc"),
        parts["scope_id"].alias("scope_id"),
        parts["block_id"].alias("block_id"),
        business_key(parts["scope_id"], floc).alias("scope_floc_key"),
        to_date_mdy_dash(q("DateUploaded")).alias("date_uploaded"),
        to_date_mdy_dash(q("flight_date")).alias("flight_date"),
        parts["folder_date"].alias("folder_date"),
        folder.alias("folder"),
        image_count.alias("image_count"),
        (image_count > 0).alias("has_deliveries_evidence"),
        F.lit(source_system).alias("source_system"),
        F.lit(run_date).alias("run_date"),
        F.lit(run_id).alias("run_id"),
        F.lit(source_file_saved).alias("source_file_saved"),
        pos.alias("__pos"),
    )
    order = [
        F.col("date_uploaded").desc_nulls_last(),
        F.col("flight_date").desc_nulls_last(),
        F.col("run_date").desc_nulls_last(),
        F.col("run_id").desc_nulls_last(),
        F.col("__pos").asc(),
        F.col("image_count").desc(),
        F.col("scope_id").asc_nulls_last(),
    ]
    # The key that differs most comes first: the sorts seldom look at the others.
    return top1(line, ["folder", "floc", "vendor", *([] if asset_class else ["asset_class"])], order).drop("__pos")


def deliveries_agg(line: DataFrame, *, min_images: int = DEFAULT_MIN_IMAGES, by_class: bool = False) -> DataFrame:
    """A1: per (vendor, scope_floc_key), with ``by_class`` per asset class too: floc and scope, distinct folders, total
    images, thresholds.

    One hash aggregation with partial (map-side) aggregation.  The key embeds
    floc and scope, so ``min`` returns the group's single value for them.
    """
    df = rename_if_absent(line, {"imageCount": "image_count", "structureId": "floc"})
    dtype = dict(df.dtypes).get("image_count", "int")
    df = df.withColumn("image_count", col_or_default(df, "image_count", 0, dtype))
    # A whole number needs no way through text.
    whole = dtype in ("tinyint", "smallint", "int", "bigint")
    images = F.coalesce(F.col("image_count").cast("double").try_cast("bigint"), F.lit(0).cast("bigint")) if whole else to_int_truncating(F.col("image_count"))
    total = F.sum(images).cast("bigint")
    own = {"vendor": "__vendor", "scope_floc_key": "__key"}
    df = df.withColumns({own.get(c, c): clean_column(c) for c in ("vendor", "scope_floc_key", "floc", "scope_id", "folder")})
    out = df.groupBy(*(["asset_class"] if by_class else []), *own.values()).agg(
        F.min("floc").alias("floc_any"),
        F.min("scope_id").alias("scope_id_any"),
        F.count_distinct("folder").alias("folder_count"),
        total.alias("image_count_total"),
    ).withColumnsRenamed({name: c for c, name in own.items()})
    t = F.coalesce(F.col("image_count_total"), F.lit(0))
    return out.withColumns({"has_gcp_delivery": t > 0, "has_min_images": t >= F.lit(int(min_images))})


def survey_line(
    raw: DataFrame,
    *,
    run_date: str,
    run_id: str,
    source_system: str,
    source_file_saved: str = "",
    position: Column | None = None,
) -> DataFrame:
    """Survey line: null tokens cleaned, timestamps parsed, optional sync flags, mdoc flags.

    Rows without a floc are dropped.  ``position`` (kept as ``src_pos``) orders
    first appearances for the floc rollup.
    """
    df = strip_export_prefix(raw)
    require_columns(df, SURVEY_SOURCE_COLS)
    # Texts are cleaned, emptied and parsed in projections that follow each other: each step names a text several times.
    optional = {
        "readyToSync": ("ready_to_sync", True),
        "syncedToSAP": ("synced_to_sap", True),
        "shouldSyncToSAP": ("should_sync_to_sap", True),
        "syncStatus": ("sync_status", False),
    }
    texts = [*SURVEY_SOURCE_COLS, *[c for c in optional if c in df.columns]]
    df = df.withColumns({c: clean_column(c) for c in texts})
    df = df.withColumns({c: null_tokens(q(c), cleaned=True) for c in texts})
    df = df.withColumn("__created", literal_nulls("createdAt", cleaned=True))
    nt = q
    cols = [
        F.lit("distribution").alias("asset_class"),
        nt("flocNumber").alias("floc"),
        parsed_timestamp("__created", SURVEY_FORMATS).alias("created_at"),
        nt("aerialInspectionKind").alias("aerial_inspection_kind"),
        nt("aerialMeasurementDocument").alias("aerial_measurement_document"),
        nt("inspectionKind").alias("ground_inspection_kind"),
        nt("measurementDocument").alias("ground_measurement_document"),
        nt("inspectionStatus").alias("inspection_status"),
        nt("objectType").alias("object_type"),
        nt("workOrderNumber").alias("work_order_number"),
    ]
    for src, (name, is_bool) in optional.items():
        if src in df.columns:
            cols.append((to_bool_true_false(q(src)) if is_bool else nt(src)).alias(name))
    ground = nt("measurementDocument").isNotNull()
    aerial = nt("aerialMeasurementDocument").isNotNull()
    cols += [
        ground.alias("has_ground_mdoc"),
        aerial.alias("has_aerial_mdoc"),
        (ground | aerial).alias("has_any_mdoc"),
        F.lit(source_system).alias("source_system"),
        F.lit(run_date).alias("run_date"),
        F.lit(run_id).alias("run_id"),
        F.lit(source_file_saved).alias("source_file_saved"),
        (position if position is not None else F.lit(0)).alias("src_pos"),
    ]
    return df.select(*cols).filter(F.col("floc").isNotNull())


SURVEY_JOINED = {
    "object_types": "object_type",
    "inspection_statuses": "inspection_status",
    "aerial_inspection_kinds": "aerial_inspection_kind",
    "ground_inspection_kinds": "ground_inspection_kind",
    "aerial_measurement_documents": "aerial_measurement_document",
    "ground_measurement_documents": "ground_measurement_document",
    "work_order_numbers": "work_order_number",
}


def survey_rollup(line: DataFrame, *, run_date: str, run_id: str) -> DataFrame:
    """A2 + A3: one row per (asset_class, floc).

    Min/max time, distinct object types, row count, three "any" flags, and seven
    joined-unique strings in first-appearance order, all in one pass (see ``joined_unique``).
    """
    line = line.withColumns({src: clean_column(src) for src in SURVEY_JOINED.values()})
    values = {out: null_tokens(F.col(src), cleaned=True) for out, src in SURVEY_JOINED.items()}
    stats = {
        "created_at_min": ("min", F.col("created_at")),
        "created_at_max": ("max", F.col("created_at")),
        "row_count": ("count", F.lit(1)),
        "has_any_mdoc": ("max", F.col("has_any_mdoc")),
        "has_ground_mdoc": ("max", F.col("has_ground_mdoc")),
        "has_aerial_mdoc": ("max", F.col("has_aerial_mdoc")),
    }
    out = joined_unique(line, ["asset_class", "floc"], values, F.col("src_pos"), stats=stats, counts={"object_type_count": "object_types"})
    return out.withColumns({"run_date": F.lit(run_date), "run_id": F.lit(run_id)})


def standardize_survey_floc(rollup: DataFrame) -> DataFrame:
    """The survey rollup reduced to the evidence columns, one row per floc, flags false when null."""
    df = rollup.withColumn("floc", clean_column("floc"))
    flags = {c: F.coalesce(F.col(c).cast("boolean"), F.lit(False)) if c in df.columns else F.lit(False)
             for c in ("has_any_mdoc", "has_aerial_mdoc", "has_ground_mdoc")}
    df = df.withColumns(flags)
    optional = [
        c
        for c in (
            "aerial_measurement_documents",
            "ground_measurement_documents",
            "created_at_max",
            "created_at_min",
            "row_count",
            "object_type_count",
        )
        if c in df.columns
    ]
    keep = ["floc", "has_any_mdoc", "has_aerial_mdoc", "has_ground_mdoc", *optional]
    # The rollup is already one row per floc; other inputs give the first row of a total order.
    return top1(df.select(*keep), ["floc"], [F.col(c).desc_nulls_last() for c in keep if c != "floc"])
