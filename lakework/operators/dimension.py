
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakework.functions.clean import blank_to_null, clean, first_of_list, pick_priority
from lakework.functions.columns import find_col, q
from lakework.operators.common import joined_unique

# --- fixed values that must equal the reference's -------------------------
# Column spellings of the official lists, matched with whitespace removed.
FLOC_NAMES = ("FLOC", "Floc", "FLOC_ID", "FLOCID")
OBJECT_TYPE_NAMES = ("Eq_OjType", "Eq_ObjType", "EqObjType", "Eq_Oj_Type", "EqOjType", "EqType")
VOLTAGE_NAMES = ("Voltage", "VOLTAGE", "Volt", "kV", "KV")
# ---------------------------------------------------------------------------


def scope_list_line(
    raw: DataFrame,
    *,
    asset_class: str,
    scope_list: str,
    run_date: str,
    run_id: str,
    source_system: str,
    source_file_saved: str = "",
    position: Column | None = None,
) -> DataFrame:
    """One official list conformed to (floc, object_type, voltage, ...); blank flocs dropped.

    ``src_pos`` carries the row's place in its list for first-appearance order.
    """
    floc_c = find_col(raw.columns, FLOC_NAMES, mode="nospace")
    obj_c = find_col(raw.columns, OBJECT_TYPE_NAMES, mode="nospace")
    volt_c = find_col(raw.columns, VOLTAGE_NAMES, mode="nospace")
    if floc_c is None:
        raise ValueError(f"could not find FLOC column in {raw.columns}")
    if obj_c is None:
        raise ValueError(f"could not find Eq_OjType column in {raw.columns}")
    out = raw.select(
        clean(q(floc_c)).alias("floc"),
        clean(q(obj_c)).alias("object_type"),
        (blank_to_null(q(volt_c)) if volt_c else F.lit(None).cast("string")).alias("voltage"),
        F.lit(asset_class).alias("asset_class"),
        F.lit(scope_list).alias("scope_list"),
        F.lit(source_system).alias("source_system"),
        F.lit(source_file_saved).alias("source_file_saved"),
        F.lit(run_date).alias("run_date"),
        F.lit(run_id).alias("run_id"),
        (position if position is not None else F.lit(0)).alias("src_pos"),
    )
    return out.filter(F.col("floc").isNotNull() & (F.col("floc") != ""))


def scope_master_union(lines: list[DataFrame]) -> DataFrame:
    """O1 over the lists, keeping list order in the position (list index, row position)."""
    out = None
    for i, df in enumerate(lines):
        tagged = df.withColumn("src_pos", F.struct(F.lit(i).alias("list_idx"), F.col("src_pos").alias("row_pos")))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no scope lists given")
    return out


def floc_attributes_dim(master: DataFrame) -> DataFrame:
    """A4: one row per floc: joined-unique values, row count, priority object type, first voltage."""
    values = {
        "object_type_values": blank_to_null("object_type"),
        "voltage_values": blank_to_null("voltage") if "voltage" in master.columns else F.lit(None).cast("string"),
        "scope_lists": blank_to_null("scope_list"),
        "asset_classes": blank_to_null("asset_class"),
    }
    df = master.withColumn("floc", clean("floc"))
    out = joined_unique(df, ["floc"], values, F.col("src_pos"), stats={"row_count": ("count", F.lit(1))})
    return out.select(
        "floc",
        pick_priority("object_type_values").alias("object_type"),
        first_of_list("voltage_values").alias("voltage"),
        "object_type_values",
        "voltage_values",
        "scope_lists",
        "asset_classes",
        "row_count",
    )


def scope_lists(raw: DataFrame, lists: Sequence[tuple[Column, dict[str, Column]]], *, run_date: str, run_id: str, source_system: str) -> DataFrame:
    """D16 and O1 over one table that several lists are views of, in one pass.

    ``lists``: for each list, which rows it has and its columns (floc, object_type, voltage, asset_class, scope_list,
    source_file_saved, position).  The result is what ``scope_master_union`` makes of the single lists.
    """
    entries = [
        F.when(
            has,
            F.struct(
                clean(c["floc"]).alias("floc"),
                clean(c["object_type"]).alias("object_type"),
                blank_to_null(c["voltage"]).alias("voltage"),
                c["asset_class"].alias("asset_class"),
                c["scope_list"].alias("scope_list"),
                F.lit(source_system).alias("source_system"),
                c["source_file_saved"].alias("source_file_saved"),
                F.lit(run_date).alias("run_date"),
                F.lit(run_id).alias("run_id"),
                F.struct(F.lit(k).alias("list_idx"), c["position"].alias("row_pos")).alias("src_pos"),
            ),
        )
        for k, (has, c) in enumerate(lists)
    ]
    lines = raw.select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))
    return lines.filter(F.col("floc").isNotNull() & (F.col("floc") != ""))
