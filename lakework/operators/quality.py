
from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakework.functions.columns import q


@dataclass(frozen=True)
class Contract:
    """Q1/Q2: required columns (case-insensitive), regex groups of which one column must
    exist, and columns that must not be entirely null."""

    name: str
    required: tuple[str, ...] = ()
    any_of_regex: tuple[str, ...] = ()
    not_all_null: tuple[str, ...] = ()
    extra: dict = field(default_factory=dict)


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """Q1: one row per check with ``ok`` and a detail; the not-all-null checks share one aggregation."""
    spark = df.sparkSession
    lower = {c.lower(): c for c in df.columns}
    rows = []
    for r in contract.required:
        rows.append((contract.name, "required", r, r.lower() in lower, None))
    for pat in contract.any_of_regex:
        rx = re.compile(pat, re.IGNORECASE)
        hits = [c for c in df.columns if rx.search(c)]
        rows.append((contract.name, "any_of_regex", pat, bool(hits), ";".join(hits) or None))
    present = [lower[c.lower()] for c in contract.not_all_null if c.lower() in lower]
    names = "name string, check string, target string, ok boolean, detail string"
    static = spark.createDataFrame(rows, names) if rows else None
    checks = None
    if present:
        counts = df.agg(*[F.count(q(c)).alias(c) for c in present])
        stacked = counts.select(
            F.explode(F.array(*[F.struct(F.lit(c).alias("target"), F.col(f"`{c}`").alias("n")) for c in present])).alias("x")
        )
        checks = stacked.select(
            F.lit(contract.name).alias("name"),
            F.lit("not_all_null").alias("check"),
            F.col("x.target").alias("target"),
            (F.col("x.n") > 0).alias("ok"),
            F.concat(F.lit("non-null values: "), F.col("x.n").cast("string")).alias("detail"),
        )
    missing_nn = [c for c in contract.not_all_null if c.lower() not in lower]
    if missing_nn:
        extra = spark.createDataFrame([(contract.name, "not_all_null", c, False, "column missing") for c in missing_nn], names)
        static = extra if static is None else static.unionByName(extra)
    parts = [p for p in (static, checks) if p is not None]
    if not parts:
        return spark.createDataFrame([], names)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def domain_check(values: DataFrame, valid: DataFrame, col: str = "vendor") -> DataFrame:
    """Q5: distinct values outside the valid list, with "did you mean" hints sharing the first two letters."""
    seen = values.select(F.col(col).alias("value")).distinct()
    ok = valid.select(F.col(col).alias("value")).distinct()
    bad = seen.join(ok, "value", "left_anti")
    pref = lambda c: F.lower(F.substring(c, 1, 2))
    hints = ok.select(pref(F.col("value")).alias("p"), F.col("value").alias("hint"))
    out = bad.withColumn("p", pref(F.col("value"))).join(hints, "p", "left")
    return out.groupBy("value").agg(F.array_join(F.array_sort(F.collect_set("hint")), ";").alias("did_you_mean"))


def null_rates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q9: nulls per column in one aggregation, returned long (column, rows, nulls, rate)."""
    agg = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(q(c).isNull()).alias(c) for c in cols])
    x = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("nulls")) for c in cols]))
    return agg.select(F.col("__n").alias("rows"), x.alias("x")).select(
        F.col("x.column").alias("column"),
        F.col("rows"),
        F.col("x.nulls").alias("nulls"),
        F.when(F.col("rows") > 0, F.col("x.nulls") / F.col("rows")).otherwise(F.lit(0.0)).alias("null_rate"),
    )


def vendor_list(spark: SparkSession, vendors: Sequence[str]) -> DataFrame:
    """The valid vendor list as a one-column frame (a parameter, never data-sized)."""
    return spark.createDataFrame([(v,) for v in vendors], "vendor string")


# --- fixed values that must equal the reference's: contract sets per sheet (Q2) ---
SCOPE_PACKAGE_REGEX = r"^Scope Package\s*#\s*\d+\s*$"
RELEASE_CONTRACTS = {
    "Distribution": Contract("release_distribution", required=("FLOC", "SCOPE_ID"), not_all_null=("FLOC",)),
    "Transmission": Contract("release_transmission", required=("FLOC",), any_of_regex=(SCOPE_PACKAGE_REGEX,), not_all_null=("FLOC",)),
}
REMOVAL_CONTRACTS = {
    "Distribution": Contract("removal_distribution", required=("FLOC", "SCOPE_ID"), not_all_null=("FLOC",)),
    "Transmission": Contract("removal_transmission", required=("FLOC",), any_of_regex=(SCOPE_PACKAGE_REGEX,), not_all_null=("FLOC",)),
}
MOVE_TO_HELO_CONTRACTS = {
    "Distribution": Contract("move_distribution", required=("FLOC", "SCOPE_ID"), not_all_null=("FLOC", "SCOPE_ID")),
    "Transmission": Contract("move_transmission", required=("FLOC",), any_of_regex=(SCOPE_PACKAGE_REGEX,), not_all_null=("FLOC",)),
}
HELO_CONTRACTS = {
    "Distribution": Contract("helo_distribution", required=("FLOC", "SCOPE_ID"), not_all_null=("FLOC", "SCOPE_ID")),
    "Transmission": Contract("helo_transmission", required=("FLOC", "SCOPE_ID"), not_all_null=("FLOC", "SCOPE_ID")),
}
# -------------------------------------------------------------------------------------


def contracts_for(event_type: str) -> dict[str, Contract]:
    """Q2: the contract set of an event sheet type."""
    if event_type == "removal":
        return REMOVAL_CONTRACTS
    if event_type == "move_to_helo":
        return MOVE_TO_HELO_CONTRACTS
    raise ValueError(f"unknown event type {event_type!r}")


def require_contract(df: DataFrame, contract: Contract) -> None:
    """Q1 as a gate: raise with every failed check (one aggregation for the not-null checks)."""
    failed = contract_report(df, contract).filter(~F.col("ok")).collect()
    if failed:
        raise ValueError(f"contract {contract.name} failed: " + "; ".join(f"{r['check']} {r['target']}" for r in failed))
