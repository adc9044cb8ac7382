"""

These are specified in the reference's design documents, not in its code;
each is a small composition of joins, aggregations and windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakework.operators.common import top1


ASSIGNMENT = ("vendor", "floc", "scope_id")


def assignment_history(releases: DataFrame, *, vendor: str = "vendor", floc: str = "floc", scope: str = "scope_id", ts: str = "effective_ts") -> DataFrame:
    """Effective-dated assignments: one row per (vendor, floc, scope) and unbroken run of releases that list it.

    A release is the full list of a vendor's assignments at a time.  An assignment takes effect with the first release that
    lists it and ends with the next release of the same vendor that does not; the last release leaves it open.  A floc may be
    listed in several packages at once: each is an assignment of its own (see ``assignment_conflicts``).

    Rows are reduced to one per (assignment, release) before the shuffle, so the windows run over releases, not rows.
    """
    listed = releases.select(F.col(vendor).alias("vendor"), F.col(floc).alias("floc"), F.col(scope).alias("scope_id"), F.col(ts).alias("ts")).distinct()
    # The releases of each vendor, numbered, each with the next one's time.
    by_vendor = Window.partitionBy("vendor").orderBy("ts")
    calendar = releases.select(F.col(vendor).alias("v"), F.col(ts).alias("t")).distinct()
    calendar = calendar.withColumnsRenamed({"v": "vendor", "t": "ts"}).select("*", F.row_number().over(by_vendor).alias("no"), F.lead("ts").over(by_vendor).alias("next_ts"))
    calendar = calendar.withColumnsRenamed({"vendor": "v", "ts": "t"})
    rows = listed.join(calendar, F.col("vendor").eqNullSafe(F.col("v")) & F.col("ts").eqNullSafe(F.col("t"))).drop("v", "t")
    # In an unbroken run, release numbers and row numbers grow alike.
    run = F.col("no") - F.row_number().over(Window.partitionBy(*ASSIGNMENT).orderBy("no"))
    spans = rows.withColumn("run", run).groupBy(*ASSIGNMENT, "run").agg(
        F.min("ts").alias("effective_start_ts"), F.max_by("next_ts", "no").alias("effective_end_ts"), F.count(F.lit(1)).alias("release_count")
    )
    return spans.drop("run").withColumn("is_current", F.col("effective_end_ts").isNull())


def assignment_conflicts(history: DataFrame) -> DataFrame:
    """The times at which a floc is assigned more than once: floc, begin and end (null: open), how many, and which.

    Starts and ends of a floc's intervals are its event points; a running sum over them gives the number of assignments
    in effect until the next point.
    """
    held = history.select("floc", "vendor", "scope_id", "effective_start_ts", "effective_end_ts")
    points = held.select("floc", F.col("effective_start_ts").alias("at"), F.lit(1).alias("d")).unionAll(
        held.filter("effective_end_ts IS NOT NULL").select("floc", F.col("effective_end_ts").alias("at"), F.lit(-1).alias("d"))
    )
    steps = points.groupBy("floc", "at").agg(F.sum("d").alias("d"))
    order = Window.partitionBy("floc").orderBy("at")
    spans = steps.select(
        F.col("floc").alias("f"), F.col("at").alias("conflict_start_ts"), F.lead("at").over(order).alias("conflict_end_ts"), F.sum("d").over(order).alias("n_assignments")
    ).filter("n_assignments > 1")
    inside = (F.col("effective_start_ts") <= F.col("conflict_start_ts")) & (F.coalesce(F.col("effective_end_ts") > F.col("conflict_start_ts"), F.lit(True)))
    name = F.concat_ws("/", F.coalesce("vendor", F.lit("")), F.coalesce("scope_id", F.lit("")))
    found = spans.join(held, F.col("f").eqNullSafe(F.col("floc")) & inside)
    return found.groupBy("floc", "conflict_start_ts", "conflict_end_ts", "n_assignments").agg(F.array_join(F.array_sort(F.collect_set(name)), ";").alias("assignments"))


def eligibility_snapshot(line: DataFrame, *, snapshot_id: str, as_of_ts: str, rule_version: str) -> DataFrame:
    """The eligibility line stamped as an immutable snapshot."""
    return line.withColumns(
        {
            "snapshot_id": F.lit(snapshot_id),
            "as_of_ts": F.lit(as_of_ts).cast("timestamp_ntz"),
            "rule_version": F.lit(rule_version),
        }
    )


def snapshot_summary(snap_line: DataFrame) -> DataFrame:
    """Scope summary per snapshot (A5 plus the snapshot keys)."""
    approved = F.coalesce(F.col("approved_to_invoice"), F.lit(False))
    out = snap_line.groupBy("snapshot_id", "as_of_ts", "rule_version", "asset_class", "vendor", "scope_id").agg(
        F.count("scope_floc_key").alias("floc_count"),
        F.count_if(approved).alias("approved_count"),
    )
    return out.withColumns(
        {
            "blocked_count": F.col("floc_count") - F.col("approved_count"),
            "approved_rate": F.when(F.col("floc_count") > 0, F.col("approved_count") / F.col("floc_count")).otherwise(F.lit(0.0)),
        }
    )


def invoice_flags(invoice_lines: DataFrame, keys=("vendor", "scope_floc_key")) -> DataFrame:
    """Invoiced / paid flags per key from the invoice line fact (any line counts)."""
    paid = F.coalesce(F.col("paid_flg").cast("boolean"), F.lit(False)) if "paid_flg" in invoice_lines.columns else F.lit(False)
    return invoice_lines.groupBy(*keys).agg(
        F.lit(True).alias("invoiced_flg"),
        F.bool_or(paid).alias("paid_flg"),
        F.count_distinct("invoice_id").alias("invoice_count"),
    )


def ledger_with_flags(snap_line: DataFrame, flags: DataFrame, keys=("vendor", "scope_floc_key")) -> DataFrame:
    """X4 + X8: the snapshot line with invoiced / paid flags (false when never invoiced)."""
    out = snap_line.join(flags, list(keys), "left")
    return out.withColumns(
        {
            "invoiced_flg": F.coalesce(F.col("invoiced_flg"), F.lit(False)),
            "paid_flg": F.coalesce(F.col("paid_flg"), F.lit(False)),
            "invoice_count": F.coalesce(F.col("invoice_count"), F.lit(0)).cast("bigint"),
            "ready_to_invoice_flg": F.coalesce(F.col("approved_to_invoice"), F.lit(False)),
        }
    )


def approved_view(ledger: DataFrame) -> DataFrame:
    """Ready to invoice and not yet invoiced."""
    return ledger.filter(F.col("ready_to_invoice_flg") & ~F.col("invoiced_flg"))


def blocked_view(ledger: DataFrame) -> DataFrame:
    """Not ready and not invoiced, with the blocker reasons."""
    return ledger.filter(~F.col("ready_to_invoice_flg") & ~F.col("invoiced_flg"))


def invoiced_paid_view(ledger: DataFrame) -> DataFrame:
    """Already invoiced, split by the paid flag."""
    return ledger.filter(F.col("invoiced_flg")).withColumn(
        "payment_state", F.when(F.col("paid_flg"), F.lit("PAID")).otherwise(F.lit("INVOICED_UNPAID"))
    )


def certified_versions(headers: DataFrame, *, invoice: str = "invoice_number", loaded: str = "loaded_at", version: str = "message_id") -> DataFrame:
    """Every version of every invoice, ``is_effective`` on the newest load (then highest version id).

    The effective version is a top-1 per invoice (partial limit before the
    shuffle, so an invoice with very many versions stays cheap), joined back
    to flag the versions; no window over all versions of an invoice.
    """
    eff = top1(headers.select(invoice, loaded, version), [invoice], [F.col(loaded).desc_nulls_last(), F.col(version).desc()])
    flags = eff.select(invoice, version, F.lit(True).alias("is_effective"))
    out = headers.join(flags, [invoice, version], "left")
    return out.withColumn("is_effective", F.coalesce(F.col("is_effective"), F.lit(False)))


def certified_current(versions: DataFrame) -> DataFrame:
    """The effective version per invoice."""
    return versions.filter(F.col("is_effective"))


def certified_lines(lines: DataFrame, current: DataFrame, version: str = "message_id") -> DataFrame:
    """The lines of the effective versions (semi join, no fan-out)."""
    return lines.join(current.select(version), version, "left_semi")
