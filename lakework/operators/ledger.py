
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakework.operators.common import top1

# Fixed value: ledger status of a file that was loaded.
LOADED = "LOADED"


def keep_last(current: DataFrame | None, new: DataFrame, keys: Sequence[str], order: str = "__load_seq") -> DataFrame:
    """Union CURRENT with the new load and keep the last row per key.

    ``order`` is the load order (greater = later); when absent, every new row
    outranks every current row.  Skipped (new rows returned unchanged) when a
    key column is missing, as in the reference.
    """
    if current is None:
        return new
    if any(k not in new.columns or k not in current.columns for k in keys):
        return current.unionByName(new, allowMissingColumns=True)
    tagged_cur = current.withColumn("__src", F.lit(0))
    tagged_new = new.withColumn("__src", F.lit(1))
    both = tagged_cur.unionByName(tagged_new, allowMissingColumns=True)
    rank = [F.col("__src").desc()]
    if order in both.columns:
        rank.insert(0, F.col(order).desc_nulls_last())
    rest = [F.col(c).asc_nulls_last() for c in both.columns if c not in (*keys, "__src", order)]
    return top1(both, list(keys), rank + rest).drop("__src")


def upsert(base: DataFrame, updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """K9: keyed upsert: matching rows take the update's non-key columns, new columns are added,
    unmatched updates are appended, other base rows are kept.

    A full outer join on the key; a column present in ``updates`` wins for
    matched rows even when its value is null, as a row update does.
    """
    k = list(key)
    up_cols = [c for c in updates.columns if c not in k]
    base_cols = [c for c in base.columns if c not in k]
    b = base.select(*k, *[F.col(c).alias(f"__b_{c}") for c in base_cols], F.lit(True).alias("__in_b"))
    u = updates.select(*k, *[F.col(c).alias(f"__u_{c}") for c in up_cols], F.lit(True).alias("__in_u"))
    j = b.join(u, k, "full_outer")
    in_u = F.coalesce(F.col("__in_u"), F.lit(False))
    cols = []
    for c in base_cols + [c for c in up_cols if c not in base_cols]:
        if c in up_cols and c in base_cols:
            cols.append(F.when(in_u, F.col(f"__u_{c}")).otherwise(F.col(f"__b_{c}")).alias(c))
        elif c in up_cols:
            cols.append(F.col(f"__u_{c}").alias(c))
        else:
            cols.append(F.col(f"__b_{c}").alias(c))
    return j.select(*k, *cols)


def not_yet_loaded(manifest: DataFrame, ledger: DataFrame, key: str = "file_hash") -> DataFrame:
    """Incoming files whose hash is not recorded as LOADED."""
    done = ledger.filter(F.col("status") == LOADED).select(key)
    return manifest.join(done, key, "left_anti")


def run_latest_state(ledger: DataFrame) -> DataFrame:
    """Current state per run from an append-only ledger (latest event per run id)."""
    return ledger.groupBy("run_id").agg(
        F.max_by("status", F.struct("event_ts", "status")).alias("status"),
        F.min("event_ts").alias("started_at"),
        F.max("event_ts").alias("last_event_at"),
        F.count(F.lit(1)).alias("event_count"),
    )


def row_counts_by(df: DataFrame, col: str) -> DataFrame:
    """Per-partition counts (for run metrics)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("row_count"))


# Run states of the run ledger.
RUNNING, SUCCEEDED, FAILED = "RUNNING", "SUCCEEDED", "FAILED"


def run_record(spark, run_id: str, status: str, *, pipeline: str, run_date: str, metrics: dict | None = None, error: str | None = None) -> DataFrame:
    """One ledger row (start, success or failure) with the run metrics as JSON."""
    import json

    return spark.createDataFrame(
        [(run_id, pipeline, run_date, status, json.dumps(metrics or {}, sort_keys=True, default=str), error)],
        "run_id string, pipeline string, run_date string, status string, metrics_json string, error string",
    ).withColumn("event_ts", F.current_timestamp())


def append_run_record(record: DataFrame, path: str) -> None:
    """Append-only ledger; the state of a run is derived by ``run_latest_state``."""
    record.write.mode("append").parquet(path)
