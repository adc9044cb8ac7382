"""Published eligibility snapshots (X2–X4): an append-only table by snapshot id, and the registry of what was published.

A snapshot is the official record of what was eligible at a time, so it is written once and never recomputed: the vendor
views read it from storage.  Publishing writes the line table, derives the scope summary from the rows just written, and
only then enters the snapshot in the registry; a snapshot that is not registered was not published.

The registry holds a row per snapshot.  A reader chooses from it before its plan is built, so the plan has one partition
folder and neither other snapshots nor any of the eligibility work.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.operators import history as H
from lakework.sources import commits
from lakework.sources.readers import dataset_path, escape

LINE = "invoice_eligibility_snapshot_line"
SUMMARY = "invoice_eligibility_snapshot_scope_package_summary"
REGISTRY_COLUMNS = "snapshot_id string, as_of_ts string, rule_version string, line_rows long"


def _log(root: str) -> str:
    return f"{root.rstrip('/')}/gold/invoice_eligibility_snapshot_registry"


def _folder(root: str, dataset: str, snapshot_id: str) -> str:
    return f"{dataset_path(root, 'gold', dataset, 'HISTORY')}/snapshot_id={escape(snapshot_id)}"


def _write(df: DataFrame, root: str, dataset: str) -> None:
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_id")
    w.parquet(dataset_path(root, "gold", dataset, "HISTORY"))


def publish(line: DataFrame, root: str, *, snapshot_id: str, as_of_ts: str, rule_version: str) -> None:
    """Publishes an eligibility line as an immutable snapshot, with its summary.

    Publishing an id again is an error; what a killed attempt left under it is replaced.
    """
    spark = line.sparkSession
    entries = commits.entries(spark, _log(root))
    if any(e["snapshot_id"] == snapshot_id for e in entries):
        raise ValueError(f"snapshot {snapshot_id} is published already")
    stamped = H.eligibility_snapshot(line, snapshot_id=snapshot_id, as_of_ts=as_of_ts, rule_version=rule_version)
    seen = Observation(f"snapshot {snapshot_id}")
    _write(stamped.observe(seen, F.count(F.lit(1)).alias("line_rows")), root, LINE)
    schemas = {LINE: stamped.schema}
    written = _read(spark, root, LINE, snapshot_id, stamped.schema)
    summary = H.snapshot_summary(written)
    schemas[SUMMARY] = summary.schema
    _write(summary, root, SUMMARY)
    entry = {"snapshot_id": snapshot_id, "as_of_ts": as_of_ts, "rule_version": rule_version, "line_rows": seen.get["line_rows"]}
    commits.append(spark, _log(root), commits.next_number(spark, _log(root)), entry | {"schemas": {k: s.json() for k, s in schemas.items()}})


def registry(spark: SparkSession, root: str) -> DataFrame:
    """One row per published snapshot."""
    names = [f.split()[0] for f in REGISTRY_COLUMNS.split(", ")]
    rows = [tuple(e[n] for n in names) for e in commits.entries(spark, _log(root))]
    return spark.createDataFrame(rows, REGISTRY_COLUMNS).withColumn("as_of_ts", F.col("as_of_ts").cast("timestamp_ntz"))


def _read(spark: SparkSession, root: str, dataset: str, snapshot_id: str, schema: T.StructType) -> DataFrame:
    if not commits.matching(spark, _folder(root, dataset, snapshot_id)):  # a snapshot without rows
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", dataset_path(root, "gold", dataset, "HISTORY")).schema(schema).parquet(_folder(root, dataset, snapshot_id))


def read(spark: SparkSession, root: str, *, as_of_ts: str | None = None, dataset: str = LINE) -> DataFrame:
    """The newest published snapshot, or the newest one up to ``as_of_ts`` (ISO text, as published); ties go to the greater id."""
    found = [e for e in commits.entries(spark, _log(root)) if as_of_ts is None or e["as_of_ts"] <= as_of_ts]
    if not found:
        raise LookupError("no snapshot is published" + (f" up to {as_of_ts}" if as_of_ts else ""))
    chosen = max(found, key=lambda e: (e["as_of_ts"], e["snapshot_id"]))
    return _read(spark, root, dataset, chosen["snapshot_id"], T.StructType.fromJson(json.loads(chosen["schemas"][dataset])))
