"""

HISTORY is append-only and partitioned by run; CURRENT is a versioned table: new
folders, then a pointer to them, so readers never see half a publication and no
job reads the files it replaces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakework.operators.ledger import keep_last
from lakework.sources import commits, versions
from lakework.sources.readers import dataset_path, read_run, run_pattern

# Fixed value: the leading partition order; other partition keys follow alphabetically.
PARTITION_ORDER = ("vendor", "run_date", "run_id")


def ordered_partitions(keys: Sequence[str]) -> list[str]:
    """K4: vendor → run_date → run_id → the others alphabetically (duplicates dropped)."""
    keys = list(dict.fromkeys(keys))
    lead = [k for k in PARTITION_ORDER if k in keys]
    return lead + sorted(k for k in keys if k not in PARTITION_ORDER)


def _with_run(df: DataFrame, run_date: str, run_id: str) -> DataFrame:
    return df.withColumns({"run_date": F.lit(run_date), "run_id": F.lit(run_id)})


def publish_history(
    df: DataFrame,
    root: str,
    layer: str,
    dataset: str,
    *,
    run_date: str,
    run_id: str,
    partitions: Sequence[str] = (),
    fmt: str = "parquet",
    path: str | None = None,
    **options,
) -> str:
    """K1/K3/K4: one run of HISTORY, partitioned by run (and ``partitions``).

    A rerun replaces all that the run had written: its partitions are overwritten, and those that it no longer fills are
    removed.
    """
    spark = df.sparkSession
    path = path or dataset_path(root, layer, dataset, "HISTORY")
    parts = ordered_partitions([*partitions, "run_date", "run_id"])
    deeper = "/*" * (len(parts) - parts.index("run_id") - 1)
    pattern = run_pattern(path, run_date, run_id, by_vendor="vendor" in partitions) + deeper
    before = {p: commits.files_below(spark, p) for p in commits.matching(spark, pattern)}
    w = _with_run(df, run_date, run_id).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options)
    w.format(fmt).partitionBy(*parts).save(path)
    for p, files in before.items():
        if commits.files_below(spark, p) == files:
            commits.remove(spark, p)
    return path


def publish_current(df: DataFrame, root: str, layer: str, dataset: str, *, partitions: Sequence[str] = (), run_id: str = "") -> str:
    """K1/K2: replace CURRENT.  With partitions (e.g. vendor) only the partitions present are replaced, others are kept.

    The rows go to folders of a new version, and one pointer entry makes them CURRENT (see ``versions``).
    """
    path = dataset_path(root, layer, dataset, "CURRENT")
    versions.publish(df, path, partitions=ordered_partitions(partitions), run_id=run_id)
    return path


def _publish_both(df: DataFrame, root: str, layer: str, dataset: str, run_date: str, run_id: str, partitions: Sequence[str]) -> tuple[str, str]:
    """HISTORY from the plan of ``df``, CURRENT from the rows just written: the plan runs once."""
    h = publish_history(df, root, layer, dataset, run_date=run_date, run_id=run_id, partitions=partitions)
    rows = read_run(df.sparkSession, h, df.schema, run_date=run_date, run_id=run_id, by_vendor="vendor" in partitions)
    return h, publish_current(rows, root, layer, dataset, partitions=partitions, run_id=run_id)


def publish_whole_table(df: DataFrame, root: str, layer: str, dataset: str, *, run_date: str, run_id: str) -> tuple[str, str]:
    """K1: HISTORY partition for the run plus a replaced CURRENT."""
    return _publish_both(df, root, layer, dataset, run_date, run_id, ())


def publish_vendor_partitioned(df: DataFrame, root: str, layer: str, dataset: str, *, run_date: str, run_id: str, extra: Sequence[str] = ()) -> tuple[str, str]:
    """K2/K3: vendor-partitioned HISTORY and CURRENT; CURRENT is replaced only for the vendors present."""
    return _publish_both(df, root, layer, dataset, run_date, run_id, ["vendor", *extra])


BUCKET_COL = "__key_bucket"
#: Buckets of an accumulating CURRENT, unless the caller knows better; a dataset keeps the number it began with.
BUCKETS = 64


def key_bucket(keys: Sequence[str], buckets: int):
    """Stable bucket of a key (xxhash64, non-negative modulo)."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _with_columns_of(df: DataFrame, other: DataFrame) -> DataFrame:
    """``df`` with null columns for what only ``other`` has."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in other.schema.fields if f.name not in df.columns})


def publish_accumulating(
    spark: SparkSession,
    new: DataFrame,
    root: str,
    layer: str,
    dataset: str,
    keys: Sequence[str],
    *,
    run_id: str,
    order: str = "__load_seq",
    buckets: int | None = None,
) -> DataFrame:
    """K5: CURRENT := keep-last-per-key(CURRENT ∪ new).

    Columns that only CURRENT or only the load has are kept, null for the other's rows.
    CURRENT is partitioned by a hash bucket of the key.  A load reads the buckets that its new rows fall in (at most
    ``buckets`` small integers, chosen before the plan is built) and publishes new versions of those alone, so it costs what
    it touches, not the size of everything loaded so far.  What it reads is never what it writes.
    """
    path = dataset_path(root, layer, dataset, "CURRENT")
    entry = versions.newest(spark, path)
    buckets = entry["buckets"] if entry else buckets or BUCKETS
    tagged = new.withColumn(BUCKET_COL, key_bucket(keys, buckets))
    if entry is None:
        merged = keep_last(tagged.limit(0), tagged, keys, order=order)
    else:
        touched = {f"{BUCKET_COL}={r[0]}" for r in tagged.select(BUCKET_COL).distinct().collect()}
        current = versions.read(spark, path, wanted=touched.__contains__)
        merged = keep_last(_with_columns_of(current, tagged), _with_columns_of(tagged, current), keys, order=order)
    # Each bucket meets in one task, so a load writes a file for each bucket, not for each bucket and task.
    versions.publish(merged.repartition(F.col(BUCKET_COL)), path, partitions=[BUCKET_COL], buckets=buckets)
    return versions.read(spark, path).drop(BUCKET_COL)


def publish_delta(delta: DataFrame, root: str, dataset: str, *, vendor: str, run_date: str, run_id: str) -> str:
    """K6: the three change sets of a snapshot delta as one HISTORY table partitioned by change set."""
    df = delta.withColumn("vendor", F.lit(vendor))
    return publish_history(df, root, "silver", f"{dataset}_delta", run_date=run_date, run_id=run_id, partitions=["vendor", "change_set"])


def load_header(raw: DataFrame, line: DataFrame, *, dataset: str, run_date: str, run_id: str, vendor: str | None = None) -> DataFrame:
    """K7: one-row load summary (raw rows, raw columns, line rows) for the run."""
    r = raw.agg(F.count(F.lit(1)).alias("raw_rows")).withColumn("__k", F.lit(1))
    s = line.agg(F.count(F.lit(1)).alias("silver_rows")).withColumn("__k", F.lit(1))
    return r.join(s, "__k").select(
        F.lit(dataset).alias("dataset"),
        F.lit(vendor).cast("string").alias("vendor"),
        F.lit(run_date).alias("run_date"),
        F.lit(run_id).alias("run_id"),
        F.col("raw_rows"),
        F.lit(len(raw.columns)).alias("raw_cols"),
        F.col("silver_rows"),
    )


def archive_manifest(spark: SparkSession, path: str, *, run_date: str, run_id: str, glob: str = "*") -> DataFrame:
    """Content hash, size and name of every input file, with the run (the raw-copy receipt)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select(
        F.col("path"),
        F.element_at(F.split(F.col("path"), "/"), -1).alias("file_name"),
        F.col("length"),
        F.sha2(F.col("content"), 256).alias("file_hash"),
        F.lit(run_date).alias("run_date"),
        F.lit(run_id).alias("run_id"),
    )


def vendor_export(df: DataFrame, root: str, name: str, *, run_date: str, run_id: str) -> tuple[str, str]:
    """Vendor-facing CSV files: CURRENT replaced per vendor present, HISTORY per run (a rerun replaces its own files)."""
    base = f"{root.rstrip('/')}/export/{name}"
    # Both copies are written from the same rows: the plan of ``df`` runs once.  A caller that exports them again keeps them.
    own = not df.is_cached
    if own:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        history = publish_history(df, root, "gold", name, run_date=run_date, run_id=run_id, partitions=["vendor"], fmt="csv", path=f"{base}/HISTORY", header=True)
        written = _with_run(df, run_date, run_id).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        written.option("header", True).partitionBy("vendor").csv(f"{base}/CURRENT")
    finally:
        if own:
            df.unpersist()
    return history, f"{base}/CURRENT"
