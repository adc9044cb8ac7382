"""

``availableNow`` processes every file present and stops, so a scheduled run
and a continuous run are the same job; the checkpoint records which files are
done, so a rerun (or a lost executor) never loads a file twice.  Each batch is
merged into CURRENT with the keep-last-per-key rule (K5), the batch id being
the load order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakework.operators.common import top1
from lakework.sources.publish import publish_accumulating


def upsert_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    *,
    root: str,
    layer: str,
    dataset: str,
    keys: Sequence[str],
    checkpoint: str,
    fmt: str = "parquet",
    order_col: str | None = None,
    max_files_per_trigger: int | None = None,
    options: dict | None = None,
    buckets: int,
) -> StreamingQuery:
    """Start an ``availableNow`` stream from ``source`` into an accumulating CURRENT.

    ``order_col`` orders rows inside a batch (later wins); batches themselves
    are ordered by their id.  CURRENT is key-bucketed (``buckets``), so a batch
    rewrites only the buckets its keys fall in.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source)

    def merge(batch: DataFrame, batch_id: int) -> None:
        if order_col:  # one row per key inside the batch: the latest wins
            rest = [F.col(c).asc_nulls_last() for c in batch.columns if c not in (*keys, order_col)]
            batch = top1(batch, list(keys), [F.col(order_col).desc_nulls_last(), *rest])
        publish_accumulating(
            spark, batch.withColumn("__load_seq", F.lit(batch_id).cast("bigint")), root, layer, dataset, keys,
            run_id=f"batch-{batch_id}", buckets=buckets,
        )

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
