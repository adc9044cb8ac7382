"""Helpers shared by the training-data operators: inputs, written intermediates, Arrow batches."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakework.session import checkpoint_dir

#: Rows and bytes of one Arrow batch; whole texts travel in these batches, so
#: both stay small to bound a Python worker's memory.
BATCH_ROWS = 128
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the workers, once in a Spark application, so that they need no installed copy."""
    sc = spark.sparkContext
    if getattr(sc, "_lakework_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    # The driver serves this file to executors as long as the application runs.
    folder = os.path.realpath(tempfile.mkdtemp(prefix="lakework-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/lakework.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(path)
    sc._lakework_shipped = True


def python_workers(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Readies the session for functions that run in Python workers.

    Plans built from here on send Arrow batches of at most ``rows`` rows and ``BATCH_BYTES`` bytes.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def materialize(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read back.

    Cuts the lineage (a lost executor rereads the table instead of recomputing
    it) and gives the next step fresh statistics and exchanges.  The folder is
    the shared one the cluster names; it is the owner's to clean up, because
    lazy results still read from it.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; null for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % F.lit(modulus)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows`` rows, whatever the session's batch size is."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def give_back() -> None:
    """Returns memory that this process has freed to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, for mapInArrow, in a worker that gives freed memory back in the end: it stays beside the JVM while other stages run."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return made


def smallest(rows: DataFrame, order: list[str], wanted: dict, counts: dict, by: str | None = None) -> list:
    """The first ``wanted[label]`` rows of each label by ``order``, whose first column is a hash (long); a list on the driver.

    ``counts`` says how many rows a label has at most.  From it follows a hash below which about twice the wanted rows lie, and only
    those are passed on, so no task gets more, however many tasks there are.  Where they are too few (rows that the
    count includes and ``rows`` does not), the bound is raised.
    """
    label = F.col(by) if by else F.lit(None)
    shares = {k: min(1.0, (2 * wanted[k] + 100) / max(n, 1)) for k, n in counts.items() if k in wanted and n}
    found: list = []
    while shares:
        bound = F.lit(None).cast("long")
        for k, share in shares.items():
            limit = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
            bound = F.when(label.eqNullSafe(F.lit(k)), F.lit(limit)).otherwise(bound)
        below = rows.filter(F.col(order[0]) <= bound)
        if by:
            w = Window.partitionBy(label.alias("__label")).orderBy(*order)
            most = F.lit(None).cast("long")
            for k in shares:
                most = F.when(label.eqNullSafe(F.lit(k)), F.lit(wanted[k])).otherwise(most)
            got = below.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most).collect()
        else:
            got = below.orderBy(*order).limit(wanted[None]).collect()
        mine = {k: [r for r in got if (r[by] if by else None) == k] for k in shares}
        done = [k for k, own in mine.items() if len(own) >= wanted[k] or shares[k] >= 1.0]
        for k in done:
            found += mine[k]
            del shares[k]
        shares = {k: min(1.0, 8 * s) for k, s in shares.items()}
    return found
