"""Session settings the operators rely on, and the shared scratch location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in SQL_SETTINGS.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lakework") -> SparkSession:
    """A local session for tests and benchmarks (UI off, event log off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LAKEWORK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # PySpark 4 records the Python call site of every Column it builds (for
        # error messages), walking the stack each time; with plans of a few
        # hundred operators that dominated plan construction.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in SQL_SETTINGS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset and Spark runs in this process
    (local tests) a fresh scratch folder is created and registered.  On a cluster
    a machine-local folder would be incomplete, so there an unset folder is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # no SparkContext access (e.g. Spark Connect)
            d = None
    if not d:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="lakework-ckpt-", dir=os.environ.get("LAKEWORK_SCRATCH", "/tmp"))
        try:
            spark.sparkContext.setCheckpointDir(d)
        except Exception:
            pass
    return d
