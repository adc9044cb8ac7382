"""Versioned tables: CURRENT as version folders and a pointer that says which of them count.

A publication writes folders of its own, ``CURRENT/<partitions>/__version=<v>``, and then adds one entry to the log
``CURRENT/_pointer``: for every partition, the version folder that holds it.  Readers take the newest entry, so they see
all of a publication or nothing of it, whenever the writer dies.  Partitions that a publication does not touch keep the
folder they had.  Each entry also holds the schema, so no reader has to look into the files for it.

Old entries and the folders that only they name are removed after a commit; the newest ``RETAIN`` stay, for readers that
began before it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.sources import commits

VERSION = "__version"
#: Publications whose folders are kept.
RETAIN = 2


def _log(path: str) -> str:
    return f"{path}/_pointer"


def newest(spark: SparkSession, path: str) -> dict | None:
    """The entry that readers follow, or None where nothing was published."""
    found = commits.entries(spark, _log(path), newest=1)
    return found[-1] if found else None


def publish(df: DataFrame, path: str, *, partitions: Sequence[str] = (), run_id: str = "", **facts) -> dict:
    """Replaces the partitions that ``df`` holds (the whole table without ``partitions``); others stay as they are.

    A run that is repeated takes its earlier publication back: a partition that it published then and does not hold now
    is again what it was before.  ``facts`` are kept in the entry.
    """
    spark = df.sparkSession
    log = _log(path)
    before = commits.entries(spark, log)
    number = commits.next_number(spark, log)
    version = f"{number:09d}-{uuid.uuid4().hex[:8]}"
    columns = [*partitions, VERSION]
    df.withColumn(VERSION, F.lit(version)).write.mode("append").partitionBy(*columns).parquet(path)
    written = [name for name, _, _ in _folders(spark, path, len(partitions), version)]
    old = before[-1] if before and before[-1]["partitions"] == list(partitions) else None
    parts: dict[str, dict] = {}
    if old and partitions:
        for name, part in old["parts"].items():
            if run_id and part["run_id"] == run_id:
                part = next((e["parts"][name] for e in reversed(before) if name in e["parts"] and e["parts"][name]["run_id"] != run_id), None)
            if part:
                parts[name] = part
    kept = bool(parts.keys() - set(written))
    parts |= {name: {"version": version, "run_id": run_id} for name in written}
    schema = df.schema
    if kept:
        known = {f.name for f in schema.fields}
        schema = T.StructType([*schema.fields, *(f for f in T.StructType.fromJson(json.loads(old["schema"])).fields if f.name not in known)])
    entry = {"partitions": list(partitions), "parts": parts, "schema": schema.json(), "run_id": run_id, **facts}
    commits.append(spark, log, number, entry)
    _clean(spark, path, number, {len(e["partitions"]) for e in [*before, entry]})
    return entry


def _folders(spark: SparkSession, path: str, depth: int, version: str = "*") -> list[tuple[str, str, str]]:
    """(partition, version, path) of the version folders below ``depth`` partition columns."""
    out, root = [], commits.qualified(spark, path)
    for p in commits.matching(spark, f"{path}/{'*/' * depth}{VERSION}={version}"):
        place, found = p.removeprefix(f"{root}/").rsplit(f"{VERSION}=", 1)
        out.append((place.rstrip("/"), found, p))
    return out


def _clean(spark: SparkSession, path: str, number: int, depths: set[int]) -> None:
    """Removes entries older than the newest ``RETAIN``, and version folders up to ``number`` that no entry left names."""
    log = _log(path)
    kept = commits.entries(spark, log, newest=RETAIN)
    named = {(name, part["version"]) for e in kept for name, part in e["parts"].items()}
    for depth in depths:
        for name, version, p in _folders(spark, path, depth):
            if int(version.split("-")[0]) <= number and (name, version) not in named:
                commits.remove(spark, p)
    commits.remove_before(spark, log, kept[0]["number"])


def read(spark: SparkSession, path: str, schema: T.StructType | None = None, wanted: Callable[[str], bool] | None = None) -> DataFrame | None:
    """The published table, or None where nothing was published.

    ``wanted`` chooses partitions by the name of their folder (``vendor=V0``); only their files are listed and read.
    """
    entry = newest(spark, path)
    if entry is None:
        return None
    own = T.StructType.fromJson(json.loads(entry["schema"]))
    asked = schema or own
    paths = [f"{path}/{name}/{VERSION}={p['version']}" if name else f"{path}/{VERSION}={p['version']}" for name, p in entry["parts"].items() if wanted is None or wanted(name)]
    if not paths:
        return spark.createDataFrame([], asked)
    return spark.read.option("basePath", path).schema(T.StructType([*asked.fields, T.StructField(VERSION, T.StringType())])).parquet(*paths).drop(VERSION)
