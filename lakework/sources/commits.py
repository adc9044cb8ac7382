"""Commit logs: small numbered JSON files beside a dataset, and the file-system calls they need.

A log entry is created, never rewritten, so of two writers that take the same number one fails and nothing is lost.
All calls go through the file system that Spark itself uses for the path.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def qualified(spark: SparkSession, path: str) -> str:
    """The path as its file system spells it."""
    fs, p = _at(spark, path)
    return fs.makeQualified(p).toString()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, in order."""
    fs, p = _at(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def files_below(spark: SparkSession, path: str) -> frozenset[str]:
    """Names of the files directly in a folder."""
    fs, p = _at(spark, path)
    return frozenset(s.getPath().getName() for s in fs.listStatus(p) if s.isFile())


def first_lines(spark: SparkSession, path: str, glob: str = "*") -> list[tuple[str, str]]:
    """(file, first line) of a file, or of the visible files directly in a folder; a few files at a time."""
    fs, p = _at(spark, path)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{glob}")) if fs.getFileStatus(p).isDirectory() else [fs.getFileStatus(p)]
    files = sorted(s.getPath().toString() for s in found or [] if s.isFile() and not s.getPath().getName().startswith(("_", ".")))

    def head(file: str) -> str:
        own, f = _at(spark, file)
        java = spark._jvm.java.io
        reader = java.BufferedReader(java.InputStreamReader(own.open(f), "UTF-8"))
        try:
            return (reader.readLine() or "").removeprefix("\ufeff")
        finally:
            reader.close()

    with ThreadPoolExecutor(16) as pool:
        return list(zip(files, pool.map(head, files)))


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def append(spark: SparkSession, log: str, number: int, entry: dict) -> None:
    """Entry ``number`` of the log; an error if there is one already."""
    fs, p = _at(spark, f"{log}/{number:09d}.json")
    out = fs.create(p, False)
    try:
        out.write(bytearray((json.dumps(entry, sort_keys=True) + "\n").encode("utf-8")))
    finally:
        out.close()


def entries(spark: SparkSession, log: str, newest: int | None = None) -> list[dict]:
    """Entries of the log, oldest first, each with its ``number`` (the ``newest`` ones only, if given).

    One that a killed writer left unfinished was never committed and does not count.
    """
    found: list[dict] = []
    for path in reversed(matching(spark, f"{log}/*.json")):
        if newest is not None and len(found) == newest:
            break
        fs, p = _at(spark, path)
        stream = fs.open(p)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        if text.endswith("\n"):
            found.append(json.loads(text) | {"number": _number(path)})
    return found[::-1]


def remove_before(spark: SparkSession, log: str, number: int) -> None:
    """Removes the entries older than ``number``."""
    for path in matching(spark, f"{log}/*.json"):
        if _number(path) < number:
            remove(spark, path)


def _number(path: str) -> int:
    return int(path.rsplit("/", 1)[-1].removesuffix(".json"))


def next_number(spark: SparkSession, log: str) -> int:
    """The number after all that are taken, unfinished entries included."""
    names = matching(spark, f"{log}/*.json")
    return _number(names[-1]) + 1 if names else 1
