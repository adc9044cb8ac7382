"""

These work on the schema only (driver side, no data), and return plain
projections so Catalyst prunes everything that is not used.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the survey export prefix removed from column names.
EXPORT_PREFIX = r"^stg_azure_inspectapp_inspections_all_"


def q(name: str) -> Column:
    """A column reference that tolerates spaces, dots and ``#`` in the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip_names(df: DataFrame) -> DataFrame:
    """Trim column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def collapse_name_spaces(df: DataFrame) -> DataFrame:
    """Trim names and collapse inner whitespace to one space."""
    return df.toDF(*[re.sub(r"\s+", " ", c.strip()) for c in df.columns])


def strip_export_prefix(df: DataFrame, prefix: str = EXPORT_PREFIX) -> DataFrame:
    """Drop the export prefix (any case) and a trailing ``;`` from names."""
    pat = re.compile(prefix, re.IGNORECASE)
    return df.toDF(*[pat.sub("", c.strip().rstrip(";")) for c in df.columns])


def _normalise(name: str, mode: str) -> str:
    if mode == "lower":
        return name.strip().lower()
    if mode == "nospace":
        return re.sub(r"\s+", "", name)
    if mode == "exact":
        return name
    raise ValueError(f"unknown mode {mode!r}")


def find_col(columns: Sequence[str], candidates: Iterable[str], mode: str = "lower") -> str | None:
    """The first candidate present in ``columns`` under the ``mode`` normalisation.

    Fails when a candidate matches more than one column (ambiguous sheet).
    """
    index: dict[str, list[str]] = {}
    for c in columns:
        index.setdefault(_normalise(c, mode), []).append(c)
    for cand in candidates:
        hits = index.get(_normalise(cand, mode), [])
        if len(hits) > 1:
            raise ValueError(f"ambiguous column {cand!r}: {hits}")
        if hits:
            return hits[0]
    return None


def require_col(columns: Sequence[str], candidates: Iterable[str], mode: str = "lower") -> str:
    cands = list(candidates)
    hit = find_col(columns, cands, mode)
    if hit is None:
        raise ValueError(f"missing required column, tried {cands}; found {list(columns)[:50]}")
    return hit


def col_or_default(df: DataFrame, name: str, default, dtype: str) -> Column:
    """The column when present, else a literal default of the given type."""
    return q(name).cast(dtype) if name in df.columns else F.lit(default).cast(dtype)


def conform(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, list[str], list[str]]:
    """Project to the ordered schema; missing columns and values that do not fit become typed nulls.

    Returns the conformed frame and the missing and extra column names.
    """
    present = set(df.columns)
    wanted = [f.name for f in schema.fields]
    missing = [n for n in wanted if n not in present]
    extra = [c for c in df.columns if c not in set(wanted)]
    cols = [
        (q(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*cols), missing, extra


def misfits(df: DataFrame, schema: T.StructType) -> DataFrame:
    """For each column of the schema that ``df`` has, how many values ``conform`` turns to null because they do not fit."""
    fields = [f for f in schema.fields if f.name in df.columns]
    counts = df.agg(*[F.count_if(q(f.name).isNotNull() & q(f.name).try_cast(f.dataType).isNull()).alias(f"n{i}") for i, f in enumerate(fields)])
    rows = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"), F.col(f"n{i}").alias("misfits")) for i, f in enumerate(fields)]
    return counts.select(F.inline(F.array(*rows)))


def keep_existing(df: DataFrame, keep: Sequence[str], rest: bool = False) -> DataFrame:
    """The listed columns that exist, in order; optionally the others after them."""
    first = [c for c in keep if c in df.columns]
    tail = [c for c in df.columns if c not in set(first)] if rest else []
    return df.select(*[q(c) for c in first + tail])


def rename_if_absent(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename ``src → dst`` only when ``dst`` is not already a column."""
    for src, dst in mapping.items():
        if src in df.columns and dst not in df.columns:
            df = df.withColumnRenamed(src, dst)
    return df


def with_lineage(df: DataFrame, **values) -> DataFrame:
    """P10: literal lineage columns (run date, run id, source file, ...)."""
    return df.withColumns({k: F.lit(v).cast("string") for k, v in values.items()})
