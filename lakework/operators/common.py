"""Shared building blocks: top-1 per key, size-checked broadcast, ordered joined-unique."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows a dimension may hold and still be broadcast.  Checked with a bounded
# count before the hint is applied; above it the join stays a shuffle join
# (and AQE may still convert it at run time from real shuffle sizes).
BROADCAST_MAX_ROWS = 2_000_000


def top1(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the first under ``order``.

    ``row_number() = 1`` lets Spark insert a partial ``WindowGroupLimit`` before
    the shuffle, so every map task forwards at most one row per key: a key that
    holds a third of the input costs one row per task, not a third of the data
    in one reducer.  ``order`` must be total for a deterministic result.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def bounded_rows(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most ``max_rows + 1``)."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_bytes(df: DataFrame, max_bytes: int) -> bool:
    """True when the rows of ``df`` take at most ``max_bytes`` as text (an aggregate of one number)."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("n")).first()["n"]
    return (size or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only behind a proven size bound; otherwise the frame as is."""
    return F.broadcast(df) if bounded_rows(df, max_rows) else df


#: Aggregations that can be applied to their own results.
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def joined_unique(
    df: DataFrame,
    group: Sequence[str],
    values: dict[str, Column],
    position: Column,
    sep: str = ";",
    stats: dict[str, tuple[str, Column]] | None = None,
    counts: dict[str, str] | None = None,
) -> DataFrame:
    """A3: per group, the distinct non-null values of each column in first-appearance order, joined.

    ``values`` maps an output name to a value expression; ``stats`` adds aggregates of the rows (output name → count, sum,
    min or max of an expression) and ``counts`` the number of distinct values of an output.  An output is null when the
    group has no value for it; a group without any value is left out unless there are statistics of its rows.

    One pass and one shuffle of what is in ``df``.  Rows are unpivoted to (column, value), which collapse to the earliest
    position with partial aggregation before the shuffle, so a group forwards each distinct value of a column once for a
    task, not its rows nor their combinations, which are nearly as many.  It then gathers one small struct per distinct value.
    """
    names, stats, counts = list(values), stats or {}, counts or {}
    own_value = {n: c.isNotNull().cast("bigint") if how == "count" else c for n, (how, c) in stats.items()}
    rows = df.select(*[F.col(g) for g in group], *[values[n].cast("string").alias(f"__{n}") for n in names], position.alias("__p"), *[c.alias(f"__s_{n}") for n, c in own_value.items()])
    # The first entry carries the statistics of the row, the others its values.
    none = {n: F.lit(None).cast(rows.schema[f"__s_{n}"].dataType).alias(f"__s_{n}") for n in stats}
    entry = lambda k, v, own: F.struct(F.lit(k).alias("n"), v.alias("v"), *[F.col(f"__s_{n}") if own else none[n] for n in stats])
    first = [entry(-1, F.lit(None).cast("string"), True)] if stats else []
    entries = F.array(*first, *[entry(k, F.col(f"__{n}"), False) for k, n in enumerate(names)])
    pairs = rows.select(*group, "__p", F.explode(entries).alias("__t")).select(*group, "__p", "__t.*")
    pairs = pairs.filter((F.col("n") < 0) | F.col("v").isNotNull()).groupBy(*group, "n", "v")
    pairs = pairs.agg(F.min("__p").alias("__p"), *[_MERGE[how](f"__s_{n}").alias(f"__s_{n}") for n, (how, _) in stats.items()])
    outs = []
    for k, n in enumerate(names):
        items = F.array_sort(F.collect_list(F.when(F.col("n") == k, F.struct(F.col("__p"), F.col("v")))))
        outs.append(F.nullif(F.concat_ws(sep, F.transform(items, lambda e: e["v"])), F.lit("")).alias(n))
    outs += [_MERGE[how](f"__s_{n}").alias(n) for n, (how, _) in stats.items()]
    outs += [F.count_if(F.col("n") == names.index(of)).alias(n) for n, of in counts.items()]
    return pairs.groupBy(*group).agg(*outs)


def number_rows(df: DataFrame, group: Sequence[str], order: str, out: str = "line_number", bucket_size: int = 1 << 16) -> DataFrame:
    """1..n numbering of the rows of each group by an integer ``order`` (unique within the group).

    A window over a whole group would put a group holding a third of the rows
    into one task.  Instead the rows are cut into buckets of ``bucket_size``
    consecutive ``order`` values: a partial aggregation counts each (group,
    bucket); a window over those counts (one row per bucket) gives each bucket
    its offset; rows are then numbered inside their bucket, which holds at most
    ``bucket_size`` rows, and shifted by the offset.
    """
    b = F.floor(F.col(order) / F.lit(bucket_size)).cast("bigint")
    keyed = df.withColumn("__b", b)
    counts = keyed.groupBy(*group, "__b").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n")
    joined = keyed.join(offsets, [*group, "__b"])
    inner = Window.partitionBy(*group, "__b").orderBy(order)
    return joined.withColumn(out, (F.row_number().over(inner) + F.col("__off")).cast("int")).drop("__b", "__off")
