"""Exact duplicates by content-defined chunk recipes (operator 2), built-in functions only.

Every text is cut into chunks whose ends depend on its content.  A chunk's
identifier is a 64-bit hash; the chunks themselves move once, reduced to
distinct ones before the shuffle, to verify that no two chunks share a hash.
Chunks that do are told apart by a number.  A document is then represented by
the ordered list of its verified identifiers, its recipe; only recipes are
grouped and joined, long texts never move again.

Edge cases: null text equals empty text (no chunks, the empty recipe).
A null id counts as the smallest; a group of null ids only has a null keep_id and keeps
its rows.  Rows that repeat id and text are the same document: they all count
in group_size and carry the same flags, and ``drop_copies`` leaves one.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakework.llm.common import materialize, text_or_empty
from lakework.operators.common import top1

#: A chunk ends after the first sentence end or line break at 256 characters or
#: later, at the latest after 4,096.
CHUNK = r"(?s).{256,4095}?(?:[.!?]\s|\n)|.{1,4096}"


def chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hasher: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """id, text_sha256 and recipe (ordered verified chunk identifiers) of every row."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("t"))
    plain = src.select(
        "id", F.sha2(F.col("t").cast("binary"), 256).alias("text_sha256"), F.transform(chunks(F.col("t")), lambda c: hasher(c)).alias("recipe")
    )
    pieces = src.select(F.explode(chunks(F.col("t"))).alias("chunk")).select(hasher(F.col("chunk")).alias("h"), "chunk").distinct()
    shared = materialize(pieces.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "chunk-hashes")
    if shared.isEmpty():
        return plain
    # Chunks under one hash: numbered by content; their number follows the hash in the recipe.
    by_content = Window.partitionBy("h").orderBy("chunk")
    numbered = materialize(pieces.join(shared, "h").withColumn("no", F.row_number().over(by_content).cast("long")), "chunk-numbers")
    at = (
        src.select(F.sha2(F.col("t").cast("binary"), 256).alias("text_sha256"), F.posexplode(chunks(F.col("t"))).alias("pos", "chunk"))
        .withColumn("h", hasher(F.col("chunk")))
        .join(numbered, ["h", "chunk"])
        .groupBy("text_sha256", "pos")
        .agg(F.max("no").alias("no"))
    )
    fixes = materialize(at.groupBy("text_sha256").agg(F.map_from_entries(F.collect_list(F.struct("pos", "no"))).alias("fix")), "chunk-fixes")
    spelt = F.flatten(
        F.transform("recipe", lambda h, i: F.when(F.try_element_at("fix", i).isNull(), F.array(h)).otherwise(F.array(h, F.try_element_at("fix", i))))
    )
    return plain.join(fixes, "text_sha256", "left").select("id", "text_sha256", F.when(F.col("fix").isNull(), F.col("recipe")).otherwise(spelt).alias("recipe"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hasher: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    rows = materialize(recipes(docs, id_col, text_col, hasher), "recipes")
    # Written, so that both sides of the join are shuffled for it and a recipe
    # that a third of the rows share can be split.
    groups = materialize(rows.groupBy("recipe").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "recipe-groups")
    return rows.join(groups, "recipe").select("id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    key = F.sha2(text_or_empty(text_col).cast("binary"), 256)
    others = [F.col(c).cast("string") for c in docs.columns if c not in (id_col, text_col)]
    one = top1(docs.withColumn("__sha", key), [id_col, "__sha"], others or [F.lit(0)])
    kept = copies(docs, id_col, text_col).filter("kept").select(F.col("id").alias("__id"), F.col("text_sha256").alias("__sha2"))
    on = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.col("__sha") == F.col("__sha2"))
    return one.join(kept, on, "left_semi").select(*docs.columns)
