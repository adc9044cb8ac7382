"""A training corpus from ``documents``: without toxic texts, texts in no language, copies and near copies, then packed.

Every stage reads what the one before kept and takes effect on it; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakework.llm import exact, language, neardup, packing, toxicity
from lakework.llm.common import materialize, table
from lakework.llm.queries import tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the compression distance does not take for toxic.

    Null and empty texts are no more toxic than the labels' share; without labels of both kinds all texts stay or go by
    it alone.  Rows that repeat are judged alike.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, out="__toxicity")
    return scored.filter(~toxicity.toxic(F.col("__toxicity"))).select(*docs.columns)


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in one of the languages that the labelled documents teach.

    Those go that hold no letter (null and empty ones too), and those of 100 letters or more that every language's classifier turns
    down and that are made of n-grams unlike those of all languages.  Texts in two of the languages stay.
    Without labels nothing can be learned, and every text goes.
    """
    model = language.train(docs)
    found = language.identify(docs, model, label_out="__lang", score_out="__score", letters_out="__letters", known_out="__known")
    kept = language.in_a_language(model, F.col("__lang"), F.col("__score"), F.col("__letters"), F.col("__known"))
    return found.filter(kept).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id; null equals empty, and rows that repeat id and text leave one."""
    return exact.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the one with the smallest id; a text without words is like no other."""
    return neardup.drop_near_copies(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens and their places in training sequences; an empty or null text is its closing id alone."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", not_toxic),
    ("language", in_a_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("packing", packed),
]

#: SQL can express neither the classifiers nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
