"""License scans by diagonal voting (operator 6).

All rolling word k-grams of all texts are joined, by hash, to the positions of
the same k-grams in license templates.  A hit votes for a diagonal: its place in the text minus
its place in the template.  Votes are summed up by diagonal, neighbouring diagonals (an inserted or missing word
moves to the next one) are merged into spans, and a span counts if the template
k-grams that it holds, compared word by word, cover enough of the template.

A phrase that stands in a text unchanged is a diagonal with all votes.

Edge cases: null text counts as empty and has no words; a text without hits
has null places, empty labels and score 0.  Rows that repeat id and text give
the same result each; a null id is an id like others.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakework.llm.common import slices, python_workers, text_or_empty
from lakework.llm.words import ascii_lowered, gram_hashes, word_bounds, word_hashes

#: Words of a k-gram: as many as the shortest phrase has.
GRAM = 3
#: A template is found where a span holds this share of its k-grams.
COVER = 0.7
#: Diagonals at most this far apart are neighbours; a span ends where the next hit is further away than its template is long.
DRIFT = 4

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: A base phrase counts where it stands word for word, any other template by its cover.
    base: bool = False


#: The base phrases of the scan.
BASE_PHRASES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)
#: Opening words of public license notices.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("lgpl", "under the terms of the gnu lesser general public license"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)
TEMPLATES = BASE_PHRASES + NOTICES


def words_of(text: str) -> list[str]:
    return WORD.findall(text.translate({c: c + 32 for c in range(0x41, 0x5B)}))


def _grams(text: str) -> list[tuple[int, str]]:
    """(hash, words) of each k-gram."""
    hashes = gram_hashes(word_hashes(ascii_lowered(text)), GRAM).astype(np.int64)
    w = words_of(text)
    return [(int(h), " ".join(w[i : i + GRAM])) for i, h in enumerate(hashes)]


def template_positions(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """h, template, at, gram of every k-gram of the templates, and one row that a text's own row (h null) joins."""
    rows = [(False, h, t, i, g) for t, x in enumerate(templates) for i, (h, g) in enumerate(_grams(x.text))]
    return spark.createDataFrame([*rows, (True, 0, -1, 0, "")], "whole boolean, h long, template int, at int, template_gram string")


def text_grams(docs: DataFrame, wanted: frozenset[int], id_col: str, text_col: str) -> DataFrame:
    """A row (whole) for each text, with its number of words, and one for each of its rolling k-grams.

    ``gram`` is the k-gram's words, given where a template may hold it, for the comparison after the join.
    """
    python_workers(docs.sparkSession)
    asked = np.array(sorted(wanted), np.int64)

    def run(batches):
        for b in slices(batches):
            counts, whole, hashes, places, sizes, grams = [], [], [], [], [], []
            for text in b.column(2).to_pylist():
                buf = ascii_lowered(text)
                w = word_hashes(buf)
                h = gram_hashes(w, GRAM).astype(np.int64)
                own: list[str | None] = [None] * (len(h) + 1)
                near = np.flatnonzero(np.isin(h, asked))
                if len(near):
                    begins, ends = word_bounds(buf)
                    for i in near:
                        own[i + 1] = " ".join(buf[begins[j] : ends[j]].tobytes().decode("utf-8") for j in range(i, i + GRAM))
                counts.append(len(h) + 1)
                whole += [[True], np.zeros(len(h), bool)]
                hashes += [[0], h]
                places.append(np.arange(-1, len(h), dtype=np.int32))
                sizes.append(len(w))
                grams += own
            at = pa.array(np.repeat(np.arange(b.num_rows), counts))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(at),
                    b.column(1).take(at),
                    pa.array(np.concatenate(whole).astype(bool)),
                    pa.array(np.concatenate(hashes).astype(np.int64)),
                    pa.array(np.concatenate(places)),
                    pa.array(np.repeat(np.array(sizes, np.int64), counts)),
                    pa.array(grams, pa.string()),
                ],
                ["id", "text_hash", "whole", "h", "pos", "n_words", "gram"],
            )

    t = text_or_empty(text_col)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(t).alias("text_hash"), t.alias("t"))
    return src.mapInArrow(run, "id long, text_hash long, whole boolean, h long, pos int, n_words long, gram string")


def spans(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where templates are found: id, text_hash, n_words, n_rows, template, first, last, votes, cover.

    Every text also has a row with template -1, which carries its words and how many rows repeat it.
    """
    spark = docs.sparkSession
    positions = template_positions(spark, templates)
    wanted = frozenset(h for x in templates for h, _ in _grams(x.text))
    # The templates are a fixed list, so broadcasting their positions is bounded.
    hits = text_grams(docs, wanted, id_col, text_col).join(F.broadcast(positions), ["whole", "h"])
    hits = hits.filter(F.col("whole") | (F.col("gram") == F.col("template_gram")))
    key = ["id", "text_hash", "template"]
    votes = (
        hits.groupBy(*key, (F.col("pos") - F.col("at")).alias("diagonal"), "at")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("n_words").alias("n_words"))
        .groupBy(*key, "diagonal")
        .agg(F.count(F.lit(1)).alias("votes"), F.min("at").alias("lo"), F.max("at").alias("hi"), F.max("rows").alias("rows"), F.max("n_words").alias("n_words"))
    )
    sizes = spark.createDataFrame(
        [(-1, 1, True), *((t, len(words_of(x.text)) - GRAM + 1, x.base) for t, x in enumerate(templates))], "template int, size int, exact boolean"
    )
    votes = votes.join(F.broadcast(sizes), "template").filter(~F.col("exact") | (F.col("votes") == F.col("size")))
    # Neighbouring diagonals merge: same span while the next one is near and begins before the span could end.
    order = Window.partitionBy(*key).orderBy("diagonal")
    begins = F.col("diagonal") + F.col("lo")
    apart = (F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT) | F.col("exact")
    merged = votes.withColumn("span", F.sum(F.coalesce(apart.cast("int"), F.lit(1))).over(order))
    out = merged.groupBy(*key, "size", "exact", "span").agg(
        F.min(begins).alias("first"),
        F.max(F.col("diagonal") + F.col("hi") + GRAM - 1).alias("last"),
        F.sum("votes").alias("votes"),
        F.max("rows").alias("n_rows"),
        F.max("n_words").alias("n_words"),
    )
    cover = F.least(F.col("votes") / F.col("size"), F.lit(1.0))
    return out.withColumn("cover", cover).filter(F.col("exact") | (F.col("cover") >= COVER)).drop("size", "exact", "span")


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    found = spans(docs, templates, id_col, text_col)
    label = F.element_at(F.array(*[F.lit(x.label) for x in templates]), F.col("template") + 1)
    base = F.element_at(F.array(*[F.lit(x.base) for x in templates]), F.col("template") + 1)
    tagged = found.withColumn("label", F.when(F.col("template") >= 0, label)).withColumn("base", F.when(F.col("template") >= 0, base).otherwise(False))
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    out = tagged.groupBy("id", "text_hash").agg(
        F.max(F.when(F.col("template") < 0, F.col("n_words"))).alias("n_words"),
        F.max(F.when(F.col("template") < 0, F.col("n_rows"))).alias("n_rows"),
        F.sum(F.col("base").cast("long")).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).cast("long").alias("last_word"),
        listed(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        listed(F.col("label")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("template") >= 0, F.col("cover"))), F.lit(0.0)).alias("score"),
    )
    repeated = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_rows"))))
    return repeated.select("id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
