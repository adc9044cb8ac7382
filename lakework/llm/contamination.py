"""Benchmark decontamination by Wu-Manber multi-pattern search (operator 13).

A pattern is a window of consecutive benchmark words.  A machine holds the patterns of one length class: a shift table
tells, by the block of words at the end of the current window, how far the search may move without passing an
occurrence; where it may not move at all, the bucket of that block lists the patterns that end with it, and each is
compared word by word.

The benchmark is a stated query set: it is searched in blocks of at most ``BLOCK_WINDOWS`` windows, each block against
all whole texts, so the memory of a task does not grow with the benchmark.  Documents never leave their tasks; only
the places found do.

Edge cases: null text and text without words have no words, no hits and the digest of the empty list.  An item
without words (or null) has no window and occurs nowhere; an item of fewer words than a window is one window.  Items
that repeat a text all count; rows that repeat an item id count as one item.  The windows of an item whose id is null hit
words, but no id is listed or counted for it.  Rows that repeat id and text give the same result each.  An empty table of
documents gives an empty result, an empty benchmark no hits; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakework.llm.common import python_workers, slices, text_or_empty

#: Words of a window, words of a block (of the shift table and of the buckets).
WINDOW = 10
BLOCK_WORDS = 3
#: Windows that one pass over the documents searches for.
BLOCK_WINDOWS = 100_000

#: Words of lower-cased UTF-8: runs of ASCII digits, ASCII letters and bytes of other characters.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))

Item = tuple[int | None, list[bytes]]


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased."""
    return WORD.findall((text or "").encode("utf-8").translate(LOWER))


class Machine:
    """Shift table and suffix buckets of patterns with at least ``least`` words."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set]):
        self.least = least = min(map(len, patterns))
        self.block = block = min(BLOCK_WORDS, least)
        self.far = least - block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list[tuple[list[bytes], set]]] = defaultdict(list)
        for pattern, items in patterns.items():
            # Only the first ``least`` words of a pattern steer the search.
            for end in range(block, least + 1):
                key = pattern[end - block : end]
                self.shift[key] = min(self.shift.get(key, self.far), least - end)
            self.buckets[pattern[least - block : least]].append((list(pattern), items))

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, int, set]]:
        """(first word, word after the last, items) of every occurrence of every pattern."""
        at, n, least, block = self.least, len(words), self.least, self.block
        shift, far = self.shift, self.far
        while at <= n:
            key = tuple(words[at - block : at])
            step = shift.get(key, far)
            if step:
                at += step
                continue
            begin = at - least
            for pattern, items in self.buckets[key]:
                if words[begin : begin + len(pattern)] == pattern:
                    yield begin, begin + len(pattern), items
            at += 1


def machines(items: Iterable[Item], window: int = WINDOW) -> list[Machine]:
    """One machine for full windows and one for the texts shorter than a window."""
    full: dict[tuple[bytes, ...], set] = defaultdict(set)
    short: dict[tuple[bytes, ...], set] = defaultdict(set)
    for item, words in items:
        for i in range(max(len(words) - window + 1, 1)):
            pattern = tuple(words[i : i + window])
            if pattern:
                (full if len(pattern) == window else short)[pattern].add(item)
    return [Machine(p) for p in (full, short) if p]


def blocks(items: Iterable[Item], size: int = BLOCK_WINDOWS, window: int = WINDOW) -> Iterator[list[Item]]:
    """Items in lists of at most ``size`` windows; an item with more is cut into parts that share ``window`` - 1 words."""
    out: list[Item] = []
    room = size
    for item, words in items:
        at = 0
        while True:
            n = max(len(words) - at - window + 1, 1)
            took = min(n, room)
            out.append((item, words[at : at + took + window - 1]))
            room -= took
            at += took
            if not room:
                yield out
                out, room = [], size
            if took == n:
                break
    if out:
        yield out


def _scan(docs: DataFrame, block: list[Item], window: int) -> DataFrame:
    """id, text_hash, n_words, spans and items of every document, for one block of items."""

    def run(batches):
        found = machines(block, window)
        for b in slices(batches):
            n_words, spans, items = [], [], []
            for text in b.column(2).to_pylist():
                words = words_of(text)
                n_words.append(len(words))
                places: list[dict] = []
                ids: set = set()
                # Overlapping occurrences merge, so that a text that repeats a pattern everywhere stays one span.
                for begin, end, owners in sorted((o for m in found for o in m.occurrences(words)), key=lambda o: o[:2]):
                    ids |= owners
                    if places and begin <= places[-1]["e"]:
                        places[-1]["e"] = max(places[-1]["e"], end)
                    else:
                        places.append({"b": begin, "e": end})
                spans.append(places)
                items.append(sorted(ids - {None}))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array(n_words, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("b", pa.int32()), ("e", pa.int32())]))),
                    pa.array(items, pa.list_(pa.int64())),
                ],
                ["id", "text_hash", "n_words", "spans", "items"],
            )

    return docs.mapInArrow(run, "id long, text_hash long, n_words long, spans array<struct<b int, e int>>, items array<long>")


def occurrences(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """One row per distinct row (id, text) of ``docs``: id, text_hash, n_words, n_rows (how often it stands there), spans (disjoint,
    ordered, first word and word after the last) and items (ordered ids of the items found)."""
    python_workers(docs.sparkSession)
    t = text_or_empty(text_col)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(t).alias("text_hash"), t.alias("t"))
    rows = benchmark.select(F.col(item_col).cast("long"), F.col(item_text_col).cast("string")).toLocalIterator()
    read = ((item, words) for item, text in rows if (words := words_of(text)))
    passes = [_scan(src, block, window).withColumn("n_pass", F.lit(k)) for k, block in enumerate(blocks(read, block_windows, window))]
    if not passes:
        passes = [_scan(src, [], window).withColumn("n_pass", F.lit(0))]
    rows_of_all = passes[0]
    for one in passes[1:]:
        rows_of_all = rows_of_all.unionAll(one)
    # Rows that repeat are equal within a pass: one of each is enough, and their number.
    each = rows_of_all.groupBy("id", "text_hash", "n_pass").agg(
        F.first("n_words").alias("n_words"), F.first("spans").alias("spans"), F.first("items").alias("items"), F.count(F.lit(1)).alias("n_rows")
    )
    if len(passes) > 1:
        each = each.groupBy("id", "text_hash").agg(
            F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.first("n_rows").alias("n_rows"),
        )
    return each.select("id", "text_hash", "n_words", "n_rows", _disjoint("spans").alias("spans"), "items")


def _disjoint(spans: str):
    """Ordered spans, those that touch or overlap merged."""
    return F.expr(f"""
        aggregate({spans}, cast(array() AS array<struct<b int, e int>>), (got, s) ->
            CASE WHEN size(got) > 0 AND s.b <= element_at(got, -1).e
                 THEN concat(slice(got, 1, size(got) - 1), array(named_struct('b', element_at(got, -1).b, 'e', greatest(element_at(got, -1).e, s.e))))
                 ELSE concat(got, array(s)) END)""")


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = occurrences(docs, benchmark, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["e"] - s["b"])
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    out = found.select(
        "id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("n_rows"))).alias("copy"),
    )
    return out.drop("copy")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark, with all their columns."""
    found = occurrences(docs, benchmark, id_col, text_col, **options).filter(F.size("spans") > 0)
    # Equal texts hold the same windows, so the id is enough unless one id has several texts: compare both.
    hit = found.select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"))
    on = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text_or_empty(text_col)) == F.col("__hash"))
    return docs.join(hit, on, "left_anti")

