"""Near duplicates by ProbMinHash (operator 5).

A text is the set of its five-word shingles, each of weight 1, as links compare sets.  Each
shingle's arrivals form a Poisson process with its weight as rate; a register
keeps the shingle that arrives first, and a text's arrivals stop as soon as
they are later than all its registers.  Two texts share a register with the
probability Jaccard similarity of their weighted shingles (for equal weights
the plain Jaccard similarity).  Registers are banded; texts that share a band
are candidates, and a candidate pair is a link if the Jaccard similarity of its shingle
sets, computed exactly, is at least ``SIMILARITY``.  Classes are the connected
components of the links.

Texts with the same words are one node of the graph.  In a band's bucket every
text is first compared with one pivot only, the text that meets most others; buckets whose texts are one component
then are done.  In the end the pairs of different components that are left in a
bucket are all compared, first by sketches, which refuse no similar pair, then in
full, so that no pair is left out.

Edge cases: words are runs of ASCII letters and digits or non-ASCII characters,
in lower case; a text of fewer than five words has one shingle, all its words;
a text without words (null, empty) is never linked.  A null id takes part and
counts as the largest; a class of null ids has a null class_id.  Rows that
repeat an id are handled alike.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakework.llm.common import lean, materialize, slices, python_workers, text_or_empty
from lakework.llm.graph import components
from lakework.llm.words import gram_hashes, lowered, mix, word_hashes
from lakework.operators.common import top1

WORDS = 5
SIMILARITY = 0.8
#: 25 bands of 5 registers find a pair of similarity 0.8 with probability 0.99995.
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Size of a parity sketch.
SKETCH_BITS = 10
SKETCH_LONGS = (1 << SKETCH_BITS) // 64
#: Pivot rounds end when the pairs left are at most this many for each place of a
#: text in a bucket, or when a round leaves more than half of them.
PAIRS_EACH = 200
_U = np.uint64


def shingles(text: str) -> tuple[np.ndarray, bytes | None]:
    """Hashes of the shingles in order, and a fingerprint of the word sequence (None without words)."""
    words = word_hashes(lowered(text))
    if not len(words):
        return words, None
    return gram_hashes(words, min(WORDS, len(words))), hashlib.blake2b(words.tobytes(), digest_size=16).digest()


def _waits(h: np.ndarray, i: int, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The i-th waiting time of each shingle's process, and the register that arrival falls to."""
    r = mix(h + _U((i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    wait = -np.log(((r >> _U(11)).astype(float) + 0.5) / (1 << 53)) / weight
    return wait, (mix(r + _U(1)) % _U(REGISTERS)).astype(np.int64)


def registers(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """ProbMinHash registers of weighted sets (distinct hashes, weights), one row each; all texts of a batch advance together."""
    n = len(sets)
    h = np.concatenate([s for s, _ in sets])
    weight = np.concatenate([w for _, w in sets])
    owner = np.repeat(np.arange(n), [len(s) for s, _ in sets])
    first = np.full(n * REGISTERS, np.inf)
    kept = np.zeros(n * REGISTERS, _U)
    latest = np.full(n, np.inf)
    time, i = np.zeros(len(h)), 0
    while len(h):
        wait, register = _waits(h, i, weight)
        time = time + wait
        # Early termination: later than every register of its text.
        live = time < latest[owner]
        h, weight, owner, time, register = h[live], weight[live], owner[live], time[live], register[live]
        place = owner * REGISTERS + register
        np.minimum.at(first, place, time)
        won = first[place] == time
        kept[place[won]] = h[won]
        texts = np.unique(owner)
        latest[texts] = first.reshape(n, REGISTERS)[texts].max(axis=1)
        i += 1
    return kept.reshape(n, REGISTERS)


def band_keys(kept: np.ndarray) -> np.ndarray:
    """A hash of each band's registers, different for different bands."""
    key = np.tile(mix(np.arange(1, BANDS + 1).astype(_U)), (len(kept), 1))
    for r in range(ROWS):
        key = mix(key + kept.reshape(len(kept), BANDS, ROWS)[:, :, r])
    return key.astype(np.int64)


def parity(grams: np.ndarray) -> np.ndarray:
    """Parity sketch of a set of hashes: bit k is the parity of the number of them that fall to k."""
    odd = np.bincount((grams >> _U(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def maybe_alike(a: str, b: str) -> Column:
    """Whether two sets may be ``SIMILARITY`` alike, by sizes (n) and sketches: no pair that is gets refused.

    Sketches differ in no more bits than the sets in elements, and sets of this
    similarity differ in at most (1 - s) / (1 + s) of their summed sizes.
    """
    na, nb = F.col(f"n{a}"), F.col(f"n{b}")
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"s{a}")[i].bitwiseXOR(F.col(f"s{b}")[i])) for i in range(SKETCH_LONGS)])
    return (F.least(na, nb) >= F.lit(SIMILARITY) * F.greatest(na, nb)) & (apart <= F.lit((1 - SIMILARITY) / (1 + SIMILARITY) + 1e-9) * (na + nb))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text_hash, node (fingerprint of the words, null without words), bands, n and sketch (of the shingle set) of every row."""
    python_workers(docs.sparkSession)

    def run(batches):
        for b in slices(batches):
            nodes, sets, at, sizes, sketches = [], [], [], [], []
            for i, text in enumerate(b.column(2).to_pylist()):
                grams, node = shingles(text)
                own = np.unique(grams)
                nodes.append(node)
                sizes.append(len(own))
                sketches.append(parity(own) if node is not None else None)
                if node is not None:
                    sets.append((own, np.ones(len(own))))
                    at.append(i)
            keys: list[np.ndarray | None] = [None] * b.num_rows
            if sets:
                for i, k in zip(at, band_keys(registers(sets))):
                    keys[i] = k
            yield pa.RecordBatch.from_arrays(
                [
                    *b.columns[:2],
                    pa.array(nodes, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(sizes, pa.int32()),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                ["id", "text_hash", "node", "bands", "n", "sketch"],
            )

    t = text_or_empty(text_col)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(t).alias("text_hash"), t.alias("t"))
    return src.mapInArrow(lean(run), "id long, text_hash long, node binary, bands array<long>, n int, sketch array<long>")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """node and its sorted distinct shingle hashes, of (node, t)."""
    python_workers(texts.sparkSession)

    def run(batches):
        for b in slices(batches):
            sets = [np.unique(shingles(t)[0]).astype(np.int64) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "grams"])

    return texts.select("node", "t").mapInArrow(lean(run), "node binary, grams array<long>")


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets are at least ``SIMILARITY`` alike."""
    left, right = sets.toDF("a", "ga"), sets.toDF("b", "gb")
    shared = F.size(F.array_intersect("ga", "gb"))
    alike = shared >= F.lit(SIMILARITY) * (F.size("ga") + F.size("gb") - shared)
    small, large = F.least(F.size("ga"), F.size("gb")), F.greatest(F.size("ga"), F.size("gb"))
    return pairs.join(left, "a").join(right, "b").filter((small >= F.lit(SIMILARITY) * large) & alike).select("a", "b")


def _crowding(members: DataFrame) -> DataFrame:
    """Members of buckets with more than one component, with how many of their bucket are in another one (others)."""
    own = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("own"))
    whole = own.groupBy("bucket").agg(F.sum("own").alias("whole"))
    others = own.join(whole, "bucket").select("bucket", "label", (F.col("whole") - F.col("own")).alias("others")).filter("others > 0")
    return materialize(members.join(materialize(others, "buckets"), ["bucket", "label"]), "members")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text_hash, class_id (smallest id of its class), class_size, kept."""
    # Most texts and bands have no partner; Spark's Bloom filters keep them out of the shuffles of the
    # two joins with the (smaller) tables of those that have, here from smaller scans on than by default.
    docs.sparkSession.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "1MB")
    docs.sparkSession.conf.set("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", "256MB")
    rows = materialize(signatures(docs, id_col, text_col), "signatures")
    nodes = top1(rows.filter("node is not null"), ["node"], [F.col("id").asc_nulls_last(), F.col("text_hash")])
    dealt = nodes.select("node", F.explode("bands").alias("bucket"))
    crowded = materialize(dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets").filter("n > 1")
    members = materialize(dealt.join(crowded, "bucket", "left_semi").select("bucket", "node", F.col("node").alias("label")), "members")

    # Shingle sets of the texts that are candidates at all, one text of each node.
    wanted = members.select("node").distinct().join(nodes.select("node", "id", "text_hash", "n"), "node")
    wanted = materialize(wanted.select("node", F.col("id").alias("__id"), "text_hash", "n"), "candidates").filter("n > 0")
    t = text_or_empty(text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(t).alias("h"), t.alias("t"))
    found = texts.join(wanted, F.col("id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("text_hash")))
    sets = materialize(shingle_sets(found.select("node", "t")).dropDuplicates(["node"]), "shingles")

    sketches = materialize(members.select("node").distinct().join(nodes.select("node", "n", "sketch"), "node"), "sketches")
    labels, linked, before = None, None, None
    while True:
        members = _crowding(members.select("bucket", "node", "label"))
        left = members.agg(F.sum("others").alias("pairs"), F.count(F.lit(1)).alias("rows")).first()
        if not left["rows"]:
            break
        last = left["pairs"] <= 2 * PAIRS_EACH * left["rows"] or (before is not None and left["pairs"] > before / 2)
        if before is None and left["pairs"] > 2 * left["rows"]:
            last = False
        before = left["pairs"]
        known = members.join(sketches, "node")
        one, other = (known.select("bucket", *(F.col(c).alias(f"{c[0]}{x}") for c in ("label", "n", "sketch")), F.col("node").alias(x)) for x in "ab")
        if last:
            pairs = one.join(other, (one["bucket"] == other["bucket"]) & (F.col("la") < F.col("lb")) & maybe_alike("a", "b"))
        else:
            # The texts that meet most others elsewhere are likely originals of many copies.
            central = materialize(members.groupBy(F.col("node").alias("b")).agg(F.sum("others").alias("weight")), "weights")
            order = Window.partitionBy("bucket").orderBy(F.desc("weight"), "b")
            top = other.join(central, "b").withColumn("no", F.row_number().over(order)).filter(F.col("no") == 1)
            pivots = materialize(top.select(*other.columns), "pivots")
            pairs = one.join(pivots, (one["bucket"] == pivots["bucket"]) & (F.col("la") != F.col("lb")) & maybe_alike("a", "b"))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        new = materialize(links(materialize(pairs, "pairs"), sets), "links")
        linked = new if linked is None else linked.unionByName(new)
        labels = components(linked)
        if last:
            break
        # A pivot has met its whole bucket.
        open_ = members.join(pivots.select("bucket", F.col("b").alias("node")), ["bucket", "node"], "left_anti").select("bucket", "node")
        moved = open_.join(labels.withColumnRenamed("label", "to"), "node", "left").select("bucket", "node", F.coalesce("to", "node").alias("label"))
        members = materialize(moved, "members")
    if labels is None:
        labels = nodes.select("node", F.col("node").alias("label")).limit(0)

    of = rows.select("id", "text_hash", "node").join(labels, "node", "left").select("id", "text_hash", F.coalesce("label", "node").alias("label"))
    of = materialize(of, "labelled")
    groups = of.filter("label is not null").groupBy("label").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    several = materialize(groups.filter("class_size > 1"), "classes")
    out = of.join(several, "label", "left")
    alone = F.col("class_size").isNull()
    class_id = F.when(alone, F.col("id")).otherwise(F.col("class_id"))
    return out.select(
        "id", "text_hash", class_id.alias("class_id"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), F.col("id").eqNullSafe(class_id).alias("kept")
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns."""
    key = F.xxhash64(text_or_empty(text_col))
    others = [F.col(c).cast("string") for c in docs.columns if c != id_col]
    one = top1(docs.withColumn("__h", key), [id_col, "__h"], others)
    kept = classes(docs, id_col, text_col).filter("kept").select(F.col("id").alias("__id"), F.col("text_hash").alias("__th"))
    on = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__th"))
    return one.join(kept, on, "left_semi").select(*docs.columns)
