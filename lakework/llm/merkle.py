"""Merkle manifest of a dataset by butterfly exchange (operator 11), built-in functions only.

Every row is a leaf.  Leaves are ordered by one range sort (source, then id), so a source that holds a third of the rows
is cut over many tasks, and ranks come from counts by task.  ``FANOUT ** LOCAL`` consecutive leaves of a source make
a partition, the unit of the exchange; the root of its subtree is computed from its leaves.

Then partitions swap roots round by round.  In a round, the (at most 16) neighbouring subtrees of one parent exchange: member j of each subtree meets member j
of the others, and where a subtree has fewer members they stand in for the missing ones in turn.  All members that meet hash the
parent redundantly, so afterwards every partition holds its ancestor and the siblings of that level: no pass goes back down the tree.
A partition sends one short row a round, plus the rows it stands in for.  The rounds first go up within each source,
then over the sources, and end when every partition holds the root.

The proof of a leaf is the siblings within its partition followed by those the partition has gathered.

Edge cases: nulls in any column are hashed as ``-``; an empty text is ``0:``.  A null source is a source, before all others; null
ids come first in their source and are never tampered with.  Rows that repeat an id are ordered by their leaf, so
equal rows have equal leaves and places next to each other.  A table with one row has its leaf for root, and the digest of the empty
string for proof.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakework.llm.common import id_remainder, materialize

#: Nodes that share a parent.
FANOUT = 16
#: Levels of the tree inside a partition: 16**3 = 4,096 leaves.
LOCAL = 3

Names = tuple[str, ...]
#: Columns of a leaf, in order; the first is the id, the second the source, the last the text.
LEAF_COLUMNS: Names = ("doc_id", "source", "lang", "n_chars", "text")


def field(c: Column) -> Column:
    """``-`` for null, else byte count, colon and value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(docs: DataFrame, columns: Names = LEAF_COLUMNS) -> DataFrame:
    """id, source, leaf and tampered (the leaf after the tampering, or null where there is none)."""
    text = F.col(columns[-1]).cast("string")
    fixed = [field(F.col(c)) for c in columns[:-1]]
    changed = F.when(id_remainder(F.col(columns[0]), 5) == 0, digest(*fixed, field(ascii_lower(text))))
    return docs.select(
        F.col(columns[0]).cast("long").alias("id"), F.col(columns[1]).cast("string").alias("source"), digest(*fixed, field(text)).alias("leaf"), changed.alias("tampered")
    )


def ranked(docs: DataFrame, columns: Names = LEAF_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """Leaves with the number of their source and their rank in it (sn, rank, id, leaf, tampered), and the sources (sn, n)."""
    # The salt lets the sort cut even rows that are equal in everything else.
    written = materialize(leaves(docs, columns).withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "merkle-leaves")
    ordered = written.repartitionByRange("source", "id", "leaf", "salt").sortWithinPartitions("source", "id", "leaf", "salt")
    # The upper bits of this number are the task, the lower ones the place in it.
    placed = materialize(ordered.select("*", F.monotonically_increasing_id().alias("at")).drop("salt"), "merkle-order")
    part = F.shiftright("at", 33).alias("part")
    runs = materialize(placed.groupBy(part, "source").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")), "merkle-runs")
    # One row for each task that holds rows of the source.
    of_source = Window.partitionBy("source").orderBy("part")
    before = F.coalesce(F.sum("n").over(of_source.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("*", before.alias("before"), (F.row_number().over(of_source) == 1).alias("opens"))
    # Sources are numbered like the leaves: those that open in a task, after all that open in earlier tasks.
    opened = runs.filter("opens").groupBy("part").agg(F.count(F.lit(1)).alias("k"))
    earlier = F.sum("k").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    opened = opened.select(F.col("part").alias("p"), F.coalesce(earlier, F.lit(0)).alias("earlier"))
    numbers = runs.filter("opens").join(opened, F.col("part") == F.col("p"))
    numbers = numbers.select(
        F.col("source").alias("s"), (F.col("earlier") + F.row_number().over(Window.partitionBy("part").orderBy("first")) - 1).cast("long").alias("sn")
    )
    runs = materialize(runs.join(numbers, F.col("source").eqNullSafe(F.col("s"))).drop("s"), "merkle-places")
    sources = runs.groupBy("sn").agg(F.sum("n").alias("n"))
    key = runs.select(F.col("part").alias("p"), F.col("source").alias("s"), "first", "before", "sn")
    rows = placed.withColumn("part", part).join(key, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
    return rows.select("sn", (F.col("at") - F.col("first") + F.col("before")).alias("rank"), "id", "leaf", "tampered"), sources


def _height(n: Column, top: int) -> Column:
    """Levels above the leaves of a tree with ``n`` leaves (0 for one leaf)."""
    return sum((F.when(n > FANOUT**k, 1).otherwise(0) for k in range(top)), F.lit(0))


def _levels(n: int) -> int:
    h = 0
    while FANOUT**h < n:
        h += 1
    return h


def _parents(nodes: Column) -> Column:
    """Digests of each run of FANOUT nodes of an array."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / F.lit(FANOUT)).cast("int") - 1)
    return F.transform(runs, lambda k: F.sha2(F.array_join(F.slice(nodes, k * FANOUT + 1, FANOUT), "").cast("binary"), 256))


def _subtree(top: Column) -> list[Column]:
    """Expressions of the levels l0 (leaves), l1, ..., each from the one before; ``top`` levels exist, the rest repeat the last."""
    return [F.when(F.lit(k) <= top, _parents(F.col(f"l{k - 1}"))).otherwise(F.col(f"l{k - 1}")).alias(f"l{k}") for k in range(1, LOCAL + 1)]


def _partitions(rows: DataFrame, sources: DataFrame, top: int) -> DataFrame:
    """One row per partition: sn, block, n, height, docs (its leaves in order) and the levels l0, l1, ... of its subtree."""
    of = (F.col("rank") / F.lit(FANOUT**LOCAL)).cast("long").alias("block")
    held = rows.groupBy("sn", of).agg(F.sort_array(F.collect_list(F.struct("rank", "id", "leaf", "tampered"))).alias("docs"))
    tree = held.join(sources, "sn").withColumns({"height": _height(F.col("n"), top), "l0": F.col("docs.leaf")})
    for level in _subtree(F.least(F.col("height"), F.lit(LOCAL))):
        tree = tree.select("*", level)
    return tree


def _siblings(nodes: Column, at: Column) -> tuple[Column, Column]:
    """Digests before and after node ``at`` in its run of FANOUT nodes, each joined to one text."""
    begin = at - at % FANOUT
    return (
        F.array_join(F.slice(nodes, begin + 1, at % FANOUT), ""),
        F.array_join(F.slice(nodes, at + 2, F.lit(FANOUT - 1) - at % FANOUT), ""),
    )


def _round(state: DataFrame) -> DataFrame:
    """One exchange.

    ``state``: sn, block, anc (the partition's ancestor), up (siblings gathered: before, after), further columns, and
    the layout of this round: k1, k2 (the parent), child (0..15), idx and m (the member's number in its subtree and
    their count), most (the largest count among the siblings).  A partition that sits out has ``most`` null.
    """
    stands_in = F.when(F.col("most") > F.col("m"), F.sequence(F.col("idx"), F.col("most") - 1, F.col("m"))).otherwise(F.array("idx"))
    own = [c for c in state.columns if c not in ("k1", "k2", "child", "idx", "m", "most", "anc")]
    sent = state.select("k1", "k2", "child", "idx", "anc", F.col("most").isNotNull().alias("live"), F.struct(*own).alias("own"), F.explode(stands_in).alias("lane"))
    # Only the member itself takes its own columns along; where it stands in, the digest is enough.
    sent = sent.withColumn("own", F.when(F.col("lane") == F.col("idx"), F.col("own")))
    met = sent.groupBy("k1", "k2", "lane", "live").agg(F.sort_array(F.collect_list(F.struct("child", "anc", "own"))).alias("all"))
    met = met.withColumn("parent", F.when(F.col("live"), F.sha2(F.array_join("all.anc", "").cast("binary"), 256)).otherwise(F.col("all")[0]["anc"]))
    out = met.select("live", "parent", F.col("all.anc").alias("nodes"), F.posexplode("all").alias("at", "one")).filter("one.own IS NOT NULL")
    before, after = _siblings(F.col("nodes"), F.col("at"))
    gathered = F.when(F.col("live"), F.concat(F.col("one.own.up"), F.array(F.struct(before.alias("before"), after.alias("after")))))
    return out.select(
        *[F.col(f"one.own.{c}").alias(c) for c in own if c != "up"], F.col("parent").alias("anc"), F.coalesce(gathered, F.col("one.own.up")).alias("up")
    )


def _within(state: DataFrame, r: int) -> DataFrame:
    """Layout of round ``r`` within sources: members are numbered along the source."""
    below = FANOUT**r
    node = (F.col("block") / F.lit(below)).cast("long")
    parent = (F.col("block") / F.lit(below * FANOUT)).cast("long")
    live = F.col("height") > LOCAL + r
    members = F.least(F.lit(below).cast("long"), F.col("blocks") - node * below)
    # The first subtree of a parent is never smaller than the others.
    most = F.least(F.lit(below).cast("long"), F.col("blocks") - parent * (below * FANOUT))
    return state.withColumns(
        {
            "k1": F.col("sn"),
            "k2": F.when(live, parent).otherwise(F.col("block")),
            "child": F.when(live, node % FANOUT).otherwise(F.lit(0).cast("long")),
            "idx": F.when(live, F.col("block") % below).otherwise(F.lit(0).cast("long")),
            "m": F.when(live, members).otherwise(F.lit(1).cast("long")),
            "most": F.when(live, most),
        }
    )


def _layout(sources: DataFrame, levels: int) -> DataFrame:
    """sn and lay: for each level over the sources (m: members of the node, off: those of its siblings before it, most)."""
    lay = sources.select("sn", F.col("sn").alias("node"), F.array().cast("array<struct<m:bigint,off:bigint,most:bigint>>").alias("lay"))
    nodes = sources.select(F.col("sn").alias("node"), F.col("blocks").alias("m"))
    for _ in range(levels):
        run = Window.partitionBy((F.col("node") / F.lit(FANOUT)).cast("long"))
        off = F.coalesce(F.sum("m").over(run.orderBy("node").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        level = nodes.select("node", F.struct("m", off.cast("long").alias("off"), F.max("m").over(run).alias("most")).alias("one"))
        lay = lay.join(level, "node").select("sn", (F.col("node") / F.lit(FANOUT)).cast("long").alias("node"), F.concat("lay", F.array("one")).alias("lay"))
        nodes = nodes.groupBy((F.col("node") / F.lit(FANOUT)).cast("long").alias("node")).agg(F.sum("m").alias("m"))
    return lay.drop("node")


def _across(state: DataFrame, r: int) -> DataFrame:
    """Layout of round ``r`` over the sources; ``member`` is the partition's number in its node."""
    node = (F.col("sn") / F.lit(FANOUT**r)).cast("long")
    here = F.col("lay")[r]
    return state.withColumns(
        {
            "k1": F.lit(-1).cast("long"),
            "k2": (F.col("sn") / F.lit(FANOUT ** (r + 1))).cast("long"),
            "child": node % FANOUT,
            "idx": F.col("member"),
            "m": here["m"],
            "most": here["most"],
            "member": F.col("member") + here["off"],
        }
    )


def manifest(docs: DataFrame, columns: Names = LEAF_COLUMNS) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root, proof_sha256, folded_root, verified, and its place (sn, rank)."""
    rows, sources = ranked(docs, columns)
    rows = materialize(rows, "merkle-ranks")
    sources = materialize(sources.withColumn("blocks", F.ceil(F.col("n") / F.lit(FANOUT**LOCAL)).cast("long")), "merkle-sources")
    size = sources.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("k")).first()
    top, over = _levels(size["n"]), _levels(size["k"])
    held = _partitions(rows, sources.drop("blocks"), top)
    up = F.array().cast("array<struct<before:string,after:string>>")
    state = held.join(sources.select("sn", "blocks"), "sn").select("sn", "block", "height", "blocks", F.col(f"l{LOCAL}")[0].alias("anc"), up.alias("up"))
    state = materialize(state, "merkle-roots")
    for r in range(top - LOCAL):
        state = _round(_within(state, r))
    state = state.select("sn", "block", "anc", "up", F.col("anc").alias("subroot"), F.col("block").alias("member"))
    state = state.join(_layout(sources, over), "sn")
    for r in range(over):
        state = _round(_across(state, r))
    proofs = materialize(state.select("sn", "block", "subroot", F.col("anc").alias("root"), "up"), "merkle-proofs")
    tree = held.join(proofs, ["sn", "block"])
    return tree.select("sn", "subroot", "root", F.inline(_proved())).select(
        "id", "leaf", "subroot", "root", "proof_sha256", "folded_root", F.col("folded_root").eqNullSafe(F.col("root")).alias("verified"), "sn", "rank"
    )


def _proved() -> Column:
    """For each leaf of a partition: its place, proof and the root recomputed from it."""
    steps = F.least(F.col("height"), F.lit(LOCAL))

    def own(at: Column) -> Column:
        """Siblings of the leaf at ``at``, level by level inside the partition."""
        levels = []
        for k in range(LOCAL):
            before, after = _siblings(F.col(f"l{k}"), F.floor(at / F.lit(FANOUT**k)).cast("int"))
            levels.append(F.when(F.lit(k) < steps, F.struct(before.alias("before"), after.alias("after"))))
        return F.filter(F.array(*levels), lambda s: s.isNotNull())

    def proved(doc: Column, at: Column) -> Column:
        # An array of one element serves as a local name: the path is built once.
        return F.transform(
            F.array(F.concat(own(at), F.col("up"))),
            lambda path: F.struct(
                doc["rank"].alias("rank"),
                doc["id"].alias("id"),
                doc["leaf"].alias("leaf"),
                F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "").cast("binary"), 256).alias("proof_sha256"),
                F.aggregate(path, F.coalesce(doc["tampered"], doc["leaf"]), lambda h, s: digest(s["before"], h, s["after"])).alias("folded_root"),
            ),
        )[0]

    return F.transform("docs", proved)


def tampered_rows(docs: DataFrame, columns: Names = LEAF_COLUMNS) -> DataFrame:
    """Rows of the manifest whose recomputed root is not the root."""
    return manifest(docs, columns).filter(~F.col("verified"))
