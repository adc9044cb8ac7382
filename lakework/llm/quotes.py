"""Chat formatting by quotation linking (operator 7).

A message's lines are parsed into nested quote levels (leading ``>`` marks);
consecutive lines of a level are a passage.  Quoted passages and the messages' own passages
are normalised and hashed: whole, by paragraph, by sentence and by line, on both sides.  A join inside the conversation links each quotation to the
first earlier message that says it, by the whole passage or else by its first part that matches, so a quotation may begin and
end at any sentence or line and be wrapped anew.
Messages then follow what they reply to, without the quotations.

Order: a message replies to the message that its least nested, first
linked quotation stands in; one without a linked quotation starts a thread at its own turn.
Sorting a conversation by root_turn, depth, turn gives its reply order.

Edge cases: null text counts as empty; a null conv_id or turn links to nothing.
Rows that repeat a message agree; a quotation of nothing earlier is
removed but links to nothing.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakework.llm.common import materialize, slices, python_workers, text_or_empty

MARKS = re.compile(r"[ \t]*((?:>[ \t]?)*)")
#: A line that only announces a quotation ("On ..., X wrote:") goes with it.
ATTRIBUTION = re.compile(r"(?i)^\s*(on\b.*\bwrote|.*\b(wrote|schrieb|écrit|escribió))\s*:\s*$")
#: Single lines and sentences of a longer passage or message identify nothing with fewer bytes, normalised; whole ones
#: and whole paragraphs always do.
LEAST_BYTES = 8
#: A sentence ends behind its mark and white space, or behind a full-width mark.
SENTENCE = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？])")


def normalised(text: str) -> str:
    return " ".join(re.findall(r"\w+", text.casefold()))


def passages(text: str) -> list[tuple[int, list[str]]]:
    """(quote level, lines without marks) of each run of lines of one level; blank lines end no run of their level."""
    out: list[tuple[int, list[str]]] = []
    for line in text.splitlines():
        m = MARKS.match(line)
        level = m.group(1).count(">")
        rest = line[m.end() :] if level else line
        if out and (out[-1][0] == level or not line.strip()):
            out[-1][1].append(rest)
        else:
            out.append((level, [rest]))
    return out


def _key(text: str, least: int = 1) -> bytes | None:
    n = normalised(text).encode("utf-8", "surrogatepass")
    return hashlib.blake2b(n, digest_size=16).digest() if len(n) >= least else None


def unquoted(parts: list[tuple[int, list[str]]]) -> str:
    """A message's own lines; announcements in front of a quotation go too."""
    kept: list[str] = []
    for i, (level, lines) in enumerate(parts):
        if level == 0:
            own = list(lines)
            while i + 1 < len(parts) and own and (not own[-1].strip() or ATTRIBUTION.match(own[-1])):
                announced = bool(ATTRIBUTION.match(own[-1]))
                own.pop()
                if announced:
                    break
            kept += own
    return "\n".join(kept).strip()


def units(lines: list[str]) -> list[bytes]:
    """Keys of a passage, most telling first: of the whole, its paragraphs, their sentences, its lines."""
    paragraphs: list[list[str]] = [[]]
    for line in lines:
        if line.strip():
            paragraphs[-1].append(line)
        elif paragraphs[-1]:
            paragraphs.append([])
    joined = [" ".join(p) for p in paragraphs if p]
    keys = [_key(" ".join(joined)), *map(_key, joined)]
    keys += [_key(sentence, LEAST_BYTES) for p in joined for sentence in SENTENCE.split(p)]
    keys += [_key(line, LEAST_BYTES) for line in lines]
    return list(dict.fromkeys(k for k in keys if k))


def parse(text: str) -> tuple[str, list[tuple[int, int, int, bytes]], list[bytes]]:
    """Own text; keys of its quotations as (level, passage, rank, key); keys of what it says itself."""
    parts = passages(text)
    quoted = [(level, i, rank, k) for i, (level, lines) in enumerate(parts) if level for rank, k in enumerate(units(lines))]
    own = unquoted(parts)
    return own, quoted, sorted(units(own.split("\n")))


PARSED = "conv_id long, turn long, role string, body string, quoted array<struct<level:int,passage:int,rank:int,key:binary>>, said array<binary>"


def parsed(messages: DataFrame) -> DataFrame:
    """Every message with its own text (body) and the keys of what it quotes and says."""
    python_workers(messages.sparkSession)
    kind = pa.list_(pa.struct([("level", pa.int32()), ("passage", pa.int32()), ("rank", pa.int32()), ("key", pa.binary())]))

    def run(batches):
        for b in slices(batches):
            got = [parse(t) for t in b.column(3).to_pylist()]
            quoted = [[dict(zip(("level", "passage", "rank", "key"), q)) for q in g[1]] for g in got]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([g[0] for g in got], pa.string()), pa.array(quoted, kind), pa.array([g[2] for g in got], pa.list_(pa.binary()))],
                ["conv_id", "turn", "role", "body", "quoted", "said"],
            )

    src = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), text_or_empty().alias("t"))
    return src.mapInArrow(run, PARSED)


def linked(rows: DataFrame) -> DataFrame:
    """conv_id, turn, reply_to of every message with a quotation of an earlier one.

    What a conversation says is reduced to the first turn that says it before the
    join, so a line that very many messages hold is one row on that side.
    """
    quotes = materialize(rows.select("conv_id", "turn", F.explode("quoted").alias("q")).select("conv_id", "turn", "q.*"), "quotations")
    asked = quotes.select("conv_id", "key").distinct()
    said = rows.select("conv_id", "turn", F.explode("said").alias("key")).groupBy("conv_id", "key").agg(F.min("turn").alias("origin"))
    origins = materialize(said.join(asked, ["conv_id", "key"], "left_semi"), "origins")
    hits = quotes.join(origins, ["conv_id", "key"]).filter("origin < turn")
    return hits.groupBy("conv_id", "turn").agg(F.min(F.struct("level", "passage", "rank", "origin")).alias("best")).select("conv_id", "turn", F.col("best.origin").alias("reply_to"))


def threads(links: DataFrame) -> DataFrame:
    """conv_id, turn, reply_to, root_turn, depth of every linked message: replies are followed by doubling."""
    state = materialize(links.select("conv_id", "turn", "reply_to", F.col("reply_to").alias("root_turn"), F.lit(1).alias("depth")), "threads")
    while True:
        up = state.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("further"), F.col("depth").alias("more"))
        step = state.join(up, ["conv_id", "root_turn"], "left")
        if step.filter("further is not null").isEmpty():
            return state
        state = materialize(
            step.select(
                "conv_id", "turn", "reply_to", F.coalesce("further", "root_turn").alias("root_turn"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
            ),
            "threads",
        )


def reply_order(messages: DataFrame) -> DataFrame:
    """Every message: conv_id, turn, role, body (without quotations), n_quotes, reply_to, root_turn, depth."""
    rows = materialize(parsed(messages), "messages")
    found = threads(linked(rows)).withColumnsRenamed({"conv_id": "__c", "turn": "__t"})
    out = rows.join(found, (F.col("conv_id") == F.col("__c")) & (F.col("turn") == F.col("__t")), "left")
    passages_ = F.size(F.array_distinct(F.transform("quoted", lambda q: q["passage"])))
    return out.select(
        "conv_id", "turn", "role", "body", passages_.cast("long").alias("n_quotes"), "reply_to", F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth")
    )
