"""Best-fit packing by linear grouping (operator 4).

Documents are encoded, cut into pieces of at most ``capacity`` ids, and packed
into sequences.  The plan needs only how many pieces there are of each length,
at most ``capacity`` numbers, and is made on the driver from these:

1. lengths above ``capacity / SMALL`` form groups of equal cardinality, each
   rounded up to its longest;
2. the configurations of these few rounded sizes are optimised by column
   generation (a linear programme over the group sizes, priced by an integer
   knapsack), then rounded down; what is left over is packed best-fit decreasing;
3. actual lengths are substituted group by group, longest first;
4. small pieces go best-fit into what the substitution left open;
5. while the plan needs more sequences than its tokens do, the emptiest sequences, up to half of all, are taken apart and
   their pieces packed again, best-fit decreasing.

The plan is a list of runs: how many consecutive sequences hold the same exact
lengths.  Spark numbers the pieces of each length and looks their place up.

Edge cases: null text counts as empty, an empty document is the closing id
alone (length 1); repeated rows are packed once each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakework.llm.common import lean, materialize, slices, python_workers, text_or_empty

#: Lengths up to capacity / SMALL are small: placed best-fit after the large ones.
SMALL = (3, 2.5, 4, 8, 2.05)
#: Groups of equal cardinality that the large lengths are rounded up in.  The plan is made for each bound and number of
#: groups until one needs no more sequences than its tokens do; else the one of fewest sequences stays.
GROUPS = (24, 96, 192)
#: Shares of the sequences, those with most room, that are taken apart and packed again.
REPACK = (0.05, 0.1, 0.2, 0.3, 0.4, 0.5)
#: Words kept while a task runs; the cache is emptied when full and long words are not kept.
CACHE_WORDS = 300_000
CACHED_CHARS = 48
#: Bytes of text and rows that are encoded together: each distinct part of theirs is looked up once.
TOGETHER_BYTES = 2 << 20
TOGETHER_ROWS = 4096

#: White space to the tokenizer; U+001C to U+001F are white space to str.split only.
SEPARATORS = re.compile("[\x1c-\x1f]")
SPACES = re.compile("[^\\S\x1c-\x1f]+")
#: White space beyond ASCII; the last is U+3000.
WIDE_SPACES = [c for c in map(chr, range(0x80, 0x3001)) if c.isspace()]
PUNCTUATION = ".,!?;:%&$*#"
#: A full stop or comma behind neither letter nor digit: part of a longer run of signs.
IN_RUN = re.compile(r"[.,](?<![^\W_].)")
#: Words whose letters have one lower case and no decompositions to put together.
SIMPLE = re.compile("[A-Za-zÀ-ÖØ-öø-ÿĀ-įıĲ-ɏ]+")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: bytes without a printable Latin-1 character, in order, stand for characters from U+0100 on;
    the space, which no word has, stays."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(others)} | {0x20: " "}


class Encoder:
    """A worker's tokenizer with the ids of parts it has seen."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()
        self.tokenize = self.tokenizer.model.tokenize
        self.raw = [int(i).to_bytes(4, "little") for i in range(len(self.ends_word))]
        self.letters = byte_letters()

    def forget(self) -> None:
        """Leaves the tokenizer alone, without the words it has seen."""
        self.known: dict[str, bytes] = {"": b""}

    def simple_words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words of simple letters: the merges alone, on the words as the steps before them leave them."""
        text = " ".join(words).lower()
        if not text.isascii():
            text = text.encode("utf-8").decode("latin-1").translate(self.letters)
        raw = self.raw
        for tokens in map(self.tokenize, text.split(" ") if words else ()):
            yield b"".join([raw[t.id] for t in tokens])

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only: encoded as one text, and told apart by the tokens that end a word."""
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):
            return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *(4 * ends[:-1]).tolist()], (4 * ends).tolist())]

    def learn(self, parts: set[str]) -> None:
        """Adds the ids of parts that are not known."""
        known = self.known
        letters, words, marked, others = [], set(), [], []
        simple = SIMPLE.fullmatch
        for p in parts:
            if simple(p):
                letters.append(p)
            elif p.isalpha():
                words.add(p)
            # Letters and the plain punctuation behind them are always separated by the tokenizer.
            elif (stem := p.rstrip(PUNCTUATION)).isalpha():
                marked.append(p)
                if stem not in known and stem not in parts:
                    if simple(stem):
                        letters.append(stem)
                    else:
                        words.add(stem)
                others.append(p[len(stem) :])
            else:
                others.append(p)
        known.update(zip(letters, self.simple_words(letters)))
        fresh = list(words)
        for at in range(0, len(fresh), 4096):
            some = fresh[at : at + 4096]
            known.update(zip(some, self.words(some)))
        rest = [u for u in set(others) if u not in known]
        for at in range(0, len(rest), 4096):
            some = rest[at : at + 4096]
            known.update((u, np.array(e.ids, "<u4").tobytes()) for u, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)))
        for p in marked:
            stem = p.rstrip(PUNCTUATION)
            known[p] = known[stem] + known[p[len(stem) :]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        The tokenizer drops white space before its merges and no rule of it
        looks across a space, so a text's ids are those of its parts.
        """
        split = pc.ascii_split_whitespace(pa.array(map(spaced, texts), pa.large_string()))
        parts = split.flatten().dictionary_encode()
        distinct = strings(parts.dictionary)
        fresh = set(distinct).difference(self.known)
        if fresh:
            self.learn(fresh)
        ids = pa.array(map(self.known.__getitem__, distinct), pa.large_binary()).take(parts.indices)
        for p in fresh:  # words stay, words with punctuation are put together again
            if len(p) > CACHED_CHARS or p[-1:] in PUNCTUATION and len(p) > 4:
                del self.known[p]
        if len(self.known) > CACHE_WORDS:
            self.forget()
        _, offsets, data = ids.buffers()
        ends = np.frombuffer(offsets, np.int64)[split.offsets.to_numpy()].tolist()
        data = memoryview(data or b"")
        return [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]


def strings(column: pa.LargeStringArray) -> list[str]:
    """The strings of a column that has some, all without a space, as a list: cut from one string, not made one by one."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column), pa.scalar(" ", pa.large_string()))
    return joined[0].as_py().split(" ")


def spaced(text: str) -> str:
    """The text with nothing but ASCII white space where the tokenizer sees white space; where no sign stands next to them,
    full stops and commas at the end of a part are parts of their own, as the tokenizer has them."""
    if SEPARATORS.search(text):
        return SPACES.sub(" ", text)
    # The tokenizer lower-cases too, but finds its own marks before; two letters have no lower case of their own.
    if "<|" not in text and "İ" not in text and "Σ" not in text:
        text = text.lower()
    if not IN_RUN.search(text):
        text = text.replace(". ", " . ").replace(", ", " , ").replace(".\n", " .\n")
    if not text.isascii():
        for c in WIDE_SPACES:
            text = text.replace(c, " ")
    return text


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file; the words it learns are kept for one task only (``encoded_pieces``)."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of (doc_id, text) batches, in order, some batches at a time."""
    docs, texts, size = [], [], 0
    for b in slices(batches):
        docs += b.column(0).to_pylist()
        texts += b.column(1).to_pylist()
        size += b.column(1).nbytes
        if size >= TOGETHER_BYTES or len(docs) >= TOGETHER_ROWS:
            yield docs, texts
            docs, texts, size = [], [], 0
    if docs:
        yield docs, texts


def encoded_pieces(batches: Iterator[pa.RecordBatch], tokenizer_path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    """The pieces of (doc_id, text) batches; the encoder forgets their words in the end, as other stages run beside the idle worker."""
    own = encoder(tokenizer_path)
    try:
        for docs, texts in together(batches):
            doc, no, start, size, crc = [], [], [], [], []
            for i, ids in zip(docs, own.encode(texts)):
                raw = ids + b"\0\0\0\0"
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    doc.append(i)
                    no.append(k)
                    start.append(at // 4)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(no, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )
    finally:
        own.forget()


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    python_workers(docs.sparkSession)

    def run(batches):
        yield from encoded_pieces(batches, tokenizer_path, capacity)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("t"))
    return src.mapInArrow(lean(run), "doc_id long, piece int, start long, length long, ids_crc32 long")


# --- the plan, from counts of lengths ----------------------------------------


@dataclass
class Run:
    """``count`` sequences that hold the same pieces: [length, pieces of it in each sequence], and what is open."""

    count: int
    items: list[tuple[int, int]]
    room: int


def group_sizes(counts: np.ndarray, least: int, groups: int) -> list[tuple[int, int]]:
    """Linear grouping of the lengths above ``least``: (rounded size, pieces) of groups of equal cardinality, longest first."""
    total = int(counts[least + 1 :].sum())
    if not total:
        return []
    out, left, share = [], 0, -(-total // groups)
    for length in range(len(counts) - 1, least, -1):
        n = int(counts[length])
        while n:
            if not left:
                out.append([length, 0])
                left = share
            took = min(n, left)
            out[-1][1] += took
            n, left = n - took, left - took
    merged: dict[int, int] = {}
    for size, n in out:
        merged[size] = merged.get(size, 0) + n
    return sorted(merged.items(), reverse=True)


def _best_pattern(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of greatest value: an unbounded integer knapsack.

    Rooms are valued in blocks no longer than the smallest size, whose values rest on earlier blocks only.
    """
    size, width = np.array(sizes), min(sizes)
    padded = np.full(2 * capacity + 1, -np.inf)  # rooms below zero stand before the others: no piece fits
    best = padded[capacity:]
    best[:] = 0
    windows = np.lib.stride_tricks.sliding_window_view(padded, width)
    choice = np.full(capacity + 1, -1, np.int64)
    for low in range(width, capacity + 1, width):
        rooms = slice(low, min(low + width, capacity + 1))
        gain = windows[capacity + low - size, : rooms.stop - low] + values[:, None]
        chosen = gain.argmax(axis=0)
        reached = np.maximum.accumulate(np.concatenate([best[low - 1 : low], gain[chosen, np.arange(len(chosen))]]))
        choice[rooms] = np.where(reached[1:] > reached[:-1], chosen, -1)
        best[rooms] = reached[1:]
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(best[capacity]), pattern


def configurations(sizes: list[int], demand: np.ndarray, capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """Configurations and how many sequences take each, rounded down from the linear optimum."""
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    amount = demand / np.diag(basis)
    for _ in range(rounds):
        value, pattern = _best_pattern(sizes, np.linalg.solve(basis.T, np.ones(k)), capacity)
        if value <= 1 + 1e-7:
            break
        step = np.linalg.solve(basis, pattern.astype(float))
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, amount / step, np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        amount = np.maximum(amount - ratio[out] * step, 0)
        amount[out] = ratio[out]
        basis[:, out] = pattern
    return [(basis[:, j].round().astype(np.int64), int(amount[j] + 1e-9)) for j in range(k) if amount[j] >= 1 - 1e-9]


def _take(supply: list[list[int]], n: int) -> list[tuple[int, int]]:
    """The ``n`` longest pieces still in a group's supply, as (length, pieces)."""
    got = []
    while n:
        length, have = supply[0]
        took = min(n, have)
        got.append((length, took))
        n -= took
        supply[0][1] -= took
        if not supply[0][1]:
            supply.pop(0)
    return got


def _substitute(pattern: np.ndarray, n: int, supply: list[list[list[int]]], capacity: int) -> list[Run]:
    """``n`` sequences of a configuration filled with actual lengths, as runs of equal contents."""
    slots = [_take(supply[j], n) for j, times in enumerate(pattern) for _ in range(times)]
    cuts = sorted({0, n}.union(*(np.cumsum([m for _, m in s]).tolist() for s in slots)))
    runs, where = [], [[0, 0] for _ in slots]  # entry and what of it is used up, by slot
    for a, b in zip(cuts, cuts[1:]):
        held: dict[int, int] = {}
        for s, w in zip(slots, where):
            length = s[w[0]][0]
            held[length] = held.get(length, 0) + 1
            w[1] += b - a
            if w[1] == s[w[0]][1]:
                w[0], w[1] = w[0] + 1, 0
        runs.append(Run(b - a, sorted(held.items(), reverse=True), capacity - sum(x * y for x, y in held.items())))
    return runs


def best_fit(runs: list[Run], counts: dict[int, int], capacity: int) -> list[Run]:
    """Places ``counts`` (pieces by length), longest first, each where least room is left."""
    by_room: dict[int, list[Run]] = {}
    for r in runs:
        by_room.setdefault(r.room, []).append(r)
    left = sorted(by_room)  # the rooms that runs have, ascending

    def put(run: Run, length: int, each: int, n: int) -> None:
        got = Run(n, [*run.items, (length, each)], run.room - each * length)
        own = by_room.setdefault(got.room, [])
        if not own:
            insort(left, got.room)
        own.append(got)

    for length in sorted(counts, reverse=True):
        n = counts[length]
        at = bisect_left(left, length)
        while n and at < len(left):
            room = left[at]
            own, each = by_room[room], room // length
            while n and own:
                run = own.pop()
                full = min(run.count, n // each)
                rest = min(run.count - full, 1) * (n - full * each if full < run.count else 0)
                if full:
                    put(run, length, each, full)
                if rest:
                    put(run, length, rest, 1)
                n -= full * each + rest
                over = run.count - full - (1 if rest else 0)
                if over:
                    own.append(Run(over, run.items, room))
            at = bisect_left(left, room)
            if not own:
                del left[at]
            else:
                at += 1
        while n:
            each = min(n, capacity // length)
            put(Run(0, [], capacity), length, each, n // each)
            n %= each
    return [r for rs in by_room.values() for r in rs]


def repacked(runs: list[Run], n: int, capacity: int) -> list[Run]:
    """The same pieces with the ``n`` emptiest sequences taken apart and packed again."""
    kept, loose = [], {}
    for r in reversed(sorted(runs, key=lambda r: r.room)):  # of equal room, the last made first
        took = min(r.count, n)
        n -= took
        for length, each in r.items if took else ():
            loose[length] = loose.get(length, 0) + each * took
        if r.count > took:
            kept.append(Run(r.count - took, r.items, r.room))
    return best_fit(kept, loose, capacity)


def plan(counts: np.ndarray, capacity: int) -> list[Run]:
    """Runs that hold exactly ``counts[length]`` pieces of each length."""
    size = lambda runs: sum(r.count for r in runs)
    least = -(-int(counts @ np.arange(len(counts))) // capacity)
    best: list[Run] | None = None
    for small, groups in product(SMALL, GROUPS):
        made = grouped_plan(counts, capacity, int(capacity // small), groups)
        for share in (0.0, *REPACK):
            tried = repacked(made, int(size(made) * share), capacity) if share else made
            if best is None or size(tried) < size(best):
                best = tried
            if size(best) <= least:
                return best
    return best


def grouped_plan(counts: np.ndarray, capacity: int, least: int, n_groups: int) -> list[Run]:
    """The plan with lengths above ``least`` in ``n_groups`` groups."""
    full = int(counts[capacity])
    runs = [Run(full, [(capacity, 1)], 0)] if full else []
    rest = counts.copy()
    rest[capacity] = 0
    groups = group_sizes(rest, least, n_groups)
    if groups:
        sizes, demand = [s for s, _ in groups], np.array([n for _, n in groups], float)
        supply: list[list[list[int]]] = []
        length, left = capacity, int(rest[capacity])
        for _, need in groups:
            own = []
            while need:
                while not left:
                    length -= 1
                    left = int(rest[length])
                took = min(need, left)
                own.append([length, took])
                need, left = need - took, left - took
            supply.append(own)
        for pattern, n in sorted(configurations(sizes, demand, capacity), key=lambda x: -x[1]):
            n = min([n, *(sum(m for _, m in supply[j]) // t for j, t in enumerate(pattern) if t)])
            if n:
                runs += _substitute(pattern, n, supply, capacity)
        over: dict[int, int] = {}
        for own in supply:
            for size, n in own:
                over[size] = over.get(size, 0) + n
        runs = best_fit(runs, over, capacity)
    small = {size: int(rest[size]) for size in range(1, least + 1) if rest[size]}
    return best_fit(runs, small, capacity)


@dataclass
class Places:
    """For each length a sorted list of rank ranges: where the first piece of a range goes and how many share a sequence."""

    #: By length: (first rank, first sequence, pieces of it in each sequence, offset of the first).
    of: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def lay_out(cls, runs: list[Run]) -> Places:
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        used: dict[int, int] = {}
        sequence = 0
        for r in runs:
            at = 0
            for length, each in r.items:
                rows.setdefault(length, []).append((used.get(length, 0), sequence, each, at))
                used[length] = used.get(length, 0) + each * r.count
                at += length * each
            sequence += r.count
        return cls({k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in rows.items()})

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        for size in np.unique(length):
            mine = length == size
            first, base, each, at = self.of[int(size)]
            k = np.searchsorted(first, rank[mine], "right") - 1
            step = rank[mine] - first[k]
            sequence[mine] = base[k] + step // each[k]
            offset[mine] = at[k] + step % each[k] * size
        return sequence, offset


def ranked(pieces_: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Numbers the pieces of each length from 0 (column rank) without gathering a length in one task.

    A length's pieces are dealt to about the square root of their number of
    buckets; bucket sizes are summed up per length, and pieces numbered within their bucket.
    """
    size = [max(1, int(np.sqrt(counts.get(i, 0) / 16))) for i in range(max(counts, default=0) + 1)]
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.element_at(F.lit(size), (F.col("length") + 1).cast("int")).cast("long"))
    dealt = pieces_.withColumn("bucket", bucket)
    sizes = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = dealt.withColumn("no", F.row_number().over(inside))
    return numbered.join(offsets, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("no") - 1).drop("bucket", "before", "no")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    cut = materialize(pieces(docs, tokenizer_path, capacity, id_col, text_col), "pieces")
    # At most ``capacity`` rows, whatever the size of the corpus.
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_length = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        by_length[length] = n
    # Runs grow with the number of distinct lengths, not with the corpus.
    places = spark.sparkContext.broadcast(Places.lay_out(plan(by_length, capacity)))

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if b.num_rows:
                col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
                sequence, offset = places.value.find(col["length"].to_numpy(), col.pop("rank").to_numpy())
                yield pa.RecordBatch.from_arrays([*col.values(), pa.array(sequence), pa.array(offset)], [*col, "sequence_id", "offset"])

    order = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked(cut, counts).select(*order, "rank").mapInArrow(run, schema)
