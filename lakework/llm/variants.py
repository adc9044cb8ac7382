"""Spelling variants by search schemes over a bidirectional FM-index (operator 12).

Two words are near if one code point inserted, deleted or replaced makes one of the other.  That edit leaves one half
of the word as it is, so each word is searched twice: its first half exactly and then, with one error, to its end;
its second half exactly and then, with one error, to its begin.

The vocabulary is dealt by these halves: a word goes, for each half that a near word may ask for, to the shard of that
half, in both directions.  A shard is indexed once: words joined by delimiters, suffixes ranked, the Burrows-Wheeler
symbols counted before each rank.  A search is an interval of ranks that a symbol at a time narrows; both
directions together are the bidirectional index, the one that reads words forwards and the one that reads them backwards.  All searches of a shard
advance together.  Where the interval may take the error, one look at the counts gives all symbols that can follow.

Halves that very many words share are cut into blocks; every block of words is searched for every block of queries.

Edge cases: null texts have no words; a null id takes no letter out.  Repeated rows are counted as rows are.  An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakework.llm.common import materialize, python_workers, slices

#: Letters of a run; code points and occurrences that make a run a word of the vocabulary; how much more frequent a form is.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
#: Of the hashes of (document, run), every so many-th takes a code point out.
EVERY = 31
#: Rows of a shard, distinct words that a task counts before it passes them on, queries that advance together.
SHARD_ROWS = 16_000
FLUSH = 200_000
TOGETHER = 8_192

LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def spelt(run: str, prefix: int) -> str:
    """The run as it counts: ``prefix`` is the crc32 of ``<doc_id>:``."""
    h = zlib.crc32(run.encode("utf-8"), prefix)
    if h % EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n of every word with at least ``least`` code points and ``least_count`` occurrences."""
    python_workers(docs.sparkSession)
    # No shorter run can become a word.
    runs = re.compile(f"[{LETTERS}]{{{least},}}")

    def count(batches):
        seen: Counter[str] = Counter()

        def passed_on():
            out = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"])
            seen.clear()
            return out

        for b in slices(batches):
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = Counter(runs.findall(text.encode("utf-8").translate(LOWER).decode("utf-8")))
                if i is None:
                    seen.update(own)
                    continue
                prefix = zlib.crc32(b"%d:" % i)
                for run, n in own.items():
                    seen[spelt(run, prefix)] += n
            if len(seen) > FLUSH:
                yield passed_on()
        if seen:
            yield passed_on()

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")).filter("t IS NOT NULL")
    words = src.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.filter((F.char_length("word") >= least) & (F.col("n") >= least_count))


class Index:
    """Ranks of the suffixes of delimited words; a pattern is read from a word's first symbol to its last."""

    def __init__(self, words: list[str]):
        # Reversed, so that putting a symbol before a suffix extends the pattern to the right.
        text = np.frombuffer("".join(w[::-1] + "\0" for w in words).encode("utf-32-le"), "<u4")
        self.alphabet = np.unique(np.append(text, 0).astype(np.uint32))
        code = np.searchsorted(self.alphabet, text)
        n, self.symbols = len(code), len(self.alphabet)
        ends = np.flatnonzero(code == 0)
        owner = np.repeat(np.arange(len(words)), np.diff(ends, prepend=-1))
        rank = self._ranks(code, ends[owner] - np.arange(n))
        before = code[rank - 1]  # the symbol before each suffix; before a word stands the delimiter of another
        self.first = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=self.symbols))]).astype(np.int32)
        # counts[r, c]: how often c precedes the suffixes ranked below r; two more columns are of symbols that no word has and of places after a word.
        self.counts = np.zeros((n + 1, self.symbols + 2), np.int32)
        for c in range(self.symbols):
            np.cumsum(before == c, out=self.counts[1:, c])
        self.whole = owner[rank[before == 0]]  # words in the order of their whole-word suffixes
        self.n_words = len(words)

    def _ranks(self, code: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Places of the suffixes in order; a suffix ends with its word, those equal stand in the order of the words.

        ``left``: symbols of each suffix before its delimiter.
        """
        n = len(code)
        bits = max(int(self.symbols).bit_length(), 1)
        width = max(1, min(62 // bits, int(left.max(initial=0)) + 1))
        key = np.zeros(n, np.int64)
        for j in range(width):
            key <<= bits
            key[: n - j] += np.where(left[: n - j] >= j, code[j:], 0)
        while True:
            order = np.argsort(key, kind="stable")
            if width > left.max(initial=0):
                return order
            step = np.ones(n, np.int64)
            step[1:] = key[order[1:]] != key[order[:-1]]
            dense = np.empty(n, np.int64)
            dense[order] = np.cumsum(step)
            rest = np.zeros(n, np.int64)
            rest[: n - width] = np.where(left[: n - width] >= width, dense[width:], 0)
            key = dense * (n + 1) + rest
            width *= 2

    def coded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row of symbols for each word, and their lengths."""
        size = np.array([len(w) for w in words])
        out = np.full((len(words), int(size.max(initial=0)) + 2), self.symbols + 1, np.int64)
        text = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        at = np.searchsorted(self.alphabet, text)
        at[self.alphabet[np.minimum(at, self.symbols - 1)] != text] = self.symbols
        out[np.arange(out.shape[1])[None, :] < size[:, None]] = at
        return out, size

    def near(self, words: list[str], exact: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of every indexed word one edit away from a query that begins with its first ``exact`` symbols.

        Of equal edits only the last is tried: a symbol is inserted or deleted at the end of a run of itself.
        """
        text, size = self.coded(words)
        must = np.array(exact)
        first, counts = self.first, self.counts
        q = np.arange(len(words))
        lo, hi = np.zeros(len(words), np.int64), np.full(len(words), self.n_words, np.int64)
        wrong = [np.empty(0, np.int64)] * 3  # searches that have taken their error: query, interval
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for j in range(text.shape[1] - 1):
            here = (lo < hi) & (size[q] >= j)
            q, lo, hi = q[here], lo[here], hi[here]
            nexts = []
            may = must[q] <= j
            bq, bl, bh = q[may], lo[may], hi[may]
            if len(bq):
                below, above = counts[bl, :-2], counts[bh, :-2]
                row, c = np.nonzero((above > below)[:, 1:])
                c += 1
                new = bq[row], first[c] + below[row, c], first[c] + above[row, c]
                differs = c != text[bq[row], j]
                inside = size[bq[row]] > j
                replaced = differs & inside
                nexts.append(tuple(x[replaced] for x in new))
                wrong = [np.concatenate([x, y[differs]]) for x, y in zip(wrong, new)]  # inserted before symbol j, or at the end
                last_of_run = (size[bq] > j) & (text[bq, j] != text[bq, j + 1])
                nexts.append((bq[last_of_run], bl[last_of_run], bh[last_of_run]))
            # Searches at the end of their query have found a word where a whole word has been read.
            at_end = size[wrong[0]] == j
            eq, el, eh = (x[at_end] for x in wrong)
            full = counts[eh, 0] > counts[el, 0]
            found.append((eq[full], self.whole[counts[el[full], 0]]))
            wrong = [x[~at_end] for x in wrong]
            c = text[wrong[0], j]
            wrong[1], wrong[2] = self._follow(wrong[1], c), self._follow(wrong[2], c)
            alive = wrong[1] < wrong[2]
            wrong = [np.concatenate([x[alive], *(n[k] for n in nexts)]) for k, x in enumerate(wrong)]
            c = text[q, j]
            lo, hi = self._follow(lo, c), self._follow(hi, c)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _follow(self, rank: np.ndarray, c: np.ndarray) -> np.ndarray:
        return self.first[np.minimum(c, self.symbols - 1)] + self.counts[rank, c]


def _dealt(words: DataFrame, least: int) -> DataFrame:
    """A word for each half that a query near it may have: backward, half, w (read backwards where backward), n, exact (of a query, else null)."""
    size = F.char_length("word")
    lengths = F.filter(F.array(size - 1, size, size + 1), lambda k: k >= least)

    def halves(length) -> Column:
        return F.array_distinct(F.transform(lengths, length))

    def rows(backward: bool, length) -> DataFrame:
        w = F.reverse("word") if backward else F.col("word")
        out = words.select(w.alias("w"), "n", F.explode(halves(length)).alias("k"), length(size).alias("own"))
        exact = F.when(F.col("k") == F.col("own"), F.col("own"))
        return out.select(F.lit(backward).alias("backward"), F.substring("w", F.lit(1), F.col("k")).alias("half"), "w", "n", exact.alias("exact"))

    first = lambda k: F.floor(k / F.lit(2)).cast("int")
    second = lambda k: (k - F.floor(k / F.lit(2))).cast("int")
    return rows(False, first).unionAll(rows(True, second))


def near(words: DataFrame, least: int = LEAST_LENGTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """word, n_near, best_n and best (its most frequent near word) of every word of ``words`` (word, n) that has near ones."""
    python_workers(words.sparkSession)
    dealt = materialize(_dealt(words, least), "variant-halves")
    by_half = materialize(dealt.groupBy("backward", "half").agg(F.count(F.lit(1)).alias("rows")), "variant-half-counts")
    shards = max(1, -(-dealt.count() // shard_rows))
    large = by_half.filter(F.col("rows") > shard_rows).select("backward", "half", F.ceil(F.col("rows") / F.lit(shard_rows)).cast("int").alias("blocks"))
    placed = dealt.join(large, ["backward", "half"], "left")
    own = F.pmod(F.xxhash64("w"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    whole = F.col("blocks").isNull()
    # In a large half, a word stands in its block for the queries of every block, and a query asks every block.
    as_word = F.when(whole, F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j")))).otherwise(F.transform(every, lambda j: F.struct(own.alias("i"), j.alias("j"))))
    as_query = F.when(whole, F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j")))).otherwise(F.transform(every, lambda i: F.struct(i.alias("i"), own.alias("j"))))
    keys = ["backward", "shard", "i", "j"]
    shard = F.when(whole, F.pmod(F.xxhash64("half"), F.lit(shards)).cast("string")).otherwise(F.concat(F.lit("half "), F.col("half")))
    base = placed.withColumn("shard", shard)
    indexed = base.select("backward", "shard", "w", "n", F.lit(None).cast("int").alias("exact"), F.explode(as_word).alias("at"))
    asked = base.filter("exact IS NOT NULL").select("backward", "shard", "w", "n", "exact", F.explode(as_query).alias("at"))
    rows = indexed.unionAll(asked).select("backward", "shard", "at.i", "at.j", "w", "n", "exact")

    def search(t: pa.Table) -> pa.Table:
        backward = t.column("backward")[0].as_py()
        w, n, exact = (t.column(c).to_pylist() for c in ("w", "n", "exact"))
        known = {x: k for x, k, e in zip(w, n, exact) if e is None}
        names = list(known)
        queries = sorted((x, e) for x, e in zip(w, exact) if e is not None)
        out: dict[str, list] = {}
        index = Index(names) if names else None
        for at in range(0, len(queries) if index else 0, TOGETHER):
            part = queries[at : at + TOGETHER]
            asked, hits = index.near([x for x, _ in part], [e for _, e in part])
            for k, h in zip(asked.tolist(), hits.tolist()):
                x, y = part[k][0], names[h]
                if backward:
                    # With the first half intact as well, the other direction finds it.
                    x, y = x[::-1], y[::-1]
                    if y.startswith(x[: len(x) // 2]):
                        continue
                rank = (-known[names[h]], y)
                one = out.get(x)
                if one is None:
                    out[x] = [1, rank]
                else:
                    one[0] += 1
                    if rank < one[1]:
                        one[1] = rank
        return pa.table(
            {
                "word": pa.array(out.keys(), pa.string()),
                "n_near": pa.array([v[0] for v in out.values()], pa.int64()),
                "best_n": pa.array([-v[1][0] for v in out.values()], pa.int64()),
                "best": pa.array([v[1][1] for v in out.values()], pa.string()),
            }
        )

    parts = rows.groupBy(*keys).applyInArrow(search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.less")).alias("best_n"), "b.best")


def roots(forms: DataFrame) -> DataFrame:
    """word and root of every row of ``forms`` (word, form): the last form that forms lead to.

    Each round doubles the steps taken; a form is ``RATIO`` times as frequent as its word, so the rounds are few.
    """
    step = materialize(forms.select("word", F.col("form").alias("root")), "variant-steps")
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = materialize(step.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "variant-steps")
        step = joined.drop("moved")
        if joined.filter("moved").isEmpty():
            return step


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH, shard_rows: int = SHARD_ROWS, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary."""
    words = materialize(vocabulary(docs, id_col, text_col, least), "variant-words")
    found = words.join(near(words, least, shard_rows), "word", "left")
    often = F.col("best_n") >= F.lit(ratio) * F.col("n")
    formed = materialize(
        found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(often, F.col("best")).alias("form"), F.when(often, F.col("best_n")).alias("form_n")),
        "variant-forms",
    )
    ends = roots(formed.filter("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
