"""URL filters by a bit-parallel wildcard automaton (operator 10).

Glob rules over a canonical URL (host, then path) are packed into the words of
one Shift-And automaton, a bit for each pattern character.  All patterns of all rules advance together,
for a whole batch of URLs at once: one shift, one mask look-up by character and a carry between words.

In a glob, ``**`` stands for any characters, ``*`` for any but a slash; every
other character for itself.  Of the rules that match, the longest wins.

Edge cases: a null URL or one without ``://`` has an empty host and path.
An empty host and path match no rule; URLs that no rule matches get the
default verdict.  Rows are judged one by one, so repeated rows agree; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakework.llm.common import slices, python_workers

BATCH_URLS = 2048


@dataclass(frozen=True)
class Rule:
    """A named rule with its globs; ``weight`` ranks it among rules that match (a plain rule's length)."""

    name: str
    verdict: str
    globs: tuple[str, ...]
    weight: int


def site_rule(host_path: str, verdict: str) -> Rule:
    """A rule for a host, all its subdomains, and the paths that start with its path."""
    return Rule(host_path, verdict, (f"{host_path}**", f"*.{host_path}**"), len(host_path))


class Automaton:
    """Shift-And masks of many globs; state bit i means: the pattern characters up to i are matched."""

    def __init__(self, globs: list[str]):
        chars: list[str] = []
        loops: list[tuple[int, str]] = []  # bit, wildcard that stands before the bit's character or at the end
        starts, ends = [], []
        for g in globs:
            starts.append(len(chars))
            chars.append("")  # the bit of an empty prefix
            i = 0
            while i < len(g):
                if g[i] == "*":
                    wide = g[i : i + 2] == "**"
                    loops.append((len(chars) - 1, "**" if wide else "*"))
                    i += 2 if wide else 1
                else:
                    chars.append(g[i])
                    i += 1
            ends.append(len(chars) - 1)
        self.words = max(1, -(-len(chars) // 64))
        self.accepts = ends
        bit = lambda bits: self._pack(bits)
        self.start = bit(starts)
        self.alphabet = {c: k + 2 for k, c in enumerate(sorted(set(chars) - {"", "/"}))} | {"/": 1}
        self.masks = np.zeros((len(self.alphabet) + 1, self.words), np.uint64)
        self.stay = np.tile(bit([b for b, _ in loops]), (len(self.alphabet) + 1, 1))
        self.stay[1] = bit([b for b, kind in loops if kind == "**"])
        for c, k in self.alphabet.items():
            self.masks[k] = bit([i for i, x in enumerate(chars) if x == c])
        self.code = np.zeros(0x110000, np.uint16)
        for c, k in self.alphabet.items():
            self.code[ord(c)] = k

    def _pack(self, bits: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for b in bits:
            out[b // 64] |= np.uint64(1) << np.uint64(b % 64)
        return out

    def run(self, texts: list[str]) -> np.ndarray:
        """For each text, whether each glob matches all of it."""
        order = np.argsort([-len(t) for t in texts], kind="stable")
        codes = [self.code[np.frombuffer(texts[i].encode("utf-32-le", "surrogatepass"), "<u4")] for i in order]
        length = np.array([len(c) for c in codes])
        state = np.tile(self.start, (len(texts), 1))
        one, top = np.uint64(1), np.uint64(63)
        for at in range(int(length.max(initial=0))):
            live = int(np.searchsorted(-length, -at, "left"))  # longer texts come first
            c = np.array([x[at] for x in codes[:live]])
            now = state[:live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:live] = (moved & self.masks[c]) | (now & self.stay[c])
        found = np.empty((len(texts), len(self.accepts)), bool)
        for j, b in enumerate(self.accepts):
            found[order, j] = (state[:, b // 64] >> np.uint64(b % 64) & one).astype(bool)
        return found


def canonical(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    after = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(after, F.lit(""))


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule (the winning rule's name or null), verdict of every page."""
    python_workers(pages.sparkSession, BATCH_URLS)
    ranked = sorted(rules, key=lambda r: (-r.weight, r.name))
    globs = [g for r in ranked for g in r.globs]
    owner = np.array([k for k, r in enumerate(ranked) for _ in r.globs], int)
    host, path = canonical(F.col(url_col).cast("string"))
    src = pages.select(F.col(id_col).cast("long").alias("id"), host.alias("host"), path.alias("path"))

    def run(batches):
        automaton = Automaton(globs)
        for b in slices(batches, BATCH_URLS):
            texts = [h + p for h, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            found = automaton.run(texts)
            first = [int(owner[row.argmax()]) if row.any() else -1 for row in found]
            names = [ranked[k].name if k >= 0 else None for k in first]
            verdicts = [ranked[k].verdict if k >= 0 else default for k in first]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(verdicts, pa.string())], ["id", "host", "path", "rule", "verdict"])

    return src.mapInArrow(run, "id long, host string, path string, rule string, verdict string")
