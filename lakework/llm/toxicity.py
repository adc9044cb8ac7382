"""Toxicity by compression distance (operator 8).

Two zstandard dictionaries are trained, one on toxic and one on ordinary text.
A window (a word in lower case) is compressed with both, followed by a trailer
that both dictionaries end with: with it zstandard searches for matches up to
the window's last byte and never stores a short window raw, so the two lengths
differ by what each dictionary knows of the window.  Length differences of a
text's windows are calibrated to a probability on rows the dictionaries have not seen.

For the toxic dictionary only beginnings of words are taken that are found in far
more toxic than ordinary texts; on whole texts nearly all of it would be words that are
common to both, and the distance would measure little else.  The test for a beginning is a
binomial tail, which a vocabulary of few texts (a rare language) passes as well.  Windows
carry the place of each letter, so that only equal beginnings match and not common endings.

Edge cases: null text counts as empty; a text without windows
gains nothing.  Without rows of both labels the score is the share of toxic
rows (0 without any label).  Rows are scored one by one, so repeated rows agree;
a null id is never held out and never learned from; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lakework.llm.common import id_remainder, lean, python_workers, slices, smallest, text_or_empty

#: The classifier is fitted on at most this many labelled rows of each class, of
#: each at most ``SAMPLE_CHARS`` characters from a place chosen by hash.
ORDINARY_ROWS = 4000
TOXIC_ROWS = 2500
SAMPLE_CHARS = 4000
#: One pair of dictionaries of each size; their gains are added, which evens out the cost of offsets.
DICTIONARY_BYTES = (2048, 4096, 8192)
LEVEL = 3
THRESHOLD = 0.3
#: A beginning marks toxic words if it is in this many toxic texts at least, this many times
#: as often as in ordinary ones, and so seldom by chance.
MARK_TEXTS, MARK_RATIO, MARK_CHANCE = 4, 4.0, 1e-5
MARK_CHARS = range(4, 10)
#: A mark goes on by a letter that this share of its texts have.
MARK_BRANCH = 0.5
#: Windows of a larger gain are summed over the whole text.
LEAST_GAIN = 4
TRAILER = bytes(range(160, 192))
#: Between a dictionary's content and the trailer, so that no match runs over both.
BORDER = b"\xff\xfe"
WORD = re.compile(r"[^\W_]+")
CACHE_WORDS = 300_000


def windows(text: str) -> list[str]:
    return WORD.findall(text.lower())


def beginnings(word: str) -> set[str]:
    return {word[:k] for k in MARK_CHARS if len(word) >= k}


def placed(word: str) -> str:
    """A word with each letter's place behind it."""
    return "".join(c + chr(min(i, 30)) for i, c in enumerate(word, 1))


def chance(a: int, b: int, share: float) -> float:
    """Probability of at least ``a`` of ``a + b`` by a binomial of this share."""
    n, k = a + b, np.arange(a, a + b + 1)
    logs = np.cumsum(np.log(np.arange(1, n + 1)))
    logs = np.concatenate([[0.0], logs])
    return float(np.exp(logs[n] - logs[k] - logs[n - k] + k * np.log(share) + (n - k) * np.log1p(-share)).sum())


@dataclass
class ToxicityModel:
    #: Contents of the ordinary and of the toxic dictionary, for each size; None if there is nothing to tell apart.
    dictionaries: tuple[bytes, ...] | None
    #: Of the calibration: intercept first, then one for each of ``features``.
    weights: np.ndarray
    base_rate: float
    #: Whether the dictionaries hold words with their letters' places.
    places: bool = False


class Scorer:
    """A model's compressors in a worker."""

    def __init__(self, model: ToxicityModel):
        import zstandard

        self.model = model
        self.known: dict[str, int] = {}
        self.compressors = []
        for content in model.dictionaries or ():
            d = zstandard.ZstdCompressionDict(content + BORDER + TRAILER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))

    def gain(self, window: str) -> int:
        """Bytes that the toxic dictionaries save over the ordinary ones."""
        raw = f" {placed(window) if self.model.places else window} ".encode() + TRAILER
        size = [len(c.compress(raw)) for c in self.compressors]
        return sum(size[::2]) - sum(size[1::2])

    def gains(self, text: str) -> np.ndarray:
        """Gains of the distinct windows of a text, largest first."""
        found = set(windows(text))
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        fresh = {w: self.gain(w) for w in found if w not in known}
        out = [fresh[w] if w in fresh else known[w] for w in found]
        if len(fresh) <= CACHE_WORDS:
            known.update(fresh)
        return np.sort(np.array(out, float))[::-1] if out else np.zeros(1)

    def features(self, text: str) -> np.ndarray:
        g = self.gains(text)
        return np.array([1.0, g[0], g[:4].sum() - g[0], np.log(len(g)), g[g > LEAST_GAIN].sum() / np.sqrt(len(g))])

    def score(self, text: str) -> float:
        if self.model.dictionaries is None:
            return self.model.base_rate
        z = float(self.features(text) @ self.model.weights)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def training_sample(
    docs: DataFrame, labels: DataFrame, modulus: int, held_out: int, label_col: str = "toxic"
) -> tuple[list[tuple[int, str]], dict[int, int]]:
    """(label, text) of a bounded number of labelled rows of each class, chosen by the hash of their id; all rows of each class."""
    learn = id_remainder("doc_id", modulus) != held_out
    marked = labels.filter(learn & F.col(label_col).isin(0, 1)).groupBy("doc_id").agg(F.max(label_col).cast("int").alias("y"))
    totals = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    h = F.xxhash64(F.col("doc_id").cast("string"), F.lit(11))
    # Ids are picked first; texts are joined to this bounded number of rows only.
    top = smallest(marked.withColumn("h", h), ["h", "doc_id"], {0: ORDINARY_ROWS, 1: TOXIC_ROWS}, totals, by="y")
    picked = docs.sparkSession.createDataFrame([(r["doc_id"], r["y"], r["h"]) for r in top], "doc_id long, y int, h long")
    text = text_or_empty("text")
    spare = F.greatest(F.length(text) - F.lit(SAMPLE_CHARS), F.lit(0))
    start = (F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(13)), (spare + 1).cast("long")) + 1).cast("int")
    # Bounded by the two row counts above.
    rows = docs.select("doc_id", F.substr(text, start, F.lit(SAMPLE_CHARS)).alias("text")).join(F.broadcast(picked.select("doc_id", "y", "h")), "doc_id")
    return [(r["y"], r["text"]) for r in sorted(rows.collect(), key=lambda r: (r["y"], r["h"], r["doc_id"], r["text"]))], totals


def distinct_texts(sample: list[tuple[int, str]]) -> list[tuple[int, list[str]]]:
    """Words of the sample's texts, without near copies: texts that share their smallest hash of three words count once."""
    import zlib

    seen, out = set(), []
    for y, text in sample:
        words = windows(text)
        key = min(zlib.crc32(" ".join(words[i : i + 3]).encode()) for i in range(max(1, len(words) - 2)))
        if key not in seen:
            seen.add(key)
            out.append((y, words))
    return out


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary trained on the samples; the samples themselves where there are too few to train on."""
    import zstandard

    try:
        made = zstandard.train_dictionary(size + 256, samples, k=24, d=6, steps=4).as_bytes()
    except zstandard.ZstdError:
        made = b"".join(dict.fromkeys(samples))
    return made[-size:].rjust(size, b"\0")


def _logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (share * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def stem(word: str, marks: set[str], texts: Counter) -> str | None:
    """The word's first mark, longer while most of its texts go on alike; None without a mark."""
    found = None
    for g in (word[:k] for k in MARK_CHARS if len(word) >= k):
        if found is None:
            found = g if g in marks else None
        elif texts[g] >= MARK_BRANCH * texts[found]:
            found = g
        else:
            break
    return found


def fit(sample: list[tuple[int, str]], totals: dict[int, int]) -> ToxicityModel:
    """Dictionaries from three quarters of a bounded sample, calibration on the last quarter.

    ``totals`` are the labelled rows of each class; they set the classes' weight in the calibration.
    """
    rate = totals.get(1, 0) / max(1, sum(totals.values()))
    none = ToxicityModel(None, np.zeros(5), rate)
    texts = distinct_texts(sample)
    parts = {y: [[w for t, w in texts if t == y][k::4] for k in range(4)] for y in (0, 1)}
    learn = {y: sum(parts[y][:3], []) for y in (0, 1)}
    test = [(y, " ".join(w)) for y in (0, 1) for w in parts[y][3]]
    n = {y: len(learn[y]) for y in (0, 1)}
    if not all(n.values()) or len({y for y, _ in test}) < 2:
        return none
    found = {y: Counter(g for words in learn[y] for g in {g for w in set(words) for g in beginnings(w)}) for y in (0, 1)}
    marks = {
        g
        for g, a in found[1].items()
        if a >= MARK_TEXTS and a + 0.5 > MARK_RATIO * (found[0][g] + 0.5) * (n[1] + 1) / (n[0] + 1) and chance(a, found[0][g], n[1] / (n[0] + n[1])) < MARK_CHANCE
    }
    stems = {w: stem(w, marks, found[1]) for w in {w for words in learn[1] for w in words}}
    toxic = ["".join(f" {placed(stems[w])}" for w in words if stems[w]) for words in learn[1]]
    ordinary = ["".join(f" {placed(w)}" for w in words)[:4000] for words in learn[0]]
    y = np.array([y for y, _ in test], float)
    share = np.where(y == 1, rate / y.mean(), (1 - rate) / (1 - y.mean()))
    samples = [[s.encode() + b" " for s in kind if len(s) >= 8] for kind in (ordinary, toxic)]
    made = tuple(_dictionary(kind, size) for size in DICTIONARY_BYTES for kind in samples)
    model = ToxicityModel(made, np.zeros(5), rate, True)
    scorer = Scorer(model)
    x = np.array([scorer.features(t) for _, t in test])
    model.weights = _logistic(x, y, share)
    return model


def train(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2) -> ToxicityModel:
    """A model from the labelled rows whose id remainder is not ``held_out``."""
    return fit(*training_sample(docs, labels, modulus, held_out))


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with the column ``out`` (0 to 1) appended, replacing one of that name."""
    python_workers(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few KB
    src = docs.drop(out)
    at = src.columns.index(text_col)
    schema = StructType([*src.schema.fields, StructField(out, DoubleType())])

    def run(batches):
        scorer = Scorer(shared.value)
        for b in slices(batches):
            got = [scorer.score(t or "") for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.float64())], [f.name for f in schema])

    return src.mapInArrow(lean(run), schema)


def toxic(score_: Column) -> Column:
    return score_ >= F.lit(THRESHOLD)
