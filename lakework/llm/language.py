"""Language identification with string kernels (operator 3).

A text is compared with landmark texts by a blended-spectrum presence kernel:
the number of n-grams (n = 1..3 over a learned letter alphabet) that both hold,
divided by the geometric mean of their own numbers.  A Nyström approximation on
the landmarks turns one-versus-rest kernel ridge regression into a small linear
system; texts are scored block by block as matrix products, whole texts by the
mean over their blocks.

Edge cases: null text and text without a letter give ``und`` and score 0; so
does every text when there is nothing to learn from.  Ties go to the first label
in alphabetical order.  Rows are scored one by one, so repeated rows agree;
a null id is never held out and never learned from; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from lakework.llm.common import id_remainder, lean, python_workers, slices, smallest

#: The classifier is fitted on at most this many rows of each label, of each at
#: most ``BLOCK`` characters from a place chosen by hash; the first
#: ``LANDMARKS`` of a label also serve as its landmarks.
TRAIN_ROWS = 240
LANDMARKS = 32
BLOCK = 2000
RIDGE = 1e-3
LETTERS = 61
#: Texts with fewer letters are not turned down; others with less than this part of the sample's least share of known n-grams are.
ENOUGH_LETTERS = 100
KNOWN_MARGIN = 0.95
#: Blocks scored by one matrix product.
PRODUCT_BLOCKS = 32

CLASSES = 64
SPECTRUM = CLASSES + CLASSES**2 + CLASSES**3

_is_letter: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    global _is_letter
    if _is_letter is None:
        _is_letter = np.array([chr(c).isalpha() for c in range(0x110000)], bool)
    return _is_letter


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


def spectrum(classes: np.ndarray) -> np.ndarray:
    """Numbers of the n-grams (n = 1..3) of a run of character classes, with repeats."""
    c = np.concatenate([[0], classes, [0]]).astype(np.int64)
    pairs = c[:-1] * CLASSES + c[1:]
    return np.concatenate([c, CLASSES + pairs, CLASSES + CLASSES**2 + pairs[:-1] * CLASSES + c[2:]])


@dataclass
class LanguageModel:
    labels: list[str]
    #: Character class by code point: 0 for what is no letter.
    alphabet: np.ndarray
    #: Numbers of the n-grams that landmarks hold, and which landmark holds which (bits).
    grams: np.ndarray
    landmark_bits: np.ndarray
    landmark_sizes: np.ndarray
    weights: np.ndarray
    #: A text with a smaller share of n-grams that landmarks hold is unlike all that was learned from.
    least_known: float = 0.0

    def landmarks(self) -> np.ndarray:
        n = len(self.landmark_sizes)
        return np.unpackbits(self.landmark_bits, axis=1, count=n).astype(np.float32)


class Scorer:
    """A model unpacked in a worker."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.held = model.landmarks()
        self.scale = 1 / np.sqrt(np.maximum(model.landmark_sizes, 1))
        full = np.where(letter_table(), CLASSES - 1, 0).astype(np.uint8)
        full[: len(model.alphabet)] = model.alphabet
        self.alphabet = full

    def kernel(self, blocks: list[np.ndarray]) -> np.ndarray:
        """Normalised presence kernel of blocks (character classes) with the landmarks."""
        return self.kernel_and_known(blocks)[0]

    def kernel_and_known(self, blocks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The kernel, and the share of each block's n-grams that any landmark holds."""
        present = np.zeros((len(blocks), SPECTRUM), np.uint8)
        for row, b in zip(present, blocks):
            row[spectrum(b)] = 1
        own = np.array([np.count_nonzero(row) for row in present])
        among = present[:, self.model.grams].astype(np.float32)
        return among @ self.held / np.sqrt(np.maximum(own, 1))[:, None] * self.scale, among.sum(axis=1) / np.maximum(own, 1)

    def score(self, texts: list[str | None]) -> list[tuple[str, float, int, float]]:
        """Label, score, number of letters and share of known n-grams of each text."""
        blocks, owner, weight = [], [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            classes = self.alphabet[code_points(text)]
            letters = np.concatenate([[0], np.cumsum(classes > 0)])
            for at in range(0, len(classes), BLOCK):
                end = min(at + BLOCK, len(classes))
                if w := int(letters[end] - letters[at]):
                    blocks.append(classes[at:end])
                    owner.append(i)
                    weight.append(w)
        total = np.zeros((len(texts), max(1, len(self.model.labels))))
        mass, known = np.zeros(len(texts)), np.zeros(len(texts))
        if self.model.labels:
            for at in range(0, len(blocks), PRODUCT_BLOCKS):
                some = slice(at, at + PRODUCT_BLOCKS)
                w = np.array(weight[some], float)
                kernel, share = self.kernel_and_known(blocks[some])
                np.add.at(total, owner[some], kernel @ self.model.weights * w[:, None])
                np.add.at(known, owner[some], share * w)
                np.add.at(mass, owner[some], w)
        out = []
        for row, m, share in zip(total, mass, known):
            if not m:
                out.append(("und", 0.0, 0, 0.0))
            else:
                best = int(np.argmax(row))
                out.append((self.model.labels[best], float(np.clip((row[best] / m + 1) / 2, 0, 1)), int(m), float(share / m)))
        return out


def training_sample(docs: DataFrame, learn: Column, label_col: str, id_col: str, text_col: str) -> list[tuple[str, str]]:
    """(label, text) of at most ``TRAIN_ROWS`` rows of each label, chosen by the hash of their id."""
    order = F.xxhash64(F.col(id_col).cast("string"), F.lit(3))
    text = F.col(text_col).cast("string")
    spare = F.greatest(F.length(text) - F.lit(BLOCK), F.lit(0))
    start = (F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(7)), (spare + 1).cast("long")) + 1).cast("int")
    label = F.col(label_col).cast("string").alias("label")
    labelled = docs.filter(learn & F.col(label_col).isNotNull())
    # One row per label; texts are not read for it.
    counts = {r["label"]: r["n"] for r in labelled.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = labelled.filter(text.rlike(r"\p{L}")).select(label, order.alias("h"), F.substr(text, start, F.lit(BLOCK)).alias("text"))
    top = smallest(rows, ["h", "text"], dict.fromkeys(counts, TRAIN_ROWS), counts, by="label")
    return [(r["label"], r["text"]) for r in sorted(top, key=lambda r: (r["label"], r["rank"]))]


def fit(sample: list[tuple[str, str]]) -> LanguageModel:
    """Alphabet, landmarks and ridge weights from a bounded sample."""
    labels = sorted({label for label, _ in sample})
    letters = Counter()
    for _, text in sample:
        letters.update(c for c in text.lower() if c.isalpha() and ord(c) < 0x10000)
    alphabet = np.where(letter_table()[:0x10000], CLASSES - 1, 0).astype(np.uint8)
    for i, (c, _) in enumerate(sorted(letters.items(), key=lambda x: (-x[1], x[0]))[:LETTERS]):
        alphabet[ord(c)] = i + 1
    empty = LanguageModel(labels, alphabet, np.empty(0, np.int64), np.empty((0, 0), np.uint8), np.empty(0), np.empty((0, 0)))
    if not labels:
        return empty
    seen: Counter = Counter()
    chosen = []
    for i, (label, _) in enumerate(sample):
        seen[label] += 1
        if seen[label] <= LANDMARKS:
            chosen.append(i)
    blocks = [alphabet[np.minimum(code_points(text), 0xFFFF)] for _, text in sample]
    held = [np.unique(spectrum(blocks[i])) for i in chosen]
    grams = np.unique(np.concatenate(held))
    bits = np.zeros((len(grams), len(chosen)), np.uint8)
    for j, h in enumerate(held):
        bits[np.searchsorted(grams, h), j] = 1
    model = LanguageModel(labels, alphabet, grams, np.packbits(bits, axis=1), np.array([len(h) for h in held], float), np.zeros((len(chosen), len(labels))))
    scorer = Scorer(model)
    k = np.concatenate([scorer.kernel(blocks[at : at + PRODUCT_BLOCKS]) for at in range(0, len(blocks), PRODUCT_BLOCKS)]).astype(float)
    y = np.array([[1.0 if label == want else -1.0 for want in labels] for label, _ in sample])
    among = k[chosen]
    among = (among + among.T) / 2
    model.weights = np.linalg.solve(k.T @ k + RIDGE * len(sample) * among + 1e-8 * np.eye(len(chosen)), k.T @ y)
    # Calibrated on the sample's texts that are no landmarks themselves.
    others = sorted(set(range(len(sample))) - set(chosen))
    long = [x[3] for x in scorer.score([sample[i][1] for i in others]) if x[2] >= ENOUGH_LETTERS]
    model.least_known = KNOWN_MARGIN * min(long, default=0.0)
    return model


def identify(
    docs: DataFrame, model: LanguageModel, text_col: str = "text", label_out: str = "lang_pred", score_out: str = "score", letters_out: str | None = None, known_out: str | None = None
) -> DataFrame:
    """``docs`` with the predicted label, its score (0 to 1) and, if asked for, the number of letters and the share of known
    n-grams appended, replacing columns of these names."""
    python_workers(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    asked = [(label_out, StringType(), pa.string()), (score_out, DoubleType(), pa.float64()), (letters_out, LongType(), pa.int64()), (known_out, DoubleType(), pa.float64())]
    names = [n for n, _, _ in asked if n]
    src = docs.drop(*names)
    at = src.columns.index(text_col)
    schema = StructType([*src.schema.fields, *(StructField(n, k) for n, k, _ in asked if n)])

    def run(batches):
        scorer = Scorer(shared.value)
        for b in slices(batches):
            got = scorer.score(b.column(at).to_pylist())
            made = [pa.array([g[i] for g in got], kind) for i, (n, _, kind) in enumerate(asked) if n]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], [f.name for f in schema])

    return src.mapInArrow(lean(run), schema)


def in_a_language(model: LanguageModel, label: Column, score: Column, letters: Column, known: Column) -> Column:
    """Whether a text is in one of the learned languages, or in several of them.

    A score of 0.5 is a machine's zero: below it the best of them says no.  A text in two languages may score so too,
    but its n-grams are known; markup, code and other scripts have many that no landmark holds.  Texts of few letters
    hold too few n-grams to be turned down; only those without a letter are.
    """
    return (label != "und") & ((score >= 0.5) | (known >= F.lit(model.least_known)) | (letters < ENOUGH_LETTERS))


def train(docs: DataFrame, modulus: int = 5, held_out: int = 0, label_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> LanguageModel:
    """A model from the labelled rows whose id remainder is not ``held_out``."""
    return fit(training_sample(docs, id_remainder(id_col, modulus) != held_out, label_col, id_col, text_col))
