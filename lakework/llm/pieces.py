"""Offset-preserving SentencePiece encoding and decoding (operator 1).

The normaliser is our own: it walks the model's compiled character map (a
double-array trie with a block of replacement strings) by longest prefix and
records, for every normalised character, the source byte it came from.  The
merges run in the library on already normalised text, long texts in blocks cut
where no vocabulary piece can span; every resulting piece is then projected
through the recorded alignment to a byte span of the original text.

Edge cases: null text counts as empty; the empty text encodes to the begin and
end ids alone with empty spans and decodes to the empty text.  Rows are handled one by one, so
repeated rows give repeated results, an empty table an empty result, and
columns beyond the named ones are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakework.llm.common import slices, python_workers, text_or_empty

SPACE = "▁"
#: Long normalised texts are merged in blocks of about this many characters, which bounds
#: the library's working memory (some hundred bytes a character).
BLOCK_CHARS = 1 << 16


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        c = b[i]
        i += 1
        value |= (c & 127) << shift
        shift += 7
        if c < 128:
            return value, i


def proto_fields(b: bytes) -> Iterator[tuple[int, int, int | bytes]]:
    """(number, wire type, value) of each field of a protobuf message."""
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        wire = key & 7
        if wire == 0:
            value, i = _varint(b, i)
        else:
            size, i = _varint(b, i) if wire == 2 else (8 if wire == 1 else 4, i)
            value, i = b[i : i + size], i + size
        yield key >> 3, wire, value


def _put_varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _put_field(number: int, wire: int, value: int | bytes) -> bytes:
    key = _put_varint(number << 3 | wire)
    if wire == 0:
        return key + _put_varint(value)
    return key + (_put_varint(len(value)) if wire == 2 else b"") + value


class CharacterMap:
    """Longest-prefix lookup in a compiled character map (empty map: nothing matches)."""

    def __init__(self, blob: bytes):
        self.units = np.empty(0, np.uint32)
        self.strings = b""
        if blob:
            size = int.from_bytes(blob[:4], "little")
            self.units = np.frombuffer(blob[4 : 4 + size], "<u4")
            self.strings = blob[4 + size :]
        self._starts: dict[str, bool] = {}

    def _walk(self, key: bytes) -> Iterator[tuple[int, int | None]]:
        """After each byte of ``key`` that the trie has: (bytes so far, value or None)."""
        if not len(self.units):
            return
        unit = int(self.units[0])
        node = (unit >> 10) << ((unit & 512) >> 6)
        for n, byte in enumerate(key, 1):
            node ^= byte
            if node >= len(self.units):
                return
            unit = int(self.units[node])
            if unit & 0x800000FF != byte:
                return
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            yield n, int(self.units[node]) & 0x7FFFFFFF if unit >> 8 & 1 else None

    def longest(self, key: bytes) -> tuple[int, str] | None:
        """(matched bytes, replacement) of the longest entry that is a prefix of ``key``."""
        best = None
        for n, value in self._walk(key):
            if value is not None:
                best = n, value
        if best is None:
            return None
        end = self.strings.index(b"\0", best[1])
        return best[0], self.strings[best[1] : end].decode("utf-8")

    def may_start(self, char: str) -> bool:
        """Whether some entry begins with ``char``."""
        known = self._starts.get(char)
        if known is None:
            raw = char.encode("utf-8")
            known = self._starts[char] = any(n == len(raw) for n, _ in self._walk(raw))
        return known


def char_bytes(text: str) -> np.ndarray:
    """UTF-8 length of each character."""
    code = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)


@dataclass
class Normalized:
    text: str
    #: Source byte where each normalised character's chunk begins, and after the last one the end.
    source: np.ndarray


class Normalizer:
    """The model's normalisation with alignment to source bytes."""

    #: Longest source prefix the map is asked about, in characters.
    WINDOW = 64

    def __init__(self, charsmap: bytes, dummy_prefix: bool, squeeze: bool, escape: bool, whole: list[str] = ()):
        self.map = CharacterMap(charsmap)
        self.dummy_prefix, self.squeeze = dummy_prefix, squeeze
        self.space = SPACE if escape else " "
        self.whole = re.compile("|".join(map(re.escape, sorted(whole, key=len, reverse=True)))) if whole else None

    def chunks(self, text: str) -> Normalized:
        """Longest-prefix replacement; characters without an entry stand for themselves."""
        width = char_bytes(text)
        at = np.concatenate([[0], np.cumsum(width)]).astype(np.int64)
        special = [c for c in set(text) if self.map.may_start(c)]
        if not special and self.whole is None:
            return Normalized(text, at)
        parts, source, done = [], [], 0
        pattern = "|".join(([self.whole.pattern] if self.whole else []) + (["[" + re.escape("".join(special)) + "]"] if special else []))
        scan = re.compile(pattern, re.DOTALL)
        m = scan.search(text)
        while m:
            i = m.start()
            end, new = m.end(), m.group()
            if not (self.whole and self.whole.match(text, i)):
                if hit := self.map.longest(text[i : i + self.WINDOW].encode("utf-8")):
                    end, new = int(np.searchsorted(at, at[i] + hit[0])), hit[1]
            parts += [text[done:i], new]
            source += [at[done:i], np.full(len(new), at[i])]
            done = end
            m = scan.search(text, done)
        parts.append(text[done:])
        source += [at[done:-1], at[-1:]]
        return Normalized("".join(parts), np.concatenate(source))

    def __call__(self, text: str) -> Normalized:
        if not text:
            return Normalized("", np.zeros(1, np.int64))
        out = self.chunks(text)
        if self.squeeze:
            keep = np.ones(len(out.text), bool)
            for m in re.finditer(" +", out.text):
                first = m.start() if m.start() == 0 or m.end() == len(out.text) else m.start() + 1
                keep[first : m.end()] = False
            kept = np.flatnonzero(keep)
            end = out.source[kept[-1] + 1] if len(kept) else out.source[-1]
            out = Normalized("".join(map(out.text.__getitem__, kept)), np.append(out.source[kept], end))
            if not out.text:
                return out
        norm = out.text.replace(" ", self.space)
        if self.dummy_prefix:
            return Normalized(self.space + norm, np.concatenate([out.source[:1], out.source]))
        return Normalized(norm, out.source)


@dataclass
class Encoding:
    ids: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


class PieceModel:
    """Encoder and decoder for one byte-fallback BPE model file."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        spec, pieces, plain = {}, [], b""
        for number, wire, value in proto_fields(model):
            if number == 3:
                spec = {n: v for n, _, v in proto_fields(value)}
                # The merges get text that is normalised already: the same model with an empty normaliser.
                value = b"".join(_put_field(n, w, v) for n, w, v in proto_fields(value) if n == 1)
                value += _put_field(2, 2, b"") + b"".join(_put_field(n, 0, 0) for n in (3, 4, 5))
            elif number == 1:
                p = {n: v for n, _, v in proto_fields(value)}
                pieces.append((p[1].decode("utf-8"), p.get(3, 1)))
            plain += _put_field(number, wire, value)
        if not any(kind == 6 for _, kind in pieces):
            raise ValueError("the model has no byte pieces; spans of unknown runs are not defined here")
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=plain)
        whole = [p for p, kind in pieces if kind == 4]
        self.normalize = Normalizer(spec.get(2, b""), bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1)), whole)
        kinds = np.array([kind for _, kind in pieces])
        self.width = np.array([len(p) if kind not in (2, 3) else 0 for p, kind in pieces], np.int64)
        self.is_byte = kinds == 6
        self.is_tail = np.zeros(len(pieces) + 1, bool)
        for i in np.flatnonzero(self.is_byte):
            self.is_tail[i] = 0x80 <= int(pieces[i][0][3:5], 16) < 0xC0
        self.begin_id, self.end_id = self.library.bos_id(), self.library.eos_id()
        # No vocabulary piece holds a space mark after another character, so merges
        # never cross such a place and a long text may be cut there.
        cut = not whole and not any(SPACE in p.lstrip(SPACE) for p, _ in pieces)
        self.edge = re.compile(f"[^{SPACE}](?={SPACE})", re.DOTALL) if cut else None

    def blocks(self, text: str) -> Iterator[str]:
        """``text`` in parts of about ``BLOCK_CHARS`` characters, cut where no merge can cross."""
        at = 0
        while self.edge and len(text) - at > BLOCK_CHARS and (m := self.edge.search(text, at + BLOCK_CHARS)):
            yield text[at : m.end()]
            at = m.end()
        yield text[at:]

    def merge(self, text: str) -> np.ndarray:
        """Ids of normalised text."""
        return np.concatenate([np.array(self.merger.encode(b), "<u4") for b in self.blocks(text)])

    def encode(self, text: str) -> Encoding:
        """All ids, begin and end ids included, with the original byte span of each piece."""
        norm = self.normalize(text)
        ids = self.merge(norm.text) if norm.text else np.empty(0, "<u4")
        width = self.width[ids]
        byte = self.is_byte[ids]
        if byte.any():
            # Of a character spelt in byte pieces the last one holds the span.
            tail = self.is_tail[ids]
            width[byte] = ~np.append(tail[1:], False)[byte]
        last = np.cumsum(width)
        begins, ends = norm.source[last - width], norm.source[last]
        size = int(norm.source[-1])
        edge = lambda first, mid, end: np.concatenate([[first], mid, [end]])
        return Encoding(
            edge(self.begin_id, ids, self.end_id).astype("<u4"), edge(0, begins, size).astype(np.int64), edge(0, ends, size).astype(np.int64)
        )

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


_models: dict[str, PieceModel] = {}


def load(path: str) -> PieceModel:
    """One model per worker process and file."""
    if path not in _models:
        with open(path, "rb") as f:
            _models[path] = PieceModel(f.read())
    return _models[path]


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every whole text: id, ids, begins, ends (byte offsets into the UTF-8 text), decoded.

    ``model_path`` must be readable on every worker.
    """
    python_workers(docs.sparkSession)

    def run(batches):
        model = load(model_path)
        for b in slices(batches):
            got = [model.encode(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([e.ids.astype(np.int32) for e in got], pa.list_(pa.int32())),
                    pa.array([e.begins for e in got], pa.list_(pa.int64())),
                    pa.array([e.ends for e in got], pa.list_(pa.int64())),
                    pa.array([model.decode(e.ids) for e in got], pa.string()),
                ],
                ["id", "ids", "begins", "ends", "decoded"],
            )

    src = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("t"))
    return src.mapInArrow(run, "id long, ids array<int>, begins array<long>, ends array<long>, decoded string")


def piece_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of ``encode_texts`` made where the pieces are, so that no id list leaves the worker.

    id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers),
    spans_sha256 (begins, then ends, as little-endian 64-bit integers), decoded_sha256 (UTF-8).
    """
    python_workers(docs.sparkSession)
    sha = lambda raw: hashlib.sha256(raw).hexdigest()

    def run(batches):
        model = load(model_path)
        for b in slices(batches):
            rows = []
            for text in b.column(1).to_pylist():
                e = model.encode(text)
                spans = e.begins.astype("<i8").tobytes() + e.ends.astype("<i8").tobytes()
                rows.append((len(e.ids), sha(e.ids.tobytes()), sha(spans), sha(model.decode(e.ids).encode("utf-8"))))
            n, ids, spans, decoded = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(spans), pa.array(decoded)],
                ["id", "n_tokens", "ids_sha256", "spans_sha256", "decoded_sha256"],
            )

    src = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("t"))
    return src.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, spans_sha256 string, decoded_sha256 string")
