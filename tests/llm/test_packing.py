import bisect
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakework.llm import packing
from lakework.llm.common import lean
from tests.llm.conftest import EDGE_ROWS, texts

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_plan(counts, capacity):
    runs = packing.plan(counts, capacity)
    held = np.zeros(capacity + 1, int)
    for r in runs:
        assert r.count > 0 and r.room >= 0 and sum(a * b for a, b in r.items) + r.room == capacity
        for length, each in r.items:
            held[length] += each * r.count
    assert (held == counts).all()
    return sum(r.count for r in runs)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300))
def test_plan_holds_every_piece(lengths):
    used = check_plan(np.bincount(lengths, minlength=65) if lengths else np.zeros(65, int), 64)
    assert used >= -(-sum(lengths) // 64)


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for x in sorted(map(int, lengths), reverse=True):
        k = bisect.bisect_left(rooms, x)
        bisect.insort(rooms, (rooms.pop(k) if k < len(rooms) else capacity) - x)
    return len(rooms)


@pytest.mark.parametrize("kind", [4.5, 5.5, 6.5, (300, 1100), (500, 800), (1, 2049)])
def test_few_sequences(kind):
    """No more than best-fit decreasing piece by piece, and fewer where lengths of a middle size leave gaps."""
    rng = np.random.default_rng(1)
    lengths = rng.integers(*kind, 10_000) if isinstance(kind, tuple) else np.clip(rng.lognormal(kind, 1.1, 10_000).astype(int) + 1, 1, 2048)
    used = check_plan(np.bincount(lengths, minlength=2049), 2048)
    plain = best_fit_decreasing(lengths, 2048)
    assert -(-lengths.sum() // 2048) <= used <= plain
    # At least half of the sequences are as the grouping left them.
    assert max(packing.REPACK) <= 0.5
    assert used < 0.99 * plain or kind not in ((300, 1100), (500, 800))


def brute_pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for i, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            out.append((i, k, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=str)


def check_places(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("capacity", [2048, 100])
def test_documents(documents, capacity):
    rows = packing.pack(documents, PATH, capacity).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str) == brute_pieces(texts(documents), capacity)
    used = check_places(rows, capacity)
    assert used <= 1.02 * sum(r["length"] for r in rows) / capacity + 2


def test_edge_rows(edge, nothing):
    rows = packing.pack(edge, PATH).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str) == brute_pieces([(i, t or "") for i, t, *_ in EDGE_ROWS], 2048)
    check_places(rows, 2048)
    assert packing.pack(nothing, PATH).collect() == []


def test_tokens_of_awkward_texts():
    tokenizer = Tokenizer.from_file(PATH)
    for text in ["", " ", "a  b", "It's  don't\u2003x", "e\u0301 E\u0301", "ΣΑΣ ΟΔΟΣ.", "<|endoftext|>x <|ENDOFTEXT|>", "\x1c\x85 a", "x" * 500, "İstanbul", "a.b word., ½. x'll l'll. ,;", "ǅ ª º. ʰ ⅷ é́́.", "word<|startoftext|>,"]:
        assert np.frombuffer(packing.encoder(PATH).encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_workers_keep_no_words_between_tasks(monkeypatch):
    """A worker stays when its task has ended; what the words take there adds to the memory of later stages."""
    docs = [f"shared w{i} ora{i % 7}nge, Straße {chr(0x3B1 + i % 20)}lpha{i}" for i in range(600)]
    rows = [pa.record_batch({"doc_id": range(at, at + 100), "t": docs[at : at + 100]}) for at in range(0, 600, 100)]
    tokenizer = Tokenizer.from_file(PATH)
    want = [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes() for t in docs]
    for bound in (10, packing.CACHE_WORDS):  # emptied on the way, or not
        monkeypatch.setattr(packing, "CACHE_WORDS", bound)
        out = []
        task = lean(lambda batches: packing.encoded_pieces(batches, PATH, 2048))(iter(rows))
        for b in task:
            out += b.column(4).to_pylist()
            assert bound == 10 or len(packing.encoder(PATH).known) > 100
        assert out == [zlib.crc32(w) for w in want]
        assert packing.encoder(PATH).known == {"": b""}
    # A task that is ended early leaves none either.
    task = lean(lambda batches: packing.encoded_pieces(batches, PATH, 2048))(iter(rows))
    next(task)
    assert len(packing.encoder(PATH).known) > 100
    task.close()
    assert packing.encoder(PATH).known == {"": b""}


def test_batches_are_encoded_together(monkeypatch):
    """A part that many batches hold is looked up once for all of them, within a bound on their bytes and rows."""
    odd = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    docs = [f"same words, w{i}{odd[i % len(odd)]}Zwölf. ½{odd[-i % len(odd)]} ora{i % 7}nge!! İx {'' if i % 3 else 'Σ'}é." for i in range(1000)]
    docs[7:9] = ["", " "]
    rows = [pa.record_batch({"doc_id": range(at, at + 100), "t": docs[at : at + 100]}) for at in range(0, 1000, 100)]
    tokenizer = Tokenizer.from_file(PATH)
    want = [(i, zlib.crc32(np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes())) for i, t in enumerate(docs)]
    asked, encode = [], packing.Encoder.encode
    monkeypatch.setattr(packing.Encoder, "encode", lambda self, texts: asked.append(len(texts)) or encode(self, texts))

    def run():
        asked.clear()
        out = [b for b in packing.encoded_pieces(iter(rows), PATH, 2048)]
        assert [(i, c) for b in out for i, c in zip(b.column(0).to_pylist(), b.column(4).to_pylist())] == want
        return asked

    assert run() == [1000]
    monkeypatch.setattr(packing, "TOGETHER_ROWS", 250)
    assert run() == [300, 300, 300, 100]
    monkeypatch.setattr(packing, "TOGETHER_BYTES", 1)
    assert run() == [100] * 10


def test_best_fit_as_piece_by_piece():
    """Runs are filled as single sequences are, each piece where least room is left."""

    def placed(runs, counts, capacity):  # piece by piece: into the least room that fits
        rooms = sorted(r.room for r in runs for _ in range(r.count))
        for length in sorted(counts, reverse=True):
            for _ in range(counts[length]):
                k = bisect.bisect_left(rooms, length)
                bisect.insort(rooms, (rooms.pop(k) if k < len(rooms) else capacity) - length)
        return rooms

    rng = np.random.default_rng(3)
    for _ in range(200):
        begun = [packing.Run(int(rng.integers(1, 6)), [(64 - int(room), 1)], int(room)) for room in rng.integers(0, 64, 8)]
        counts = {int(x): int(rng.integers(1, 20)) for x in rng.integers(1, 65, 12)}
        got = packing.best_fit(begun, counts, 64)
        assert sorted(r.room for r in got for _ in range(r.count)) == placed(begun, counts, 64)
        assert all(r.room + sum(a * b for a, b in r.items) == 64 for r in got)
