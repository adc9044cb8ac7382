import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from lakework.llm import pieces
from tests.llm.conftest import EDGE_ROWS, texts

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_spans_and_text_are_the_library_s(documents, library):
    model = pieces.load(PATH)
    for text in [t or "" for _, t, *_ in EDGE_ROWS] + [t for _, t in texts(documents)]:
        got = model.encode(text)
        want = library.encode(text, return_type="proto")
        assert got.ids.tolist() == [library.bos_id(), *(p.id for p in want.pieces), library.eos_id()]
        assert list(zip(got.begins[1:-1], got.ends[1:-1])) == [(p.begin, p.end) for p in want.pieces]
        assert model.decode(got.ids) == library.decode(got.ids.tolist())


def test_spans_cover_the_text_in_order():
    raw = "a  é🙂\n\tb".encode()
    got = pieces.load(PATH).encode(raw.decode())
    spelt = b"".join(raw[b:e] for b, e in zip(got.begins[1:-1], got.ends[1:-1]))
    assert spelt == raw


def test_long_texts_are_merged_in_blocks(monkeypatch, library):
    monkeypatch.setattr(pieces, "BLOCK_CHARS", 50)
    text = "word  another\nthird, " * 200 + "x" * 500
    assert pieces.load(PATH).encode(text).ids.tolist()[1:-1] == library.encode(text)


def test_compiled_map_is_applied_by_longest_prefix():
    rules = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = next(v for n, _, v in pieces.proto_fields(rules.serialized_model_proto()) if n == 3)
    blob = next(v for n, _, v in pieces.proto_fields(spec) if n == 2)
    own = pieces.Normalizer(blob, True, True, True)
    for text in ["", " ", "  a  b ", "\n\n", "Ｈｅｌｌｏ　①②③ ㌔ ﾊﾟ", "ﬁ ½", "é̀ ﷺ", "각", "plain"]:
        assert own(text).text == rules.normalize(text)
    got = pieces.Normalizer(blob, False, False, False)("aﬁ①")
    assert got.text == "afi1"
    # Both letters of the ligature come from its three bytes.
    assert got.source.tolist() == [0, 1, 1, 4, 7]


def test_frames(edge, nothing, library):
    rows = pieces.encode_texts(edge, PATH).collect()
    assert len(rows) == len(EDGE_ROWS)
    by_text = {(t or ""): library.encode(t or "", add_bos=True, add_eos=True) for _, t, *_ in EDGE_ROWS}
    assert sorted(map(tuple, (r["ids"] for r in rows))) == sorted(map(tuple, (by_text[t or ""] for _, t, *_ in EDGE_ROWS)))
    for r in pieces.piece_digests(edge, PATH).filter("id = 1").collect():
        ids = by_text[EDGE_ROWS[0][1]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert pieces.encode_texts(nothing, PATH).collect() == []
