"""Encoding and decoding against the library itself."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeloader.llm.base import tokenizer
from lakeloader.llm.piece_codec import PieceCodec, encode_decode

from llm_cases import awkward, rows_of

MODEL = tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return PieceCodec(MODEL)


def by_library(codec, text):
    ids = codec.model.encode(text, add_bos=True, add_eos=True)
    return ids, codec.model.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40) | st.text(" ▁ab\n\té漢\x00", max_size=30))
def test_any_text_as_the_library_does(text):
    codec = test_any_text_as_the_library_does.codec
    ids, decoded = by_library(codec, text)
    assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == ids
    assert codec.decode([np.array(ids, "<u4").tobytes()])[0].decode() == decoded


test_any_text_as_the_library_does.codec = PieceCodec(MODEL)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(3, 400) | st.integers(28_000, 31_999), max_size=20))
def test_any_ids_are_decoded_as_the_library_does(ids):
    codec = test_any_text_as_the_library_does.codec
    ids = [1, *ids, 2]
    assert codec.decode([np.array(ids, "<u4").tobytes()])[0].decode() == codec.model.decode(ids)


def test_awkward_rows(documents, codec):
    wanted = []
    for doc_id, text, *_ in awkward():
        ids, decoded = by_library(codec, text or "")
        wanted.append(
            (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        )
    made = encode_decode(documents, MODEL)
    assert rows_of(made, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(wanted, key=repr)
    assert all(len(row.ids) == row.n_tokens for row in made.select("ids", "n_tokens").collect())


def test_a_full_table_is_emptied_without_a_trace(codec, monkeypatch):
    monkeypatch.setattr("lakeloader.llm.piece_codec.TABLE_BYTES", 300)
    small = PieceCodec(MODEL)
    for text in ("a b c d", "e f g", "a b"):
        assert small.encode([text]) == codec.encode([text])
        assert small.decode(small.encode([text])) == [text.encode()]


def test_long_chunks_are_not_kept(codec):
    own = PieceCodec(MODEL)
    for number in range(3):
        text = f"a {'xyz' * 2000}{number} b"
        assert own.encode([text, text]) == codec.encode([text, text])
        assert own.decode(own.encode([text])) == [text.encode()]
    own.encode(["a"])
    own.decode(own.encode(["a"]))
    assert max(map(len, own.ids)) < 4096 and max(map(len, own.texts)) < 4096


def test_empty_table(no_documents):
    assert encode_decode(no_documents, MODEL).count() == 0
