"""Pieces against the tokenizer, sequences against their rules."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeloader.llm import packing as P
from lakeloader.llm.base import tokenizer
from llm_cases import awkward, rows_of

FILE = tokenizer("word_bpe_49k.json")


def pieces_of(rows, capacity):
    model, made = Tokenizer.from_file(FILE), []
    for doc_id, text, *_ in rows:
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            made.append((doc_id, piece, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(made, key=repr)


def check_sequences(rows, capacity):
    """Gapless, within capacity; returns their number."""
    sequences = {}
    for row in rows:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_awkward_rows(documents):
    made = P.pack(P.cut(documents, FILE)).collect()
    got = sorted(((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in made), key=repr)
    assert got == pieces_of(awkward(), 4096)
    assert check_sequences(made, 4096) <= -(-sum(row.length for row in made) // 4096) + 1


def test_special_tokens_and_odd_blanks(spark):
    texts = ["<|endoftext|> a<|startoftext|>b", "a b c\td\x1ce", "é ́e İI ΑΣ Σ", "it's we'll 'd 'D"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cut = P.cut(frame, FILE, 8).withColumn("ids_crc32", F.crc32("ids"))
    got = rows_of(cut, "doc_id", "piece", "start", "length", "ids_crc32")
    assert got == pieces_of(list(enumerate(texts)), 8)


def test_word_tables_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(P, "TABLE_BYTES", 2000)
    words, model = P.WordTokenizer(FILE), Tokenizer.from_file(FILE)
    for number in range(40):
        text = f"the word{number}s of {'qx' * 3000}{number} 漢{number}é"
        assert np.frombuffer(words.encode(text), "<u4").tolist() == model.encode(text, add_special_tokens=False).ids
        assert len(words) + len(words.parts) < 2000 / 160 + 2
        assert all(len(word) <= 4096 for word in [*words, *words.parts])


@pytest.mark.parametrize("low, high", [(1, 60), (51, 60), (1, 8), (100, 101)])
def test_rounds_over_a_tree_of_tasks(spark, low, high):
    draw = np.random.default_rng(4)
    rows = [(i, 0, 0, int(n), i.to_bytes(4, "little")) for i, n in enumerate(draw.integers(low, high, 3000))]
    made = P.pack(spark.createDataFrame(rows, P.PIECES), capacity=100, nearly_full=3, node_items=200).collect()
    assert sorted((r.doc_id, r.length) for r in made) == [(r[0], r[3]) for r in rows]
    assert all(r.ids == r.doc_id.to_bytes(4, "little") for r in made) and len(made) == 3000
    count = check_sequences(made, 100)
    if low > 50:
        assert count == 3000
    else:
        assert count <= 1.03 * -(-sum(r[3] for r in rows) // 100) + 1


def test_best_fit_takes_the_tightest_bin():
    assert P.best_fit(np.array([6, 5, 4, 3, 2]), 10) == [[0, 2], [1, 3, 4]]
    assert P.best_fit(np.zeros(0, int), 10) == []


def test_empty_table(no_documents):
    assert P.pack(P.cut(no_documents, FILE)).count() == 0


def test_sequences_decode_back_to_documents(spark):
    rows = [(i, text) for i, (_, text, *_) in enumerate(awkward())]
    model = Tokenizer.from_file(FILE)
    documents = {}
    for row in P.pack(P.cut(spark.createDataFrame(rows, "doc_id long, text string"), FILE)).collect():
        assert len(row.ids) == 4 * row.length
        documents.setdefault(row.doc_id, []).append((row.start, np.frombuffer(row.ids, "<u4")))
    for doc_id, text in rows:
        ids = np.concatenate([part for _, part in sorted(documents[doc_id], key=lambda x: x[0])]).tolist()
        assert ids == [*model.encode(text or "", add_special_tokens=False).ids, 1]


def test_other_columns_come_along(spark):
    frame = spark.createDataFrame([(1, 5, "a", 9), (None, 4, "b", 8), (None, 4, "b", 8)], "doc_id long, length long, row string, members long")
    made = P.pack(frame, capacity=10, nearly_full=0)
    assert made.columns == [*frame.columns, "sequence_id", "offset"]
    assert rows_of(made, *frame.columns) == rows_of(frame)


def test_words_cost_little_when_they_are_new(monkeypatch):
    """A file is loaded once in a process; runs of letters are kept once, and words of them need no search for parts."""
    words, again, model = P.WordTokenizer(FILE), P.WordTokenizer(FILE), Tokenizer.from_file(FILE)
    assert words.general is again.general

    class NoSearch:
        def findall(self, word):
            raise AssertionError(word)

    monkeypatch.setattr(P, "_PART", NoSearch())
    text = "Hello hello, HELLO hello... \u00c9T\u00c9 \u00e9t\u00e9! a() \u00dfx** <|endoftext|>a it's a<| <b"
    got = np.frombuffer(words.encode(text.rpartition(" a<|")[0]), "<u4").tolist()
    assert got == model.encode(text.rpartition(" a<|")[0], add_special_tokens=False).ids
    assert {"hello", "hello,", "HELLO", "\u00e9t\u00e9"} <= set(words) and not {"hello", "\u00e9t\u00e9"} & set(words.parts)
    monkeypatch.undo()
    assert np.frombuffer(again.encode(text), "<u4").tolist() == model.encode(text, add_special_tokens=False).ids
