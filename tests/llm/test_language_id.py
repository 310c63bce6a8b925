"""Language identification: held-out accuracy, rejection and its rules."""

import random
import zlib

import duckdb
import numpy as np
import pytest

from lakeloader.llm import language_id as I
from llm_cases import awkward

TABLES = "/root/testdata/sf0.01"


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    rows = I.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1
    held = [row for row in rows if row.held_out]
    assert sum(row.lang_pred == row.lang for row in held) >= 0.98 * len(held)
    assert sum(row.rejected for row in rows) <= 0.01 * len(rows)


def test_held_out_labels_are_never_learned(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    lies = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2, 'xx', lang) AS lang")
    first = {(r.doc_id, r.lang_pred, r.score) for r in I.identify(docs).collect()}
    assert {(r.doc_id, r.lang_pred, r.score) for r in I.identify(lies).collect()} == first


def test_awkward_rows(documents):
    rows = sorted(((r.doc_id, r.lang_pred, r.score, r.held_out) for r in I.identify(documents).collect()), key=repr)
    wanted = sorted(((x[0], x[1]) for x in awkward()), key=lambda x: repr(x[0]))
    assert sorted(repr(x[0]) for x in rows) == sorted(repr(x[0]) for x in wanted)
    texts = {x[0]: x[1] for x in awkward() if x[0] is not None}
    for doc_id, language, score, held in rows:
        if doc_id is None:
            assert not held
        elif not any(c.isalpha() for c in texts[doc_id] or ""):
            assert (language, score) == ("und", 0.0)
        else:
            assert language in ("en", "de") and 0 < score <= 1
    kept = I.keep_known(documents)
    assert kept.columns == documents.columns
    assert all(any(c.isalpha() for c in row.text or "") for row in kept.collect())


def test_without_labels_or_rows(spark, no_documents):
    assert I.identify(no_documents).count() == 0 == I.keep_known(no_documents).count()
    frame = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [tuple(x) for x in I.identify(frame).select("lang_pred", "score", "rejected").collect()] == [("und", 0.0, True)]


def test_long_texts_count_as_a_whole(monkeypatch):
    text = "some wörds and others " * 3000
    whole = I.counts(text)
    monkeypatch.setattr(I, "_AT_ONCE", 1000)
    parts = I.counts(text)
    # Cutting loses no n-gram; one that lies across a cut may count in both parts.
    assert (parts >= whole).all() and parts.sum() <= whole.sum() * 1.01


def test_probabilities_are_calibrated():
    draw = np.random.default_rng(0)
    samples = []
    for i in range(600):
        language = "ab"[i % 2]
        share = 0.65 if language == "a" else 0.35
        at = np.unique(draw.integers(0, 50, 30))
        at = np.where(draw.random(len(at)) < share, at, at + 50)
        at = np.unique(at).astype("<u2")
        samples.append((language, at, np.ones(len(at), "<f4")))
    model = I.train(samples)
    assert 0 < model.threshold <= I.HIGHEST_THRESHOLD
    assert model.languages == ["a", "b"]
    assert I.train([]) is None


def test_sample_keeps_rare_languages(spark):
    """Each language keeps its share, whatever the others' sizes, and repeated rows count as rows."""
    rows = spark.range(60_000).selectExpr(
        "id AS doc_id", "concat('text ', id) AS text", "CASE WHEN id % 1000 = 0 THEN 'rare' WHEN id % 3 = 0 THEN 'b' ELSE 'a' END AS lang"
    )
    repeated = spark.range(20_000).selectExpr("cast(null AS long) AS doc_id", "concat('again ', id % 3) AS text", "'same' AS lang")
    found = [language for language, _, _ in I.sample(rows.unionAll(repeated), 400)]
    assert {x: found.count(x) for x in found} == {"rare": 60, "same": 113, "b": 113, "a": 114}
    many = spark.range(360_500).selectExpr("id AS doc_id", "concat('w', id) AS text", "if(id < 500, 'small', concat('l', id % 18)) AS lang")
    found = [language for language, _, _ in I.sample(many, 380)]
    assert {found.count(x) for x in found} == {20} and len(set(found)) == 19


def test_no_language_is_left_out(spark):
    """More languages than any fixed number: each of them is learned."""
    rows = spark.range(1200).selectExpr("id AS doc_id", "concat('text of ', id % 300) AS text", "concat('l', id % 300) AS lang")
    found = [language for language, _, _ in I.sample(rows, 900)]
    assert len(set(found)) == 300 and {found.count(x) for x in found} == {3}
    assert len({language for language, _, _ in I.sample(rows, 100)}) == 100


@pytest.mark.parametrize("left_out", [("de",), ("de", "es")])
def test_text_of_no_learned_language_goes(left_out):
    """Three languages or two: other languages and random letters are rejected, clean held-out documents stay."""
    rows = duckdb.sql(f"SELECT doc_id, text, lang FROM '{TABLES}/documents.parquet' WHERE text IS NOT NULL").fetchall()
    rows = [(zlib.crc32(str(doc_id).encode()) % 4 == 2, text, lang) for doc_id, text, lang in rows if I._LETTER.search(text)]
    samples = []
    for held, text, lang in rows:
        if not held and lang not in left_out:
            found = I.counts(text)
            samples.append((lang, np.flatnonzero(found).astype("<u2"), found[found > 0].astype("<f4")))
    scorer = I.Scorer(I.train(samples))
    clean = [scorer(text)[2] for held, text, lang in rows if held and lang not in left_out]
    foreign = [scorer(text)[2] for held, text, lang in rows if held and lang in left_out]
    draw = random.Random(3)
    letters = [scorer("".join(draw.choices("abcdefghijklmnopqrstuvwxyz    ", k=k)))[2] for k in (100, 1000) for _ in range(100)]
    assert sum(clean) <= 0.02 * len(clean)
    assert sum(foreign) >= 0.9 * len(foreign) and sum(letters) >= 0.95 * len(letters)
    assert scorer("русский текст о погоде и людях которые живут у моря")[2]
