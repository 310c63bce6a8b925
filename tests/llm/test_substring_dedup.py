"""Substring dedup against a plain count of all windows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from lakeloader.llm import substring_dedup as S
from lakeloader.llm.fm_index import FmIndex
from llm_cases import awkward, rows_of


def kept_by_plain_count(rows):
    """Kept words per row; rows are `(doc_id, text)` with unique ids or equal texts for equal ids."""
    first, kept = {}, {}
    order = sorted(set((x[0], x[1]) for x in rows), key=lambda x: (x[0] is not None, x[0] or 0))
    for doc_id, text in order:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if first.setdefault(window, (doc_id, i)) != (doc_id, i):
                gone.update(range(i, i + 20))
        kept[doc_id, text] = [word for i, word in enumerate(words) if i not in gone]
    return kept


def expected(rows):
    kept = kept_by_plain_count(rows)
    made = []
    for row in rows:
        words, left = (row[1] or "").encode().split(), kept[row[0], row[1]]
        made.append((row[0], len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()))
    return sorted(made, key=repr)




def shared_passages(seed, count):
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(3000)}"
    passages = [" ".join(word() for _ in range(draw.randrange(18, 70))) for _ in range(6)]
    texts = []
    for _ in range(count):
        parts = [" ".join(word() for _ in range(draw.randrange(40)))]
        for _ in range(draw.randrange(4)):
            passage = draw.choice(passages).split()
            at = draw.randrange(5)
            parts += [" ".join(passage[at : len(passage) - draw.randrange(5)]), " ".join(word() for _ in range(draw.randrange(9)))]
        texts.append(draw.choice([" ", "\n", " \t"]).join(parts))
    texts += ["again " * 100, "x y " * 60, "again " * 30, texts[0], texts[0]]
    return list(enumerate(texts))


def test_awkward_rows(documents):
    assert rows_of(S.remove_repeats(documents)) == expected(awkward())


@pytest.mark.parametrize("shard", [250_000, 1, 100])
def test_shared_passages(spark, monkeypatch, shard):
    """Also with every minimizer dealt by windows, and with many small shards."""
    monkeypatch.setattr(S, "SHARD_WORDS", shard)
    rows = shared_passages(9, 150)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(S.remove_repeats(frame)) == expected(rows)


def test_cleaning_leaves_other_texts_and_columns_alone(documents):
    cleaned = S.clean(documents)
    assert cleaned.columns == documents.columns
    kept = kept_by_plain_count(awkward())
    wanted = []
    for row in awkward():
        words = (row[1] or "").encode().split()
        left = kept[row[0], row[1]]
        wanted.append((row[0], row[1] if len(left) == len(words) else b" ".join(left).decode(), row[2]))
    assert rows_of(cleaned, "doc_id", "text", "lang") == sorted(wanted, key=repr)


def test_empty_table(no_documents):
    assert S.remove_repeats(no_documents).count() == 0
    assert S.clean(no_documents).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_backward_search_finds_all_places(seed):
    draw = random.Random(seed)
    text = []
    for _ in range(draw.randrange(1, 8)):
        text += [draw.randint(1, 3) for _ in range(draw.randrange(60))] + [0]
    text, depth = np.array(text, np.int32), draw.choice([1, 3, 5, 20])
    starts = np.array([i for i in range(len(text) - depth + 1) if 0 not in text[i : i + depth]], np.int64)
    if not len(starts):
        return
    index = FmIndex(text, depth)
    found = {int(q): (int(a), int(b)) for q, a, b in zip(*index.matching(starts, depth))}
    patterns = [tuple(text[i : i + depth]) for i in starts]
    for q, pattern in enumerate(patterns):
        places = {int(i) for i, other in zip(starts, patterns) if other == pattern}
        assert (q in found) == (len(places) > 1)
        if q in found:
            low, high = found[q]
            assert set(index.suffixes[low:high].tolist()) == places


def test_segments_cover_every_window_once():
    codes = np.random.default_rng(2).integers(0, 50, 500).astype(np.uint64)
    _, first, windows = S.segments(codes)
    assert first[0] == 0 and (first[1:] == first[:-1] + windows[:-1]).all() and windows.sum() == 500 - 19


def test_batches_made_in_tasks_are_bounded(monkeypatch):
    monkeypatch.setattr(S, "BATCH_ROWS", 100)
    monkeypatch.setattr(S, "BATCH_BYTES", 1000)
    texts = [" ".join(f"w{n % 50}" for n in range(450)).encode()] * 3
    listed = [[{"shard": 0, "start": start, "windows": 43} for start in range(0, 430, 43)]] * 3
    kind = pa.list_(pa.struct([("shard", pa.int64()), ("start", pa.int32()), ("windows", pa.int32())]))
    batch = pa.record_batch(
        [pa.array([1, 2, 3]), pa.array([7, 8, 9]), pa.array(texts, pa.binary()), pa.array(listed, kind)],
        ["id", "variant", "text", "listed"],
    )
    made = list(S._window_rows(iter([batch])))
    assert max(part.num_rows for part in made) <= 100
    whole = pa.Table.from_batches(made)
    assert [(i, n) for i in (1, 2, 3) for n in range(430)] == list(zip(whole["id"].to_pylist(), whole["start"].to_pylist()))
    made = list(S._with_words(iter([batch])))
    assert max(sum(map(len, part.column("words").to_pylist())) for part in made) < 1000 + 62 * 4
    words = pa.Table.from_batches(made)
    assert words.num_rows == 30 and words["words"][1].as_py() == b" ".join(texts[0].split()[43:105])


def test_documents_are_looked_at_together():
    """Short texts share a look; segments, hashes and places are those of each text by itself."""
    draw = random.Random(3)
    texts = [" ".join(draw.choice("abc") * draw.choice([1, 8, 16, 17, 40]) for _ in range(draw.choice([0, 3, 19, 20, 21, 70]))) for _ in range(40)]
    texts = [draw.choice(["", " ", "\t\n"]) + text for text in texts]
    batch = pa.record_batch([pa.array(range(40)), pa.array(range(40)), pa.array([x.encode() for x in texts], pa.binary())], ["id", "variant", "text"])
    whole = list(S._minimizers(iter([batch])))
    assert len(whole) == 1
    alone = [x for i in range(40) for x in S._minimizers(iter([batch.slice(i, 1)]))]
    assert whole[0].to_pylist() == pa.Table.from_batches(alone).to_pylist()
    starts = [[x["start"] for x in reversed(whole[0].to_pylist()) if x["id"] == i][::2] for i in range(40)]
    batch = batch.append_column("starts", pa.array(starts, pa.list_(pa.int32())))
    whole = list(S._segment_rows(iter([batch])))
    alone = [x for i in range(40) for x in S._segment_rows(iter([batch.slice(i, 1)]))]
    assert len(whole) == 1 and whole[0].num_rows == sum(map(len, starts))
    assert whole[0].to_pylist() == pa.Table.from_batches(alone).to_pylist()


def test_word_codes_tell_words_apart():
    words = [b"a", b"a\0", b"aaaaaaaa", b"aaaaaaaa\0", b"a" * 16, b"a" * 17, b"a" * 16 + b"\0", "\u00e9".encode(), b"\x1c", b"\xa0"]
    text = b" \t".join([*words, *reversed(words)]) + b"\v\f\r\n"
    codes, starts = S.word_codes(text)
    assert codes.tolist() == codes[::-1].tolist() and len(set(codes.tolist())) == len(words)
    assert [text[i : i + len(w)] for i, w in zip(starts.tolist(), text.split(), strict=True)] == text.split()
    for empty in (b"", b" \n"):
        assert [len(x) for x in S.word_codes(empty)] == [0, 0]
