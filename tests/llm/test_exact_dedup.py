"""Exact dedup against a plain grouping."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from lakeloader.llm import exact_dedup as E

from llm_cases import awkward, rows_of


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()


def expected(rows):
    keep, size = {}, Counter()
    for doc_id, text, *_ in rows:
        key = lowered(text)
        size[key] += 1
        ids = [x for x in (keep.get(key), doc_id) if x is not None]
        keep[key] = max(ids) if ids else None
    return sorted(
        (
            (doc_id, keep[key], size[key], doc_id == keep[key], hashlib.sha256(key).hexdigest())
            for doc_id, key in ((row[0], lowered(row[1])) for row in rows)
        ),
        key=repr,
    )


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_every_awkward_row_has_its_group(documents):
    assert rows_of(E.exact_dedup(documents), *COLUMNS) == expected(awkward())


def test_many_shards_and_a_separate_history(spark, documents, monkeypatch):
    monkeypatch.setattr(E, "SHARD_KEYS", 3)
    assert rows_of(E.exact_dedup(documents), *COLUMNS) == expected(awkward())
    old = spark.createDataFrame([(100, "ONE"), (3, "äö same"), (101, "new")], "doc_id long, text string")
    found = {row.doc_id: row for row in E.exact_dedup(documents, history=old).where("doc_id in (3, 8, 9)").collect()}
    assert (found[3].keep_id, found[3].kept, found[3].historical) == (100, False, True)
    assert (found[8].keep_id, found[8].kept, found[8].historical) == (8, True, True)
    assert not found[9].historical


def test_empty_table(no_documents):
    assert E.exact_dedup(no_documents).count() == 0


def test_dropping_keeps_one_text_and_all_columns(documents):
    kept = E.drop_repeats(documents)
    assert kept.columns == documents.columns
    wanted = sorted({(row[1], row[4]) for row in expected(awkward())}, key=repr)
    assert sorted(((row.doc_id, hashlib.sha256(lowered(row.text)).hexdigest()) for row in kept.collect()), key=repr) == wanted


def test_rows_that_share_an_id_or_have_none(spark):
    rows = [(None, "A b", 1), (None, "a B", 2), (None, None, 3), (None, "", 4), (7, "c", 5), (7, "C", 6), (7, "c", 5), (6, "c", 7)]
    kept = E.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string, rows int")).collect()
    assert sorted((row.doc_id or 0, (row.text or "").lower()) for row in kept) == [(0, ""), (0, "a b"), (7, "c")]


@pytest.mark.parametrize("count", [0, 1, 2, 63, 64, 1000, 20_000])
def test_the_hash_is_perfect_and_minimal(count):
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(count)]
    keys = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 4)
    hashed = E.PerfectHash.build(keys)
    assert sorted(hashed.slots(keys).tolist()) == list(range(count))
    strange = np.frombuffer(hashlib.sha256(b"strange").digest(), "<u8").reshape(-1, 4)
    assert -1 <= hashed.slots(strange)[0] < max(count, 1)


def test_equal_digests_are_refused():
    with pytest.raises(ValueError):
        E.PerfectHash.build(np.ones((2, 4), np.uint64))
