"""Merkle fingerprints against a plain walk in id order."""

import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from lakeloader.llm import merkle as M
from llm_cases import awkward, prose, rows_of


def expected(rows):
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), (x[1] or "").encode()))
    made = []
    for i, row in enumerate(order):
        text, after = row[1] or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        made.append(
            (
                row[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), M.tree(text).text(), M.tree(edited).text(),
                M.likeness(M.tree(text), M.tree(edited)), M.likeness(M.tree(text), M.tree(after)),
            )
        )
    return sorted(made, key=repr)


@pytest.mark.parametrize("rows_each", [8192, 5, 1])
def test_awkward_rows(documents, monkeypatch, rows_each):
    """Over one range of ids, several, and one per id."""
    monkeypatch.setattr(M, "PARTITION_ROWS", rows_each)
    assert rows_of(M.compare_with_next(documents)) == expected(awkward())


def test_small_tables(spark, no_documents):
    assert M.compare_with_next(no_documents).count() == 0
    for rows in ([(7, "only one. here")], [(None, "a"), (None, "b")]):
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        assert rows_of(M.compare_with_next(frame)) == expected(rows)


@given(st.text("ab. \n!"), st.text("ab. \n!"))
def test_roots_and_likeness(a, b):
    left, right = M.tree(a), M.tree(b)
    assert (left.root == right.root) == (a == b) == (left.text() == right.text())
    assert 0 <= M.likeness(left, right) == M.likeness(right, left) <= 1
    assert a != b or M.likeness(left, right) == 1
    assert "\n".join("".join(M.leaves_of(line)) for line in a.split("\n")) == a


def test_likeness_counts_common_leaves():
    text = "\n".join(prose(i, 30) + "." for i in range(40))
    changed = text.replace("cat", "dog", 1)
    assert 0.9 < M.likeness(M.tree(text), M.tree(changed)) < 1
    only_old, only_new = M.differing(M.tree(text), M.tree(changed))
    assert len(only_old) == len(only_new) == 1
    assert M.likeness(M.tree(text), M.tree(prose(99, 400))) < 0.1


def test_edits_are_located():
    text = "\n\n".join(prose(i, 30) + ". " + prose(i + 50, 20) + "." for i in range(10))
    at = text.index("fell", 700)
    new = text[:at] + "rose" + text[at + 4 :]
    ((start, end),) = M.edits(text, new)
    assert start <= at < end and end - start < 400
    assert M.edits(text, text) == []
