"""Records of single values only take a short way; it gives what the general one gives."""

import pytest

from lakeloader.operators import pieces as P

RECORDS = [
    {"id": 1, "name": "x"},
    {},
    {"id": None, "name": ""},
    {"id": "7", "late": 2.5},
    {"a b": True, "id": 1 << 70, "name": 3},
    {"a b": 1, "a__b": float("nan"), "": 4},
    {"id": 2, "a": {"b": 1}},
    {"id": 3, "items": [{"v": 1}, None, {"v": "2"}]},
    {"id": 4, "items": [], "name": "last", "a b": False},
]
COLUMNS = (("id", "integer"), ("name", "string"), (P.column_name(("a b",), False), "boolean"))
ROOT, ITEMS = (), (("items",),)


def made(lineages):
    targets = {x: P.Target(n, (("v", "integer"),) if x else COLUMNS) for n, x in enumerate(lineages)}
    records = [P.Record(1, row, value, None, 10) for row, value in enumerate(RECORDS, 1)]
    records.insert(2, P.Record(1, 99, None, "ValueError: x"))
    return [row for batch in P.piece_batches(records, targets) for row in batch.to_pylist()]


@pytest.mark.parametrize("lineages", [[ROOT], [ITEMS], [ROOT, ITEMS]])
def test_plain_records_give_the_same_pieces(monkeypatch, lineages):
    got = made(lineages)
    monkeypatch.setattr(P, "_plain_row", lambda record: None, raising=False)
    assert repr(got) == repr(made(lineages)) and len(got) > 1


def test_plain_records_are_not_taken_apart(monkeypatch):
    def parts(*_):
        raise AssertionError("taken apart")

    monkeypatch.setattr(P, "parts", parts)
    records = [P.Record(0, row, {"id": row, "name": "x"}, None, 10) for row in range(1, 6)]
    rows = [row for batch in P.piece_batches(records, {ROOT: P.Target(0, COLUMNS)}) for row in batch.to_pylist()]
    assert [(row["row"], row["s0"]["v0"], row["s0"]["v1"], row["suffix"]) for row in rows] == [(n, n, "x", f"#{n}") for n in range(1, 6)]
