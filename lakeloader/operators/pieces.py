"""Take decoded JSON records apart inside a task, row by row.

JSON rows choose their own shape: one path can be a value, an object and a
list in different rows. So this lane looks at values, not at a schema. It only
splits a record. Values that already have their column's type go into typed
Arrow columns. All others become cells tagged with what they were (`s` text,
`i` integer, `f` float, `b` boolean), for the converters, which are DataFrame
expressions.
"""

from __future__ import annotations

import base64
import datetime
import decimal
import itertools
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa

from lakeloader.functions.jsontext import dump
from lakeloader.functions.names import Lineage, Path, column_name, parent_column, path_name
from lakeloader.model import MAX_DEPTH

# One row per stream row, cells with their names: the form discovery reads.
NAMED = (
    "obj int, lineage array<array<string>>, row bigint, seq int, names array<string>, "
    "cells array<string>, containers array<string>, notes array<string>, error string"
)
# An Arrow batch ends after so many rows, or so many bytes of JSON.
_BATCH, _BATCH_BYTES = 4096, 16 << 20


class Record(NamedTuple):
    """One row of an object: its number, and its value or what is wrong with it."""

    obj: int
    row: int
    value: dict | None
    error: str | None = None
    size: int = 0


class Part(NamedTuple):
    """A record's row for one stream."""

    lineage: Lineage
    values: dict[str, Any]
    containers: set[str]
    renamed: list[str]
    parent: str | None
    index: int | None
    suffix: str
    position: tuple[int, ...]


def tag(value: Any) -> str | None:
    """A value as a tagged cell."""
    match value:
        case None:
            return None
        case str():
            return "s" + value
        case bool():
            return "btrue" if value else "bfalse"
        case int():
            return f"i{value}"
        case float():
            return f"f{value!r}"
        case decimal.Decimal():
            return f"f{float(value)!r}"
        case bytes():
            return "s" + base64.b64encode(value).decode("ascii")
        case datetime.datetime():
            aware = value if value.tzinfo else value.replace(tzinfo=datetime.timezone.utc)
            return "s" + aware.isoformat()
        case datetime.date() | datetime.time():
            return "s" + value.isoformat()
    return "s" + str(value)


_SCALARS = frozenset((str, int, float, bool, type(None)))
_TOP_NAMES: tuple[dict[str, str], dict[str, str]] = ({}, {})


def _top_name(key: str, child: bool) -> str:
    name = column_name((str(key),), child)
    if len(_TOP_NAMES[child]) < 65536:
        _TOP_NAMES[child][key] = name
    return name


class _Row:
    """What a record holds itself: columns, lists of objects, containers and renamed keys."""

    def __init__(self, level: int, child: bool):
        self.level, self.child = level, child
        self.values: dict[str, Any] = {}
        self.lists: list[tuple[Path, list]] = []
        self.containers: set[str] = set()
        self.renamed: list[str] = []

    def put(self, key: str, name: str, value: Any, top: bool) -> None:
        self.values[name] = value
        if top and name != key:
            self.renamed.append(f"{key} to {name}")

    def inner(self, path: Path, value: Any) -> dict:
        """Take a nested value. Gives what of it is still to be opened."""
        name = column_name(path, self.child)
        may_open = self.level + len(path) < MAX_DEPTH
        items = None if isinstance(value, dict) else [item for item in value if item is not None]
        if items is None:
            self.containers.add(name)
            if may_open:
                return value
        elif not items:
            return {}
        elif may_open and {type(item) for item in items} == {dict}:
            self.containers.add(name)
            self.lists.append((path, value))
            return {}
        # Too deep, or a list of other things: one column with all of it as text.
        self.put(path[0], name, dump(value), len(path) == 1)
        return {}


def _open_row(record: dict, level: int, child: bool) -> _Row:
    """Open a record and the objects in it, keeping the order of their keys."""
    row, known = _Row(level, child), _TOP_NAMES[child]
    waiting: list[tuple[Path, Iterator[tuple[Any, Any]]]] = [((), iter(record.items()))]
    while waiting:
        path, members = waiting[-1]
        for key, value in members:
            if type(value) in _SCALARS:
                name = column_name((*path, str(key)), child) if path else known.get(key) or _top_name(key, child)
                row.put(key, name, value, not path)
            elif isinstance(value, (dict, list, tuple)):
                here = (*path, str(key))
                below = row.inner(here, value)
                if below:
                    waiting.append((here, iter(below.items())))
                    break
            else:
                row.put(str(key), column_name((*path, str(key)), child), value, not path)
        else:
            waiting.pop()
    return row


def _plain_row(record: dict) -> tuple[dict[str, Any], list[str]] | None:
    """Values and renamed keys of a record's own row, if it holds nothing but single values."""
    if not _SCALARS.issuperset(map(type, record.values())):
        return None
    known = _TOP_NAMES[False]
    for key in record:
        if known.get(key) != key:
            break
    else:
        return record, []
    values, renamed = {}, []
    for key, value in record.items():
        name = known.get(key) or _top_name(key, False)
        values[name] = value
        if name != key:
            renamed.append(f"{key} to {name}")
    return values, renamed


def parts(record: dict, row: int, reached: frozenset[Lineage] | None = None) -> Iterator[Part]:
    """The record's own row, then its child rows, depth first.

    Only lists whose lineage is among the `reached` ones are opened, or all if it is None.
    """
    stack = [iter([((), record, 0, {}, None, None, f"#{row}", ())])]
    while stack:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            continue
        lineage, item, level, above, parent, index, suffix, position = step
        own = _open_row(item, level, bool(lineage))
        own.values.update(above)
        yield Part(lineage, own.values, own.containers, own.renamed, parent, index, suffix, position)
        lists = own.lists
        if lists and reached is not None:
            lists = [found for found in lists if lineage + (found[0],) in reached]
        if lists:
            stack.append(_items(lineage, item, level, suffix, position, lists))


def _items(lineage, item, level, suffix, position, lists):
    """The items of a row's lists, ready to be opened."""
    plain = {
        parent_column(str(key)): value
        for key, value in item.items()
        if value is not None and not isinstance(value, (dict, list, tuple))
    }
    for path, entries in lists:
        place = f"{suffix}/{path_name(path)}#"
        for index, entry in enumerate(entries):
            if entry is not None:
                yield (
                    lineage + (path,), entry, level + len(path), plain, suffix, index,
                    f"{place}{index}", position + (index,),
                )


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    source = iter(rows)
    # Discovery reads a sample, whose rows may still be long.
    while chunk := list(itertools.islice(source, 256)):
        columns = zip(*chunk)
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema
        )


_LIST = pa.list_(pa.string())
# The Arrow type of a column of each kind. Kinds that are missing
# here always go through the converters.
_DIRECT = {
    "integer": (int, pa.int64(), "bigint"),
    "number": (float, pa.float64(), "double"),
    "boolean": (bool, pa.bool_(), "boolean"),
    "string": (str, pa.string(), "string"),
    "date-time": (str, pa.string(), "string"),
    "date": (str, pa.string(), "string"),
}
_OTHER = (None, pa.string(), "string")


@dataclass(frozen=True)
class Target:
    """A stream that takes pieces: its number, and its columns with their kinds."""

    number: int
    columns: tuple[tuple[str, str], ...]

    @property
    def ddl(self) -> str:
        fields = (f"v{n}:{_DIRECT.get(kind, _OTHER)[2]}" for n, (_, kind) in enumerate(self.columns))
        return f"s{self.number} struct<row:bigint{''.join(',' + field for field in fields)}>"

    @property
    def arrow(self) -> pa.StructType:
        fields = [(f"v{n}", _DIRECT.get(kind, _OTHER)[1]) for n, (_, kind) in enumerate(self.columns)]
        return pa.struct([("row", pa.int64()), *fields])


_HEAD = (
    "obj int, stream int, row bigint, parent string, idx int, suffix string, pos array<int>, "
    "odd array<string>, notes array<string>, error string"
)
_HEAD_ARROW = [
    ("obj", pa.int32()), ("stream", pa.int32()), ("row", pa.int64()), ("parent", pa.string()),
    ("idx", pa.int32()), ("suffix", pa.string()), ("pos", pa.list_(pa.int32())),
    ("odd", _LIST), ("notes", _LIST), ("error", pa.string()),
]


def pieces_schema(targets: dict[Lineage, Target]) -> str:
    """One row per stream row: ids, values by type in the stream's struct, and
    `odd`, the cells of values that need a converter (null for most rows)."""
    return ", ".join([_HEAD, *(target.ddl for target in targets.values())])


_NAMED_ARROW = pa.schema(
    [("obj", pa.int32()), ("lineage", pa.list_(_LIST)), ("row", pa.int64()), ("seq", pa.int32()), ("names", _LIST),
     ("cells", _LIST), ("containers", _LIST), ("notes", _LIST), ("error", pa.string())]
)


class _Rows:
    """Collects the rows of one stream as typed columns."""

    def __init__(self, target: Target):
        self.target = target
        self.places = {
            name: (n, _DIRECT.get(kind, _OTHER)[0]) for n, (name, kind) in enumerate(target.columns)
        }
        self.rows: list[list] = []
        self.at: list[int] = []

    def add(self, at: int, row: int, values: dict[str, Any]) -> tuple[list | None, list[str]]:
        """Add a row; give its odd cells, and the names of values no column takes."""
        cells: list[Any] = [None] * (len(self.places) + 1)
        cells[-1] = row
        odd: list[str | None] | None = None
        dropped: list[str] = []
        places = self.places
        for name, value in values.items():
            if value is None:
                continue
            place = places.get(name)
            if place is None:
                dropped.append(name)
                continue
            number, wanted = place
            kind = type(value)
            if kind is wanted and (kind is not int or -(1 << 63) <= value < 1 << 63):
                if kind is not float or math.isfinite(value):
                    cells[number] = value
            elif kind is int and wanted is float and abs(value) <= 1 << 53:
                cells[number] = float(value)
            else:
                if odd is None:
                    odd = [None] * len(places)
                odd[number] = tag(value)
        self.rows.append(cells)
        self.at.append(at)
        return odd, dropped

    def column(self, length: int) -> pa.Array:
        """The rows as a struct column, null in the rows of other streams."""
        arrow = self.target.arrow
        if not self.rows:
            return pa.nulls(length, arrow)
        *values, numbers = zip(*self.rows)
        children = [pa.array(numbers, pa.int64())]
        children += [pa.array(cells, field.type) for cells, field in zip(values, list(arrow)[1:])]
        dense = pa.StructArray.from_arrays(children, fields=list(arrow))
        if len(self.rows) < length:
            places = np.full(length, -1)
            places[self.at] = np.arange(len(self.rows))
            dense = dense.take(pa.array(places, mask=places < 0))
        self.rows, self.at = [], []
        return dense


def piece_batches(
    records: Iterable[Record], targets: dict[Lineage, Target]
) -> Iterator[pa.RecordBatch]:
    """Pieces of the wanted streams."""
    streams = {lineage: _Rows(target) for lineage, target in targets.items()}
    root = streams.get(())
    reached = frozenset(lineage[:depth] for lineage in targets for depth in range(len(lineage) + 1))
    schema = pa.schema(_HEAD_ARROW + [(f"s{t.number}", t.arrow) for t in targets.values()])
    reported: set[tuple[int, str]] = set()
    heads: list[tuple] = []
    size = 0

    def told(number: int, dropped: list[str], renamed: list[str]) -> list[str] | None:
        """Each task tells a note once, not on every row."""
        notes = [f"drop:{name}" for name in dropped] + [f"rename:{note}" for note in renamed]
        fresh = [note for note in notes if (number, note) not in reported] or None
        reported.update((number, note) for note in notes)
        return fresh

    def batch() -> pa.RecordBatch:
        columns = [pa.array(cells, kind) for cells, (_, kind) in zip(zip(*heads), _HEAD_ARROW)]
        columns += [rows.column(len(heads)) for rows in streams.values()]
        heads.clear()
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for record in records:
        if record.error is not None:
            heads.append((record.obj, -1, record.row, None, None, None, None, None, None, record.error))
        elif (plain := _plain_row(record.value)) is not None:
            # Most records; they have no child rows.
            if root is not None:
                values, renamed = plain
                odd, dropped = root.add(len(heads), record.row, values)
                notes = told(root.target.number, dropped, renamed) if dropped or renamed else None
                heads.append(
                    (record.obj, root.target.number, record.row, None, None, f"#{record.row}", (), odd, notes, None)
                )
        else:
            for part in parts(record.value, record.row, reached):
                rows = streams.get(part.lineage)
                if rows is None:
                    continue
                number = rows.target.number
                odd, dropped = rows.add(len(heads), record.row, part.values)
                notes = told(number, dropped, part.renamed) if dropped or part.renamed else None
                heads.append(
                    (record.obj, number, record.row, part.parent, part.index, part.suffix,
                     part.position, odd, notes, None)
                )
        size += record.size
        if len(heads) >= _BATCH or size >= _BATCH_BYTES:
            size = 0
            if heads:
                yield batch()
    if heads:
        yield batch()


def named_batches(records: Iterable[Record]) -> Iterator[pa.RecordBatch]:
    """Pieces with their column names, for discovery."""

    def rows():
        for record in records:
            if record.error is not None:
                yield (record.obj, None, record.row, 0, None, None, None, None, record.error)
                continue
            for seq, part in enumerate(parts(record.value, record.row)):
                yield (
                    record.obj, part.lineage, record.row, seq, list(part.values),
                    [tag(value) for value in part.values.values()],
                    sorted(part.containers), part.renamed, None,
                )

    return _batches(rows(), _NAMED_ARROW)
