"""The catalog: streams, their columns, and how child streams hang on others."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeloader.functions import kinds as K
from lakeloader.functions.names import Lineage, NameBook, Path, child_stream_name
from lakeloader.model import (
    CHILD_KEYS,
    CHILD_METADATA,
    INDEX,
    KEY,
    LAST_MODIFIED,
    PARENT_ROW,
    ROOT_KEYS,
    ROOT_METADATA,
    ROW_KEY,
    ROW_NUMBER,
)
from lakeloader.session import local_frame

_METADATA_KINDS = {
    KEY: K.STRING,
    LAST_MODIFIED: K.DATE_TIME,
    ROW_NUMBER: K.INTEGER,
    PARENT_ROW: K.STRING,
    INDEX: K.INTEGER,
    ROW_KEY: K.STRING,
}
_PARENT_STREAM, _LIST_PATH = "parent-stream", "list-path"
CATALOG_SCHEMA = (
    "stream string, parent_stream string, list_path array<string>, column string, "
    "ordinal int, kind string, selected boolean, stream_selected boolean, full_table boolean"
)


@dataclass(frozen=True)
class Column:
    """A data column."""

    name: str
    kind: str
    selected: bool = True


@dataclass(frozen=True)
class Stream:
    """A stream and its data columns. Metadata columns are always there."""

    name: str
    columns: tuple[Column, ...] = ()
    parent: str | None = None
    list_path: Path | None = None
    selected: bool = True
    full_table: bool = False

    @property
    def metadata(self) -> tuple[str, ...]:
        return ROOT_METADATA if self.parent is None else CHILD_METADATA

    @property
    def keys(self) -> tuple[str, ...]:
        return ROOT_KEYS if self.parent is None else CHILD_KEYS

    @property
    def taken(self) -> tuple[Column, ...]:
        """The selected data columns."""
        return tuple(column for column in self.columns if column.selected)

    def schema(self) -> T.StructType:
        """The schema of the stream's rows."""
        fields = [K.spark_field(column.name, column.kind) for column in self.taken]
        fields += [K.spark_field(name, _METADATA_KINDS[name], False) for name in self.metadata]
        return T.StructType(fields)


@dataclass(frozen=True)
class Group:
    """A file stream and the child streams that read the same objects."""

    root: str
    members: dict[Lineage, Stream]

    def active(self) -> dict[Lineage, Stream]:
        return {lineage: stream for lineage, stream in self.members.items() if stream.selected}


@dataclass
class Catalog:
    """All streams by name."""

    streams: dict[str, Stream] = field(default_factory=dict)

    def add(self, stream: Stream) -> None:
        self.streams[stream.name] = stream

    def select(self, *names: str) -> Catalog:
        """Select only the named streams."""
        return Catalog({n: replace(s, selected=n in names) for n, s in self.streams.items()})

    def deselect_columns(self, stream: str, *names: str) -> Catalog:
        """Leave columns of a stream out. Keys can't be left out."""
        changed = tuple(
            replace(column, selected=column.selected and column.name not in names)
            for column in self.streams[stream].columns
        )
        return Catalog({**self.streams, stream: replace(self.streams[stream], columns=changed)})

    def with_kind(self, stream: str, column: str, kind: str) -> Catalog:
        """Give a column another kind, adding it if it is new."""
        old = self.streams[stream]
        columns = [replace(c, kind=kind) if c.name == column else c for c in old.columns]
        if column not in {c.name for c in old.columns}:
            columns.append(Column(column, kind))
        return Catalog({**self.streams, stream: replace(old, columns=tuple(columns))})

    def link(self, file_streams: Iterable[str] | None = None) -> tuple[list[Group], dict[str, str]]:
        """Group child streams under their file streams, by recorded parent and path.

        A file stream that is left out of the catalog, but is among
        `file_streams`, still reads objects for its children. Children that
        can't be linked are given with the reason.
        """
        known = set(file_streams) if file_streams is not None else None
        groups = {n: {(): s} for n, s in self.streams.items() if s.parent is None}
        skipped: dict[str, str] = {}
        for name in sorted(n for n, s in self.streams.items() if s.parent is not None):
            lineage: Lineage = ()
            seen, current = set(), name
            while current in self.streams and self.streams[current].parent is not None:
                stream = self.streams[current]
                if not stream.list_path or current in seen:
                    break
                seen.add(current)
                lineage = (stream.list_path, *lineage)
                current = stream.parent
            stream = self.streams.get(current)
            if stream is not None and stream.parent is not None:
                skipped[name] = (
                    f"the parent streams of '{name}' form a circle"
                    if stream.list_path
                    else f"the list path of '{current}' is not valid"
                )
            elif stream is None and (known is None or current not in known):
                skipped[name] = f"its parent stream '{current}' is missing"
            else:
                hidden = {(): Stream(current, selected=False)}
                groups.setdefault(current, hidden)[lineage] = self.streams[name]
        return [Group(root, members) for root, members in sorted(groups.items())], skipped

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """One row per column; a stream without columns has one row with a null column."""
        rows = []
        for stream in self.streams.values():
            path = list(stream.list_path) if stream.list_path is not None else None
            head = (stream.name, stream.parent, path)
            tail = (stream.selected, stream.full_table)
            for ordinal, column in enumerate(stream.columns or (Column(None, None),)):
                rows.append((*head, column.name, ordinal, column.kind, column.selected, *tail))
        return local_frame(spark, rows, CATALOG_SCHEMA)

    @staticmethod
    def from_frame(frame: DataFrame) -> Catalog:
        """The inverse of `to_frame`."""
        catalog, columns = Catalog(), {}
        for row in sorted(frame.collect(), key=lambda row: (row.stream, row.ordinal)):
            columns.setdefault(row.stream, [])
            if row.column is not None:
                columns[row.stream].append(Column(row.column, row.kind, row.selected))
            path = tuple(row.list_path) if row.list_path is not None else None
            catalog.add(
                Stream(
                    row.stream, tuple(columns[row.stream]), row.parent_stream, path,
                    row.stream_selected, row.full_table,
                )
            )
        return catalog

    def to_json(self) -> str:
        """The catalog as a JSON document of stream entries."""
        return json.dumps({"streams": [_entry(stream) for stream in self.streams.values()]}, indent=2)

    @staticmethod
    def from_json(text: str) -> Catalog:
        """Read a JSON catalog, also one saved elsewhere.

        Parent and list path are the metadata keys that end in `parent-stream`
        and `list-path`, whatever stands before a dot in them.
        """
        catalog = Catalog()
        for entry in json.loads(text)["streams"]:
            catalog.add(_stream(entry))
        return catalog


def _entry(stream: Stream) -> dict:
    own: dict = {"selected": stream.selected, "inclusion": "available"}
    if stream.parent is not None:
        own |= {_PARENT_STREAM: stream.parent, _LIST_PATH: list(stream.list_path or ())}
    properties = {column.name: K.json_property(column.kind) for column in stream.columns}
    metadata = [
        {"breadcrumb": ["properties", column.name],
         "metadata": {"inclusion": "available", "selected": column.selected}}
        for column in stream.columns
    ]
    for name in stream.metadata:
        properties[name] = K.json_property(_METADATA_KINDS[name], nullable=False)
        metadata.append(
            {"breadcrumb": ["properties", name], "metadata": {"inclusion": "automatic"}}
        )
    return {
        "tap_stream_id": stream.name,
        "stream": stream.name,
        "key_properties": list(stream.keys),
        "replication_key": LAST_MODIFIED,
        "replication_method": "FULL_TABLE" if stream.full_table else "INCREMENTAL",
        "schema": {"type": "object", "properties": properties},
        "metadata": [{"breadcrumb": [], "metadata": own}, *metadata],
    }


def _stream(entry: dict) -> Stream:
    metadata = {tuple(m["breadcrumb"]): m.get("metadata", {}) for m in entry.get("metadata", [])}
    own = {key.rpartition(".")[2]: value for key, value in metadata.get((), {}).items()}
    parent, path = own.get(_PARENT_STREAM), own.get(_LIST_PATH)
    valid = (
        isinstance(path, list) and bool(path) and all(isinstance(part, str) for part in path)
    )
    reserved = ROOT_METADATA if parent is None else CHILD_METADATA
    columns = tuple(
        Column(
            name, K.kind_of_property(schema),
            metadata.get(("properties", name), {}).get("selected", True) is not False,
        )
        for name, schema in entry.get("schema", {}).get("properties", {}).items()
        if name not in reserved
    )
    method = own.get("forced-replication-method") or entry.get("replication_method")
    return Stream(
        entry.get("stream") or entry["tap_stream_id"], columns,
        None if parent is None else str(parent), tuple(path) if valid else None,
        own.get("selected", True) is not False, method == "FULL_TABLE",
    )


@dataclass(frozen=True)
class PlannedChild:
    """A child stream, its final name, and the name it would have without clashes."""

    name: str
    natural: str
    parent: str
    root: str
    lineage: Lineage


def plan_child_names(
    children: Iterable[tuple[str, Lineage]], file_streams: Iterable[str]
) -> Iterator[PlannedChild]:
    """Name child streams, one level of nesting after the other.

    A name is made of the parent stream's own, final one. Names of file streams and
    of levels above are taken.
    """
    book = NameBook(file_streams)
    levels: dict[int, list[tuple[str, Lineage]]] = {}
    for root, lineage in children:
        levels.setdefault(len(lineage), []).append((root, lineage))
    above: dict[tuple[str, Lineage], str] = {}
    for depth in sorted(levels):
        level = {}
        for root, lineage in sorted(levels[depth]):
            parent = above.get((root, lineage[:-1]), root)
            natural = child_stream_name(parent, lineage[-1])
            level[root, lineage] = book.claim(natural)
            yield PlannedChild(level[root, lineage], natural, parent, root, lineage)
        above = level
