"""Take typed, nested rows apart: structs to columns, lists of structs to tables.

Everything is decided from the schema. A stream's rows are one projection over
the scan, with a `posexplode` per list on its way, so Spark prunes the columns
and nested fields the stream doesn't need.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloader.functions import kinds as K
from lakeloader.functions.names import Lineage, Path, column_name, parent_column, path_name
from lakeloader.model import MAX_DEPTH


@dataclass
class Table:
    """What a schema holds for one stream."""

    leaves: dict[str, tuple[Path, T.DataType]] = field(default_factory=dict)
    lists: dict[Path, T.StructType] = field(default_factory=dict)
    containers: set[str] = field(default_factory=set)
    renamed: list[str] = field(default_factory=list)
    level: int = 0

    @property
    def plain(self) -> dict[str, tuple[Path, T.DataType]]:
        """Top-level columns that are neither objects nor lists, by parent column."""
        return {
            parent_column(path[0]): (path, data_type)
            for path, data_type in self.leaves.values()
            if len(path) == 1 and not isinstance(data_type, _NESTED)
        }


_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _table(struct: T.StructType, level: int, child: bool) -> Table:
    table = Table(level=level)
    open_fields = [((f.name,), f.dataType) for f in reversed(struct.fields)]
    while open_fields:
        path, data_type = open_fields.pop()
        name = column_name(path, child)
        capped = level + len(path) >= MAX_DEPTH
        is_list = isinstance(data_type, T.ArrayType)
        item = data_type.elementType if is_list else None
        if isinstance(data_type, T.StructType):
            table.containers.add(name)
        if isinstance(data_type, T.StructType) and not capped:
            open_fields.extend((path + (f.name,), f.dataType) for f in reversed(data_type.fields))
            continue
        if isinstance(item, T.StructType) and not capped:
            table.containers.add(name)
            table.lists[path] = item
            continue
        table.leaves[name] = (path, data_type)
        if len(path) == 1 and name != path[0]:
            table.renamed.append(f"{path[0]} to {name}")
    return table


def tables(schema: T.StructType) -> dict[Lineage, Table]:
    """Every stream a schema holds, parents before children."""
    found: dict[Lineage, Table] = {(): _table(schema, 0, False)}
    pending: list[Lineage] = [()]
    while pending:
        lineage = pending.pop(0)
        table = found[lineage]
        for path, item in table.lists.items():
            found[lineage + (path,)] = _table(item, table.level + len(path), True)
            pending.append(lineage + (path,))
    return found


def column_kinds(found: dict[Lineage, Table], lineage: Lineage) -> list[tuple[str, str]]:
    """A stream's columns in order: its own, then its parent's plain values."""
    own = [(name, K.kind_of_type(kind)) for name, (_, kind) in found[lineage].leaves.items()]
    if not lineage:
        return own
    parents = found[lineage[:-1]].plain
    return own + [(name, K.kind_of_type(kind)) for name, (_, kind) in parents.items()]


def _pick(struct: T.StructType, wanted: dict[Path, T.DataType]) -> T.StructType:
    """The parts of a struct on the way to some paths, with the types given there."""
    kept = []
    for part in struct.fields:
        below = {path[1:]: kind for path, kind in wanted.items() if path[0] == part.name}
        if () in below:
            kept.append(T.StructField(part.name, below[()]))
        elif below:
            kept.append(T.StructField(part.name, _pick(part.dataType, below)))
    return T.StructType(kept)


def needed_schema(
    schema: T.StructType, found: dict[Lineage, Table], lineage: Lineage, columns: list[str]
) -> T.StructType:
    """The part of a schema that one stream's columns need, down to the items of lists."""
    table = found[lineage]
    wanted = {path: kind for name, (path, kind) in table.leaves.items() if name in columns}
    inner: T.StructType | None = None
    for depth in range(len(lineage), -1, -1):
        table = found[lineage[:depth]]
        struct = found[lineage[: depth - 1]].lists[lineage[depth - 1]] if depth else schema
        if depth == len(lineage) - 1:
            wanted = {path: kind for name, (path, kind) in table.plain.items() if name in columns}
        if inner is not None:
            wanted[lineage[depth]] = T.ArrayType(inner)
        # Something must be read to see whether an item is there.
        inner = _pick(struct, wanted) if wanted or not depth else struct
        wanted = {}
    return inner


def _reach(record: Column, path: Path) -> Column:
    for key in path:
        record = record.getField(key)
    return record


def stream_rows(
    records: DataFrame, found: dict[Lineage, Table], lineage: Lineage, columns: list[str]
) -> tuple[DataFrame, dict[str, tuple[Column, T.DataType]]]:
    """The rows of one stream, and how to reach each of its columns.

    `records` has `obj`, `row` and the file's row as the struct `rec`. The
    result keeps those ids and adds `parent`, `idx`, `suffix` (the row key
    below the object key) and `pos`, the item's place in every list above it.
    """
    rows = records.select(
        "obj",
        "row",
        F.lit(None).cast("string").alias("parent"),
        F.lit(None).cast("int").alias("idx"),
        F.concat(F.lit("#"), F.col("row").cast("string")).alias("suffix"),
        F.array().cast("array<int>").alias("pos"),
        F.col("rec").alias("item"),
    )
    parents: dict[str, tuple[Path, T.DataType]] = {}
    for depth, path in enumerate(lineage):
        last = depth == len(lineage) - 1
        plain = found[lineage[:depth]].plain
        parents = {name: plain[name] for name in columns if last and name in plain}
        carried = [
            _reach(F.col("item"), parent_path).alias(f"up{number}")
            for number, (parent_path, _) in enumerate(parents.values())
        ]
        rows = rows.select(
            "obj",
            "row",
            F.col("suffix").alias("parent"),
            "pos",
            *carried,
            F.posexplode(_reach(F.col("item"), path)).alias("idx", "item"),
        ).where(F.col("item").isNotNull())
        rows = rows.select(
            "obj",
            "row",
            "parent",
            "idx",
            F.concat("parent", F.lit(f"/{path_name(path)}#"), F.col("idx").cast("string")).alias("suffix"),
            F.concat("pos", F.array("idx")).alias("pos"),
            "item",
            *[f"up{number}" for number in range(len(parents))],
        )
    values = {
        name: (_reach(F.col("item"), path), data_type)
        for name, (path, data_type) in found[lineage].leaves.items()
        if name in columns
    }
    for number, (name, (_, data_type)) in enumerate(parents.items()):
        values[name] = (F.col(f"up{number}"), data_type)
    return rows, values
