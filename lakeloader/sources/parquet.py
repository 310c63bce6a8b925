"""Parquet objects, grouped by schema so that every group is one scan: a native one, or one by row groups."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from lakeloader.session import local_frame, spread_tasks
from lakeloader.sources.heads import open_file
from lakeloader.sources.listing import escape_paths
from lakeloader.sources.textscan import TASK_BYTES, ScanObject

_BATCH_ROWS, _BATCH_BYTES = 10_000, 16 << 20


def merge_schemas(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """One type that reads files of both, or None when a column's types differ."""
    if isinstance(left, T.StructType) and isinstance(right, T.StructType):
        fields = {field.name: field.dataType for field in left.fields}
        for field in right.fields:
            known = fields.get(field.name)
            merged = field.dataType if known is None else merge_schemas(known, field.dataType)
            if merged is None:
                return None
            fields[field.name] = merged
        return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        merged = merge_schemas(left.elementType, right.elementType)
        return None if merged is None else T.ArrayType(merged)
    return left if left == right else None


@dataclass(frozen=True)
class SchemaGroup:
    """Objects that one scan can read. `uniform` ones all have just this schema."""

    schema: T.StructType
    objects: list[ScanObject]
    uniform: bool = True


def schema_groups(
    spark: SparkSession, objects: list[ScanObject], schemas: dict[int, bytes]
) -> list[SchemaGroup]:
    """Group objects into as few scans as their column types allow.

    Spark reads one footer per distinct schema; the distinct schemas come from
    the head probe.
    """
    groups: list[SchemaGroup] = []
    by_schema = sorted(objects, key=lambda item: schemas[item.obj])
    for _, same in itertools.groupby(by_schema, key=lambda item: schemas[item.obj]):
        members = list(same)
        schema = spark.read.option("recursiveFileLookup", "true").parquet(
            *escape_paths([members[0].path])
        ).schema
        for place, group in enumerate(groups):
            merged = merge_schemas(group.schema, schema)
            if merged is not None:
                groups[place] = SchemaGroup(merged, group.objects + members, False)
                break
        else:
            groups.append(SchemaGroup(merge_schemas(schema, schema) or schema, members))
    return groups


def scan_group(spark: SparkSession, schema: T.StructType, objects: list[ScanObject]) -> DataFrame:
    """A group's rows as `file, row, rec`, numbered from 1 in each file."""
    rows = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .parquet(*escape_paths([item.path for item in objects]))
    )
    place = rows.metadataColumn("_metadata")
    columns = [rows[_quoted(name)] for name in schema.fieldNames()]
    record = F.struct(*columns) if columns else F.struct()
    return rows.select(
        place.getField("file_path").alias("file"),
        (place.getField("row_index") + 1).alias("row"),
        record.alias("rec"),
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def readable_type(kind: pa.DataType, path: tuple[str, ...] = (), dated: frozenset | None = None) -> pa.DataType:
    """The type a value has for Spark. `dated` tells which nanosecond timestamps become
    timestamps, by their path without lists; the others become text, and all do not if it is None.
    """
    types = pa.types
    if types.is_dictionary(kind):
        return readable_type(kind.value_type, path, dated)
    if types.is_struct(kind):
        fields = [kind.field(n) for n in range(kind.num_fields)]
        return pa.struct([pa.field(f.name, readable_type(f.type, path + (f.name,), dated)) for f in fields])
    if types.is_map(kind):
        whole = path + ("",)
        return pa.map_(readable_type(kind.key_type, whole, dated), readable_type(kind.item_type, whole, dated))
    if types.is_list(kind) or types.is_large_list(kind) or types.is_fixed_size_list(kind):
        # A list of plain values is kept as a whole; one of objects is a table of its own.
        inner = path if types.is_struct(kind.value_type) else path + ("",)
        return pa.list_(readable_type(kind.value_type, inner, dated))
    if types.is_timestamp(kind):
        if kind.unit == "ns" and dated is not None and path not in dated:
            return pa.string()
        return pa.timestamp("us", "UTC" if kind.tz else None)
    if types.is_time(kind) or types.is_duration(kind) or types.is_null(kind) or types.is_large_string(kind):
        return pa.string()
    if types.is_uint64(kind):
        return pa.decimal128(20, 0)
    if types.is_unsigned_integer(kind):
        return pa.int64()
    if types.is_float16(kind):
        return pa.float32()
    if types.is_date(kind):
        return pa.date32()
    return pa.binary() if types.is_large_binary(kind) or types.is_fixed_size_binary(kind) else kind


def _nanos_text(array: pa.Array) -> pa.Array:
    numbers = array.cast(pa.int64()).fill_null(0).to_numpy()
    clock = pc.strftime(pa.array(numbers // 10**9).cast(pa.timestamp("s")), "%Y-%m-%dT%H:%M:%S").to_pylist()
    made = []
    for text, rest, known in zip(clock, (numbers % 10**9).tolist(), array.is_valid().to_pylist()):
        digits = "" if rest == 0 else f".{rest // 1000:06d}" if rest % 1000 == 0 else f".{rest:09d}"
        made.append(f"{text}{digits}+00:00" if known else None)
    return pa.array(made, pa.string())


def readable(array: pa.Array, kind: pa.DataType) -> pa.Array:
    """An array in the type `readable_type` gives it. Timestamps are cut to microseconds."""
    types, own = pa.types, array.type
    if own == kind:
        return array
    if types.is_dictionary(own):
        return readable(array.dictionary_decode(), kind)
    if types.is_struct(own):
        parts = [readable(part, kind.field(n).type) for n, part in enumerate(array.flatten())]
        return pa.StructArray.from_arrays(parts, fields=list(kind), mask=array.is_null())
    if types.is_list(kind):
        if types.is_fixed_size_list(own):
            return readable(array.cast(pa.list_(own.value_type)), kind)
        lengths = pc.fill_null(pc.list_value_length(array), 0).to_numpy()
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), readable(array.flatten(), kind.value_type), type=kind, mask=array.is_null())
    if types.is_map(kind):
        keys, items = ([pair[n] for row in array.to_pylist() for pair in row or ()] for n in (0, 1))
        lengths = np.array([len(row or ()) for row in array.to_pylist()], np.int64)
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths))).astype(np.int32)
        keys, items = (readable(pa.array(x, y), z) for x, y, z in ((keys, own.key_type, kind.key_type), (items, own.item_type, kind.item_type)))
        return pa.MapArray.from_arrays(pa.array(ends), keys, items, mask=array.is_null())
    if types.is_timestamp(own) and own.unit == "ns":
        if types.is_string(kind):
            return _nanos_text(array)
        numbers = array.cast(pa.int64()).fill_null(0).to_numpy() // 1000
        return pa.array(numbers, mask=array.is_null().to_numpy(zero_copy_only=False)).cast(kind)
    if types.is_time(own):
        return pa.array([None if x is None else x.isoformat() for x in array.to_pylist()], kind)
    if types.is_duration(own):
        return pa.array([None if x is None else str(x) for x in array.to_pylist()], kind)
    return array.cast(kind)


class RowGroups:
    """Parquet objects with types Spark lacks. A task reads row groups one after the other, as Arrow batches.

    `objects` have one schema. Columns come in the types of `readable_type`.
    """

    def __init__(self, spark: SparkSession, schema: pa.Schema, objects: list[ScanObject], groups: dict[int, list[int]]):
        self.spark, self.schema = spark, schema
        self.units = [
            (item.obj, item.path, item.file, number, before)
            for item in objects
            for number, before in enumerate(itertools.accumulate(groups[item.obj][:-1], initial=0))
            if groups[item.obj]
        ]
        # Small row groups share a task; one of `TASK_BYTES` has its own.
        size = sum(item.size for item in objects)
        self.tasks = min(len(self.units), max(spread_tasks(spark), -(-size // TASK_BYTES)))

    def spark_schema(self, dated: frozenset | None = None) -> T.StructType:
        """The rows' type for Spark."""
        fields = [pa.field(field.name, readable_type(field.type, (field.name,), dated)) for field in self.schema]
        return from_arrow_schema(pa.schema(fields), prefer_timestamp_ntz=True)

    def rows(self, names: list[str], dated: frozenset) -> DataFrame:
        """`obj, row, rec` with some of the top-level columns, rows numbered from 1 in each object."""
        kept = [self.schema.field(name) for name in names]
        kinds = [readable_type(field.type, (field.name,), dated) for field in kept]
        record = pa.struct([pa.field(field.name, kind) for field, kind in zip(kept, kinds)])

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for unit in batch.to_pylist():
                    yield from _read_group(unit, names, record)

        units = local_frame(self.spark, self.units, "obj int, path string, file string, number int, first bigint")
        if self.tasks > 1:
            units = units.repartition(self.tasks)
        schema = from_arrow_schema(pa.schema([("obj", pa.int32()), ("row", pa.int64()), ("rec", record)]), prefer_timestamp_ntz=True)
        return units.mapInArrow(read, schema)


def _read_group(unit: dict, names: list[str], record: pa.StructType) -> Iterator[pa.RecordBatch]:
    system, place = open_file(unit["path"])
    try:
        with system.open_input_file(place) as handle:
            # Column chunks come through buffers, not as a whole.
            file = pq.ParquetFile(handle, buffer_size=1 << 20, pre_buffer=False)
            group = file.metadata.row_group(unit["number"])
            size = max(1, min(_BATCH_ROWS, _BATCH_BYTES * group.num_rows // max(group.total_byte_size, 1)))
            row = unit["first"]
            for batch in file.iter_batches(size, row_groups=[unit["number"]], columns=names):
                parts = [readable(batch.column(field.name), field.type) for field in record]
                whole = pa.StructArray.from_arrays(parts, fields=list(record))
                numbers = pa.array(np.arange(row + 1, row + 1 + batch.num_rows))
                yield pa.record_batch([pa.repeat(pa.scalar(unit["obj"], pa.int32()), batch.num_rows), numbers, whole], ["obj", "row", "rec"])
                row += batch.num_rows
    except (OSError, ValueError, pa.ArrowException) as err:
        # In the words of Spark's own readers, so that the object is found.
        raise OSError(f"a failure while reading file {unit['file']}. Details: {type(err).__name__}: {err}") from err
