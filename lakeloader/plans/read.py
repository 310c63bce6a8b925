"""Read a batch of objects into the rows of every stream of a group.

A batch is bounded (see `sync`), so the driver may hold one small entry per
object of it: paths, file heads, and split positions. Rows stay in the cluster.

Every stream's rows come as a DataFrame with the stream's columns and, for the
caller, `__obj`, `__row`, `__pos` (read order), `__notes` and `__error`.
Internal names start with `__`, which no data column can.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloader.functions import kinds as K
from lakeloader.functions.convert import Converted, convert_cell, convert_native, convert_text, error_text
from lakeloader.functions.datetimes import iso_timestamp
from lakeloader.functions.names import Lineage, top_level_name
from lakeloader.model import (
    DELIMITED, INDEX, JSON, JSONL, KEY, LAST_MODIFIED, PARENT_ROW, PARQUET, ROW_KEY, ROW_NUMBER,
    LoadError, ObjectChanged,
)
from lakeloader.operators import columnar
from lakeloader.operators.pieces import NAMED, Target, named_batches, piece_batches, pieces_schema
from lakeloader.plans.catalog import Group, Stream
from lakeloader.session import fresh_folder, local_frame, spread_tasks
from lakeloader.sources.delimited import Delimited, DelimitedFile
from lakeloader.sources.document import Documents
from lakeloader.sources.heads import HEADS, heads, inflate
from lakeloader.sources.jsonl import JsonLines
from lakeloader.sources.listing import escape_paths, file_facts
from lakeloader.sources.parquet import RowGroups, SchemaGroup, scan_group, schema_groups
from lakeloader.sources.textscan import ScanObject

OBJ, ROW, POS, NOTES, ERROR = "__obj", "__row", "__pos", "__notes", "__error"
INTERNAL = (OBJ, ROW, POS, NOTES, ERROR)
_MANIFEST = ("key", "path", "last_modified", "size", "etag", "kind", "extension", "compressed")


def location_of(path: str) -> str:
    """A path without its scheme's spelling, to match `file:/x` and `file:///x`."""
    return re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:/*|^/+", "", path)


@dataclass
class Batch:
    """The objects of one batch, numbered in read order, as they are right now."""

    spark: SparkSession
    objects: list[ScanObject]
    modified: dict[int, object]
    versions: dict[int, tuple]
    heads: dict[int, dict] = field(default_factory=dict)
    readers: dict[int, set[str]] = field(default_factory=dict)
    changed: dict[str, str] = field(default_factory=dict)
    #: Decompressed copies of objects that can't be read as a stream.
    unpacked: dict[int, ScanObject] = field(default_factory=dict)
    #: The files of the batch as they are whenever this runs.
    files: DataFrame | None = None

    @staticmethod
    def collect(manifest: DataFrame, skip_changed: bool = False) -> Batch:
        """Take a batch's manifest rows, and look at the objects once more.

        Gives the file names as Spark spells them, and today's versions. An
        object whose size or storage time differs from the listing has changed,
        which is an error, or leaves it out if `skip_changed` is set; `changed`
        then tells which, the first one in read order first.
        """
        spark = manifest.sparkSession
        columns = [*_MANIFEST, *(n for n in ("readers", "stored_at") if n in manifest.columns)]
        rows = sorted(
            manifest.select(*columns).collect(), key=lambda row: (row.last_modified, row.key)
        )
        files = _files(spark, [row.path for row in rows])
        found = _look(files)
        objects, modified, versions, readers, changed = [], {}, {}, {}, {}
        for number, row in enumerate(rows):
            seen = found.get(location_of(row.path)) or found.get(location_of(unquote(row.path)))
            stored_at = row.stored_at if "stored_at" in columns else None
            if seen is None or seen[3] != row.size or stored_at not in (None, seen[2]):
                changed[row.key] = f"{row.key} changed during the sync"
                if skip_changed:
                    continue
                raise ObjectChanged(changed[row.key])
            file, path, time, size = seen
            objects.append(
                ScanObject(number, row.key, path, file, size, row.kind, row.extension, row.compressed)
            )
            modified[number], versions[number] = row.last_modified, (time, size)
            readers[number] = set(row.readers) if "readers" in columns else set()
        return Batch(spark, objects, modified, versions, {}, readers, changed, files=files)

    def subset(self, numbers: set[int]) -> Batch:
        """The same batch with fewer objects."""
        keep = [item for item in self.objects if item.obj in numbers]
        return replace(self, objects=keep)

    def renumbered(self, base: int) -> Batch:
        """The same batch with its numbers moved up."""
        objects = [replace(item, obj=item.obj + base) for item in self.objects]
        return Batch(
            self.spark, objects, {n + base: time for n, time in self.modified.items()},
            {n + base: version for n, version in self.versions.items()}, {}, {}, self.changed, files=self.files,
        )

    def read_heads(self, sample_rows: int = 0) -> None:
        """Probe the objects' heads, one small task per object."""
        todo = [item for item in self.objects if item.kind != JSONL and item.obj not in self.heads]
        if not todo:
            return
        self._unpack([item for item in todo if item.kind == PARQUET and item.compressed])
        todo = [self.unpacked.get(item.obj, item) for item in todo if item.obj not in self.heads]
        if not todo:
            return
        frame = local_frame(self.spark, 
            [(item.obj, item.path, False, item.kind, item.extension, item.compressed) for item in todo],
            "obj int, path string, encoded boolean, kind string, extension string, compressed boolean",
        ).repartition(min(len(todo), 4 * self.spark.sparkContext.defaultParallelism))
        for row in heads(frame, sample_rows).collect():
            self.heads[row.obj] = row.asDict()

    def _unpack(self, packed: list[ScanObject]) -> None:
        """Copy gzipped Parquet objects, whose footers can't be reached, into the shared folder."""
        if not packed:
            return
        items = local_frame(self.spark, [(item.obj, item.path) for item in packed], "obj int, path string")
        copies = {}
        for row in inflate(items.repartition(len(packed)), fresh_folder(self.spark, "inflated")).collect():
            if row.error:
                self.heads[row.obj] = dict.fromkeys(name.split()[0] for name in HEADS.split(", ")) | {"error": row.error}
            else:
                copies[row.obj] = row["copy"]
        found = _look(_files(self.spark, list(copies.values()))) if copies else {}
        for item in packed:
            if item.obj in copies:
                file, path, _, size = found[location_of(copies[item.obj])]
                self.unpacked[item.obj] = replace(item, path=path, file=file, size=size, compressed=False)

    def overwritten(self) -> list[ScanObject]:
        """The objects that were overwritten since the batch was collected, in read order."""
        found = _look(self.files)
        seen = {item.obj: found.get(location_of(item.path)) for item in self.objects}
        return [x for x in self.objects if seen[x.obj] is None or seen[x.obj][2:] != self.versions[x.obj]]

    def check_versions(self) -> None:
        """Fail if an object was overwritten since the batch was collected."""
        for item in self.overwritten():
            raise ObjectChanged(f"{item.key} changed during the sync")

    def of(self, *kinds: str) -> list[ScanObject]:
        return [self.unpacked.get(item.obj, item) for item in self.objects if item.kind in kinds]

    def places(self) -> DataFrame:
        """`__obj, __file, __key, __time`: one small row per object of the batch."""
        objects = [self.unpacked.get(item.obj, item) for item in self.objects]
        rows = [(i.obj, i.file, i.key, self.modified[i.obj]) for i in objects]
        schema = f"{OBJ} int, __file string, __key string, __time timestamp"
        return local_frame(self.spark, rows, schema).withColumn("__time", iso_timestamp(F.col("__time")))


def _files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The `file, path, time, size` of objects. They are listed once, and looked at whenever this runs."""
    found = file_facts(spark, escape_paths(paths))
    place = found.metadataColumn("_metadata")
    # Only facts are read, so a task takes many objects.
    return found.select(
        place.getField("file_path").alias("file"), "path", "modificationTime", "length"
    ).coalesce(spread_tasks(spark))


def _look(files: DataFrame) -> dict[str, tuple]:
    """Today's `(file, path, time, size)` of objects, by location."""
    return {location_of(row.path): tuple(row) for row in files.collect()}


def batch_errors(batch: Batch) -> list[tuple[int, str]]:
    """Objects whose head can't be read."""
    return [(obj, head["error"]) for obj, head in batch.heads.items() if head["error"]]


def _union(frames: Iterable[DataFrame]) -> DataFrame | None:
    frames = list(frames)
    if not frames:
        return None
    return functools.reduce(lambda a, b: a.unionByName(b), frames)


def json_records(batch: Batch, sample_rows: int | None = None) -> list[tuple[DataFrame, object]]:
    """The row-level lanes: scans, and what decodes a task's part of each."""
    spark, lanes = batch.spark, []
    lines = batch.of(JSONL)
    if lines:
        lane = JsonLines(spark, lines)
        lanes.append((lane.lines, lane.records))
    documents = [item for item in batch.of(JSON) if not batch.heads[item.obj]["error"]]
    if documents:
        arrays = {item.file for item in documents if batch.heads[item.obj]["root"] == "["}
        lane = Documents(spark, documents, arrays, sample_rows)
        if lane.pieces is not None:
            lanes.append((lane.pieces, lane.records))
        if lane.stitched is not None:
            lanes.append((lane.stitched, lane.stitched_records))
        for file, error in lane.failed.items():
            batch.heads[lane.numbers[file]]["error"] = error
    return lanes


def named_pieces(batch: Batch, sample_rows: int) -> DataFrame | None:
    """Pieces with column names, for discovery."""
    frames = []
    for scan, decode in json_records(batch, sample_rows):
        def task(batches, decode=decode):
            return named_batches(decode(batches))

        frames.append(scan.mapInArrow(task, NAMED))
    return _union(frames)


def pieces(lanes: list[tuple[DataFrame, object]], targets: dict[Lineage, Target]) -> DataFrame | None:
    """Pieces of the wanted streams, from the lanes of `json_records`."""
    frames = []
    for scan, decode in lanes:
        def task(batches, decode=decode):
            return piece_batches(decode(batches), targets)

        frames.append(scan.mapInArrow(task, pieces_schema(targets)))
    return _union(frames)


def _empty_pos() -> Column:
    return F.array().cast("array<int>").alias("pos")



def _converted(
    rows: DataFrame, stream: Stream, values: dict[str, tuple[Converted, Column]],
    error: Column | None = None, notes: Column | None = None,
) -> DataFrame:
    """Project raw rows onto a stream's columns. `values` gives (converted, shown) per column.

    The values come first, under their own names, so that each is computed
    once. Only where one is null its error flag is looked at.
    """
    made, outputs = [], []
    failures: list[Column] = [] if error is None else [error]
    for place, column in enumerate(stream.taken):
        target = K.spark_type(column.kind)
        found = values.get(column.name)
        if found is None:
            outputs.append(F.lit(None).cast(target).alias(column.name))
            continue
        converted, shown = found
        name = f"__value{place}"
        made.append(converted.value.cast(target).alias(name))
        outputs.append(F.col(name).alias(column.name))
        if converted.can_fail:
            failed = F.col(name).isNull() & converted.failed
            failures.append(F.when(failed, error_text(column.name, column.kind, shown)))
    return rows.select("*", *made).select(
        F.col("obj").alias(OBJ),
        F.col("row").alias(ROW),
        F.col("pos").alias(POS),
        F.col("parent").alias("__parent"),
        F.col("idx").alias("__idx"),
        F.col("suffix").alias("__suffix"),
        (notes if notes is not None else F.lit(None).cast("array<string>")).alias(NOTES),
        (F.coalesce(*failures) if failures else F.lit(None).cast("string")).alias(ERROR),
        *outputs,
    )


def _cell_rows(found: DataFrame, target: Target, stream: Stream) -> DataFrame:
    """A stream's rows from pieces, and the records that could not be read."""
    rows = found.where(F.col("stream").isin(target.number, -1))
    values = {}
    for place, column in enumerate(stream.taken):
        typed = F.col(f"s{target.number}").getField(f"v{place}")
        cell = F.get("odd", F.lit(place))
        other = convert_cell(cell, column.kind)
        if column.kind == K.DATE_TIME:
            direct = convert_text(typed, column.kind)
            other = Converted(
                F.when(typed.isNotNull(), direct.value).otherwise(other.value),
                F.coalesce(F.when(typed.isNotNull(), direct.failed), other.failed),
            )
            cell = F.coalesce(F.concat(F.lit("s"), typed), cell)
        elif column.kind in (K.WIDE_INTEGER, K.ANY, K.OBJECT, K.ARRAY):
            pass
        else:
            value = F.when(F.col("odd").isNull(), typed).otherwise(F.coalesce(typed, other.value))
            # An empty text is no error in any column.
            other = Converted(value, F.col("odd").isNotNull() & other.failed)
        values[column.name] = (other, F.substring(cell, 2, 200))
    return _converted(rows, stream, values, F.col("error"), F.col("notes"))


def _delimited_rows(batch: Batch, stream: Stream) -> DataFrame | None:
    files, readable = {}, []
    for item in batch.of(DELIMITED):
        head = batch.heads[item.obj]
        if not head["error"]:
            readable.append(item)
            files[item.file] = DelimitedFile(
                item.obj, head["delimiter"], list(head["header"]), head["header_blank"], head["line_sep"]
            )
    if not readable:
        return None
    columns = [column.name for column in stream.taken]
    cut = Delimited(batch.spark, readable, files, columns).rows()
    rows = cut.select(
        "*",
        _empty_pos(),
        F.lit(None).cast("string").alias("parent"),
        F.lit(None).cast("int").alias("idx"),
        F.lit(None).cast("string").alias("suffix"),
    )
    values = {}
    for place, column in enumerate(stream.taken):
        # An empty cell is null, in every column.
        text = F.nullif(F.col(f"c{place}"), F.lit(""))
        values[column.name] = (convert_text(text, column.kind), F.substring(text, 1, 200))
    return _converted(rows, stream, values, notes=F.col("notes"))


def _parquet_rows(
    batch: Batch, groups: list[SchemaGroup | RowGroups], lineage: Lineage, stream: Stream
) -> list[DataFrame]:
    frames = []
    places = batch.places().select(OBJ, F.col("__file").alias("file"))
    wanted = [column.name for column in stream.taken]
    for group in groups:
        if isinstance(group, RowGroups):
            frames += _row_group_rows(group, lineage, stream, wanted)
            continue
        found = columnar.tables(group.schema)
        if lineage not in found:
            continue
        # Objects without some of the fields must still show which items exist.
        schema = (
            columnar.needed_schema(group.schema, found, lineage, wanted) if group.uniform else group.schema
        )
        records = (
            scan_group(batch.spark, schema, group.objects)
            # One row per object of the batch, so this side is bounded.
            .join(F.broadcast(places), "file")
            .select(F.col(OBJ).alias("obj"), "row", "rec")
        )
        frames.append(_native_rows(records, found, lineage, stream, wanted))
    return frames


def _native_rows(
    records: DataFrame, found: dict[Lineage, columnar.Table], lineage: Lineage, stream: Stream, wanted: list[str]
) -> DataFrame:
    rows, reach = columnar.stream_rows(records, found, lineage, wanted)
    values = {}
    for column in stream.taken:
        if column.name in reach:
            value, data_type = reach[column.name]
            shown = (
                F.lit("of another type")
                if isinstance(data_type, (T.StructType, T.MapType, T.ArrayType, T.BinaryType))
                else F.substring(value.cast("string"), 1, 200)
            )
            values[column.name] = (convert_native(value, data_type, column.kind), shown)
    return _converted(rows, stream, values)


def _row_group_rows(group: RowGroups, lineage: Lineage, stream: Stream, wanted: list[str]) -> list[DataFrame]:
    """A stream's rows of objects that are read by row groups."""
    schema = group.spark_schema()
    found = columnar.tables(schema)
    if lineage not in found or not group.units:
        return []
    needed = columnar.needed_schema(schema, found, lineage, wanted)
    names = needed.fieldNames() or schema.fieldNames()[:1]
    # Only in columns of date-times a nanosecond timestamp is one; elsewhere it is text with all its digits.
    kinds = {column.name: column.kind for column in stream.taken}
    above = tuple(name for path in lineage for name in path)
    dated = {above + path for name, (path, _) in found[lineage].leaves.items() if kinds.get(name) in (K.DATE_TIME, K.DATE)}
    if lineage:
        upper = above[: len(above) - len(lineage[-1])]
        plain = found[lineage[:-1]].plain.items()
        dated |= {upper + path for name, (path, _) in plain if kinds.get(name) in (K.DATE_TIME, K.DATE)}
    records = group.rows(names, frozenset(dated))
    return [_native_rows(records, columnar.tables(group.spark_schema(frozenset(dated))), lineage, stream, wanted)]


def schema_notes(batch: Batch, group: Group) -> list[tuple[str, str]]:
    """Renamed columns of delimited and Parquet objects, as `(stream, note)`."""
    notes = set()
    for item in batch.of(DELIMITED):
        for name in batch.heads.get(item.obj, {}).get("header") or []:
            if top_level_name(name) != name:
                notes.add((group.root, f"rename:{name} to {top_level_name(name)}"))
    return sorted(notes)


class GroupRows:
    """The rows of a group's active streams in a batch."""

    def __init__(self, batch: Batch, group: Group, streams: dict[Lineage, Stream], stage: bool = False):
        batch.read_heads()
        self.batch = batch
        self.streams = streams
        self._targets = targets = {
            lineage: Target(number, tuple((c.name, c.kind) for c in stream.taken))
            for number, (lineage, stream) in enumerate(streams.items())
        }
        self._lanes = json_records(batch)
        self._staged: DataFrame | None = None
        if self._lanes and stage and len(streams) > 1:
            # Several streams read the same records: decode each object once.
            folder = fresh_folder(batch.spark, "pieces")
            pieces(self._lanes, targets).write.partitionBy("stream").parquet(folder)
            self._staged = batch.spark.read.schema(pieces_schema(targets)).parquet(folder)
        good = [item for item in batch.of(PARQUET) if not batch.heads[item.obj]["error"]]
        schemas = {item.obj: bytes(batch.heads[item.obj]["schema"]) for item in good}
        native = [item for item in good if batch.heads[item.obj]["native"]]
        self._parquet: list[SchemaGroup | RowGroups] = [*schema_groups(batch.spark, native, schemas)]
        others: dict[bytes, list[ScanObject]] = {}
        for item in good:
            if not batch.heads[item.obj]["native"]:
                others.setdefault(schemas[item.obj], []).append(item)
        groups = {item.obj: batch.heads[item.obj]["row_groups"] for item in good}
        for schema, objects in others.items():
            self._parquet.append(RowGroups(batch.spark, pa.ipc.read_schema(pa.py_buffer(schema)), objects, groups))

    def rows(self, lineage: Lineage) -> DataFrame:
        """A stream's rows with their internal columns, and its metadata columns."""
        stream = self.streams[lineage]
        frames = _parquet_rows(self.batch, self._parquet, lineage, stream)
        target = self._targets[lineage]
        # Without a stage a stream's rows are read by themselves, and only they are made.
        found = self._staged if self._staged is not None else pieces(self._lanes, {lineage: target})
        if found is not None:
            frames.append(_cell_rows(found, target, stream))
        if not lineage:
            delimited = _delimited_rows(self.batch, stream)
            if delimited is not None:
                frames.append(delimited)
        failed = self._failed_heads(stream)
        if failed is not None:
            frames.append(failed)
        whole = _union(frames)
        if whole is None:
            whole = self._failed_frame(stream, [])
        return self._with_metadata(whole, stream)

    def _failed_heads(self, stream: Stream) -> DataFrame | None:
        failed = batch_errors(self.batch)
        return self._failed_frame(stream, failed) if failed else None

    def _failed_frame(self, stream: Stream, failed: list[tuple[int, str]]) -> DataFrame:
        rows = local_frame(self.batch.spark, 
            [(obj, 0, error) for obj, error in failed], "obj int, row bigint, error string"
        ).select(
            "*",
            _empty_pos(),
            F.lit(None).cast("string").alias("parent"),
            F.lit(None).cast("int").alias("idx"),
            F.lit(None).cast("string").alias("suffix"),
        )
        return _converted(rows, stream, {}, F.col("error"))

    def _with_metadata(self, rows: DataFrame, stream: Stream) -> DataFrame:
        # One row per object of the batch, so this side is bounded.
        placed = rows.join(F.broadcast(self.batch.places().drop("__file")), OBJ)
        made = {
            KEY: F.col("__key"),
            LAST_MODIFIED: F.col("__time"),
            ROW_NUMBER: F.col(ROW),
            PARENT_ROW: F.concat("__key", "__parent"),
            INDEX: F.col("__idx").cast("bigint"),
            ROW_KEY: F.concat("__key", "__suffix"),
        }
        return placed.select(
            *[placed[f"`{column.name.replace('`', '``')}`"] for column in stream.taken],
            *[made[name].alias(name) for name in stream.metadata],
            *INTERNAL,
        )


def read_order() -> list[Column]:
    """The order in which a stream's rows are read."""
    return [F.col(OBJ), F.col(ROW), F.col(POS)]


def fail_on(errors: DataFrame, batch: Batch) -> None:
    """Raise the first error in read order, if there is any."""
    first = errors.where(F.col(ERROR).isNotNull()).orderBy(*read_order()).first()
    if first is not None:
        key = next(item.key for item in batch.objects if item.obj == first[OBJ])
        raise LoadError(f"could not read {key} row {first[ROW]}: {first[ERROR]}")


__all__ = ["Batch", "GroupRows", "INTERNAL", "fail_on", "read_order"]
