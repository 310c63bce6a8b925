"""Discovery: from a listing to a catalog, by a sample of each stream's newest objects."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lakeloader.functions import kinds as K
from lakeloader.functions.datetimes import is_iso_datetime
from lakeloader.functions.names import Lineage, top_level_name
from lakeloader.model import CHILD_METADATA, DELIMITED, JSON, JSONL, PARQUET, SAMPLE_OBJECTS, SAMPLE_ROWS
from lakeloader.operators import columnar
from lakeloader.operators.pieces import NAMED, Record, named_batches
from lakeloader.plans.catalog import Catalog, Stream, plan_child_names
from lakeloader.plans.catalog import Column as CatalogColumn
from lakeloader.plans.read import Batch, _union, json_records
from lakeloader.session import local_frame, prepare, written
from lakeloader.sources.document import first_records
from lakeloader.sources.heads import json_lines, open_bytes
from lakeloader.sources.layout import Layout, build_layout, newest

# How many more objects of a stream are looked at when too few have parsed.
_LOOK_AGAIN = 64

OBSERVED = (
    "obj int, lineage array<array<string>>, column string, kind string, "
    "row bigint, seq int, place int, container boolean"
)


def cell_kind(cell: Column) -> Column:
    """The kind one tagged cell has. A quoted `"42"` stays a string."""
    tag, text = F.substring(cell, 1, 1), F.substring(cell, 2, 1 << 30)
    return (
        F.when(cell.isNull() | (cell == "s"), K.EMPTY)
        .when(tag == "b", K.BOOLEAN)
        .when(tag == "i", F.when(text.try_cast("bigint").isNull(), K.WIDE_INTEGER).otherwise(K.INTEGER))
        .when(tag == "f", K.NUMBER)
        .when(is_iso_datetime(text), K.DATE_TIME)
        .otherwise(K.STRING)
    )


def observe(named: DataFrame) -> DataFrame:
    """Columns and kinds seen in pieces, combined per object before the shuffle."""
    rows = named.where(F.col("error").isNull())
    cells = rows.select(
        "obj", "lineage", "row", "seq", F.posexplode(F.arrays_zip("names", "cells")).alias("place", "cell")
    )
    columns = (
        cells.select(
            "obj",
            "lineage",
            F.col("cell.names").alias("column"),
            cell_kind(F.col("cell.cells")).alias("kind"),
            F.struct("row", "seq", "place").alias("first"),
        )
        .groupBy("obj", "lineage", "column", "kind")
        .agg(F.min("first").alias("first"))
        .select("obj", "lineage", "column", "kind", "first.*", F.lit(False).alias("container"))
    )
    containers = (
        rows.select("obj", "lineage", F.explode("containers").alias("column"))
        .distinct()
        .select(
            "obj", "lineage", "column", F.lit(K.EMPTY).alias("kind"), F.lit(0).cast("bigint").alias("row"),
            F.lit(0).alias("seq"), F.lit(0).alias("place"), F.lit(True).alias("container"),
        )
    )
    # A lineage without columns still is a stream.
    streams = (
        rows.select("obj", "lineage")
        .distinct()
        .select(
            "obj", "lineage", F.lit(None).cast("string").alias("column"), F.lit(K.EMPTY).alias("kind"),
            F.lit(0).cast("bigint").alias("row"), F.lit(0).alias("seq"), F.lit(0).alias("place"),
            F.lit(False).alias("container"),
        )
    )
    return columns.unionByName(containers).unionByName(streams)


def merge_observed(observed: DataFrame, ranks: DataFrame) -> DataFrame:
    """Merge what the sampled objects show into columns, in the order of first sight.

    `ranks` gives each object its stream and its place, newest first.
    """
    ranked = observed.join(F.broadcast(ranks), "obj")
    return (
        ranked.groupBy("stream", "lineage", "column")
        .agg(
            K.merged_kind(F.collect_set(F.when(~F.col("container"), F.col("kind")))).alias("kind"),
            F.bool_or("container").alias("container"),
            F.bool_and("container").alias("only_container"),
            F.min(
                F.when(~F.col("container"), F.struct("newest_rank", "row", "seq", "place"))
            ).alias("first"),
        )
        # A column that was only ever null, and is an object or list elsewhere,
        # holds no data.
        .where(~F.col("only_container") & ~(F.col("container") & (F.col("kind") == K.EMPTY)))
        .select("stream", "lineage", "column", "kind", "first")
    )


@dataclass
class Discovery:
    """A catalog, and what discovery has to say about the objects."""

    catalog: Catalog
    layout: Layout
    skipped: dict[str, str]
    renamed: dict[str, list[str]]
    clashes: list[tuple[str, str]]


def _schema_rows(obj: int, found: dict[Lineage, columnar.Table]) -> list[tuple]:
    rows = []
    for lineage, table in found.items():
        path = [list(part) for part in lineage]
        rows.append((obj, path, None, K.EMPTY, 0, 0, 0, False))
        for place, (name, kind) in enumerate(columnar.column_kinds(found, lineage)):
            rows.append((obj, path, name, kind, 0, 0, place, False))
        rows += [(obj, path, name, K.EMPTY, 0, 0, 0, True) for name in table.containers]
    return rows


def _sample(batch: Batch) -> tuple[DataFrame, dict[int, str], dict[int, set[str]]]:
    """What a batch's objects show, the objects that can't be read, and renamed keys."""
    spark = batch.spark
    batch.read_heads(SAMPLE_ROWS)
    rows: list[tuple] = []
    renamed: dict[int, set[str]] = {}
    for item in batch.of(DELIMITED, PARQUET):
        head = batch.heads[item.obj]
        if head["error"]:
            continue
        if item.kind == DELIMITED:
            rows.append((item.obj, [], None, K.EMPTY, 0, 0, 0, False))
            for place, (name, filled) in enumerate(zip(head["columns"], head["filled"])):
                kind = K.STRING if filled else K.EMPTY
                rows.append((item.obj, [], top_level_name(name), kind, 0, 0, place, False))
                if top_level_name(name) != name:
                    renamed.setdefault(item.obj, set()).add(f"{name} to {top_level_name(name)}")
            continue
        schema = pa.ipc.read_schema(pa.py_buffer(bytes(head["schema"])))
        found = columnar.tables(from_arrow_schema(_readable(schema)))
        rows += _schema_rows(item.obj, found)
        for table in found.values():
            renamed.setdefault(item.obj, set()).update(table.renamed)
    frames = [local_frame(spark, rows, OBSERVED)] if rows else []
    # Which field of an object document holds its records shows only at its end, so
    # those documents are read whole, in splits.
    starts = batch.of(JSONL) + [item for item in batch.of(JSON) if batch.heads[item.obj]["root"] == "["]
    read = {item.obj for item in starts}
    documents = batch.subset({item.obj for item in batch.of(JSON)} - read)
    named = [_sample_starts(spark, starts)] if starts else []
    for scan, decode in json_records(documents, SAMPLE_ROWS):
        def task(batches, decode=decode):
            return named_batches(decode(batches))

        sampled = scan.mapInArrow(task, NAMED)
        named.append(sampled.where(F.col("row") <= SAMPLE_ROWS))
    errors = {obj: head["error"] for obj, head in batch.heads.items() if head["error"]}
    if named:
        # A sample: at most 1,000 rows of each of the newest objects.
        pieces = written(_union(named))
        frames.append(observe(pieces))
        for row in (
            pieces.where(F.col("error").isNotNull())
            .groupBy("obj").agg(F.min_by("error", "row").alias("error")).collect()
        ):
            errors[row.obj] = row.error
        notes = pieces.where(F.size("notes") > 0).select("obj", F.explode("notes").alias("note"))
        for row in notes.distinct().collect():
            renamed.setdefault(row.obj, set()).add(row.note)
    observed = _union(frames) if frames else local_frame(spark, [], OBSERVED)
    return written(observed), errors, renamed


def _head_records(row: dict) -> Iterator[Record]:
    """The first records of a JSON lines object or a JSON array; a failure is a record, too."""
    number = 0
    try:
        if row["kind"] == JSONL:
            for value in json_lines(row["path"], row["compressed"], SAMPLE_ROWS):
                number += 1
                yield Record(row["obj"], number, value)
        else:
            with open_bytes(row["path"], row["compressed"]) as stream:
                for record in first_records(stream, row["obj"], SAMPLE_ROWS):
                    number = record.row
                    yield record
    except Exception as err:  # noqa: BLE001 - any reader error is about the object
        yield Record(row["obj"], number + 1, None, f"{type(err).__name__}: {err}")


def _sample_starts(spark: SparkSession, objects: list) -> DataFrame:
    """The first rows of JSON lines objects and JSON arrays; only so much of them is read."""
    frame = local_frame(
        spark,
        [(item.obj, item.path, item.kind, item.compressed) for item in objects],
        "obj int, path string, kind string, compressed boolean",
    ).repartition(min(len(objects), 4 * spark.sparkContext.defaultParallelism))

    def read(batches):
        return named_batches(
            record for batch in batches for row in batch.to_pylist() for record in _head_records(row)
        )

    return frame.mapInArrow(read, NAMED)


def _readable(schema: pa.Schema) -> pa.Schema:
    """A file's schema with types Spark lacks replaced by ones of the same kind."""

    def plain(kind: pa.DataType) -> pa.DataType:
        types = pa.types
        if types.is_dictionary(kind):
            return plain(kind.value_type)
        if types.is_struct(kind):
            return pa.struct([pa.field(kind.field(n).name, plain(kind.field(n).type)) for n in range(kind.num_fields)])
        if types.is_list(kind) or types.is_large_list(kind) or types.is_fixed_size_list(kind):
            return pa.list_(plain(kind.value_type))
        if types.is_map(kind):
            return pa.map_(pa.string(), pa.string())
        if types.is_timestamp(kind):
            return pa.timestamp("us")
        if types.is_integer(kind):
            return pa.int64()
        if types.is_floating(kind) or types.is_decimal(kind):
            return pa.float64()
        if types.is_date(kind):
            return pa.date32()
        return kind if types.is_boolean(kind) else pa.string()

    return pa.schema([pa.field(field.name, plain(field.type)) for field in schema])


def sample_objects(manifest: DataFrame):
    """Sample the newest objects that parse, at most five per stream.

    Objects that don't parse are replaced by the next newest ones, in rounds. Each
    round takes up where the one before ended and looks at the same number of
    objects, so the driver holds no more of a stream with many bad objects. Gives
    what the objects show, the rank of the ones that count, and the ones that failed.
    """
    spark = manifest.sparkSession
    observed: list[DataFrame] = []
    good: dict[str, list[tuple[int, int]]] = {}
    skipped: dict[str, str] = {}
    renamed: dict[str, set[str]] = {}
    left, looked, base = manifest, 0, 0
    while True:
        look = _LOOK_AGAIN if looked else SAMPLE_OBJECTS
        wanted = written(newest(left, look))
        places = {row.key: (row.stream, looked + row.newest_rank) for row in wanted.collect()}
        if not places:
            break
        batch = Batch.collect(wanted, skip_changed=True).renumbered(base)
        base += len(places)
        skipped.update(batch.changed)
        frame, errors, notes = _sample(batch)
        observed.append(frame)
        for item in sorted(batch.objects, key=lambda item: places[item.key][1]):
            stream, rank = places[item.key]
            taken = good.setdefault(stream, [])
            if len(taken) == SAMPLE_OBJECTS:
                continue
            if item.obj in errors:
                skipped[item.key] = errors[item.obj]
            else:
                taken.append((item.obj, rank))
                renamed.setdefault(stream, set()).update(notes.get(item.obj, ()))
        looked += look
        for stream, _ in places.values():
            good.setdefault(stream, [])
        # Streams that have this many objects, and maybe more.
        full = [stream for stream, rank in places.values() if rank == looked]
        short = [(stream,) for stream in full if len(good[stream]) < SAMPLE_OBJECTS]
        if not short:
            break
        left = _older(manifest, wanted, local_frame(spark, short, "stream string"))
    ranks = local_frame(spark, 
        [(obj, stream, rank) for stream, taken in good.items() for obj, rank in taken],
        "obj int, stream string, newest_rank int",
    )
    union = functools.reduce(lambda a, b: a.unionByName(b), observed) if observed else None
    return union, ranks, good, skipped, renamed


def _older(manifest: DataFrame, seen: DataFrame, streams: DataFrame) -> DataFrame:
    """The objects of some streams that are older than those seen of them."""
    last = seen.groupBy("stream").agg(F.min(F.struct("last_modified", "key")).alias("last"))
    # One row per stream.
    rows = manifest.join(F.broadcast(last.join(streams, "stream", "left_semi")), "stream")
    return rows.where(F.struct("last_modified", "key") < F.col("last")).select(*manifest.columns)


def discover(listing: DataFrame, prefix: str | None = None, exclude: str | None = None) -> Discovery:
    """Build the catalog of everything below a prefix."""
    prepare(listing.sparkSession)
    layout = build_layout(listing, prefix, exclude)
    observed, ranks, good, skipped, renamed = sample_objects(layout.manifest)
    columns: dict[tuple[str, Lineage], list[tuple]] = {(name, ()): [] for name in good}
    if observed is not None:
        # The result has one row per column of the catalog.
        for row in merge_observed(observed, ranks).collect():
            lineage = tuple(tuple(path) for path in row.lineage)
            found = columns.setdefault((row.stream, lineage), [])
            if row.column is not None and not (lineage and row.column in CHILD_METADATA):
                found.append((tuple(row.first), row.column, row.kind))
    names = {(name, ()): name for name in good}
    children = list(plan_child_names([key for key in columns if key[1]], good))
    names |= {(child.root, child.lineage): child.name for child in children}
    catalog = Catalog()
    for name in sorted(good):
        catalog.add(Stream(name, _columns(columns[name, ()])))
    for child in children:
        catalog.add(
            Stream(child.name, _columns(columns[child.root, child.lineage]), child.parent, child.lineage[-1])
        )
    return Discovery(
        catalog, layout, skipped, {name: sorted(notes) for name, notes in renamed.items() if notes},
        [(child.natural, child.name) for child in children if child.name != child.natural],
    )


def _columns(found: list[tuple]) -> tuple[CatalogColumn, ...]:
    return tuple(
        CatalogColumn(name, K.STRING if kind == K.EMPTY else kind) for _, name, kind in sorted(found)
    )
