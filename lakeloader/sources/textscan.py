"""Text scans that know their place: the ground of the delimited and JSON lanes.

Spark's text source reads objects in splits. Rows of one split arrive in order
in one task. A row's number in its object is therefore the number of rows in
the earlier splits plus its place in its own split. Only objects that are
larger than one split need the first part, from a counting pass in the JVM.

Spark derives the size of splits from the total size of a scan's files. So the
objects that are cut are scanned apart from the others, and every pass over them
scans the same list: it is cut at the same places.

A task reads several splits, or several small objects, if they are many and small: the
number of tasks follows the bytes.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloader.sources.listing import escape_paths
from lakeloader.session import SPLIT_SHARE, local_frame, spread_tasks


#: What a task reads at least, if all cores have tasks enough.
TASK_BYTES = 16 << 20


@dataclass(frozen=True)
class ScanObject:
    """One object of a batch. `path` opens it, `file` is how Spark names it in rows."""

    obj: int
    key: str
    path: str
    file: str
    size: int
    kind: str
    extension: str
    compressed: bool


def text_scan(spark: SparkSession, objects: list[ScanObject], line_sep: str | None) -> DataFrame:
    """The raw lines of objects as `file, block, value` (bytes)."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    lines = reader.text(escape_paths([item.path for item in objects]))
    place = lines.metadataColumn("_metadata")
    tasks = max(spread_tasks(spark), -(-sum(item.size for item in objects) // TASK_BYTES))
    return lines.select(
        place.getField("file_path").alias("file"),
        place.getField("file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    ).coalesce(tasks)


_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def _bytes_setting(spark: SparkSession, name: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", spark.conf.get(name).strip().lower()).groups()
    return int(number) * _UNITS[unit]


def _split_bytes(spark: SparkSession, objects: list[ScanObject]) -> int:
    """The size of splits in a scan of exactly these objects."""
    open_cost = _bytes_setting(spark, "spark.sql.files.openCostInBytes")
    largest = _bytes_setting(spark, "spark.sql.files.maxPartitionBytes")
    share = sum(item.size + open_cost for item in objects) // int(spark.conf.get(SPLIT_SHARE))
    return min(largest, max(open_cost, share))


def cut_and_whole(spark: SparkSession, objects: list[ScanObject]) -> tuple[list[ScanObject], list[ScanObject]]:
    """Objects that may be read in several splits, and objects that a scan of just them reads whole.

    Without the larger ones a scan has smaller splits, which may cut others.
    """
    cut: list[ScanObject] = []
    whole = list(objects)
    while whole:
        size = _split_bytes(spark, whole)
        larger = [item for item in whole if item.size > size and not item.compressed]
        if not larger:
            break
        cut += larger
        whole = [item for item in whole if item.size <= size or item.compressed]
    return cut, whole


def scan_parts(spark: SparkSession, parts: tuple[list[ScanObject], ...], line_sep: str | None) -> DataFrame:
    """The lines of all parts, each of them a scan of its own."""
    scans = [text_scan(spark, part, line_sep) for part in parts if part]
    whole = scans[0]
    for more in scans[1:]:
        whole = whole.unionAll(more)
    return whole


# What the row readers skip: a line with nothing but white space, also after a
# byte order mark.
_BLANK = r"(?s)^[\s\x1c-\x1f\x85\p{Z}\x{FEFF}]*\z"


def is_blank(value: Column) -> Column:
    """Whether a line holds no record. Most lines are decided by their first byte."""
    text = value.cast("string")
    return F.when(F.startswith(text, F.lit("{")), False).otherwise(text.rlike(_BLANK))


def split_offsets(counts: list[tuple[str, int, int]]) -> dict[tuple[str, int], int]:
    """Rows before each split, from `(file, block, rows)` of every split."""
    offsets: dict[tuple[str, int], int] = {}
    for file, splits in itertools.groupby(sorted(counts), key=lambda item: item[0]):
        total = 0
        for _, block, rows in splits:
            offsets[file, block] = total
            total += rows
    return offsets


def split_chunks(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[str, int, Iterator[pa.Array]]]:
    """Group a task's rows by split, as `(file, block, arrays of values in order)`."""

    def chunks():
        for batch in batches:
            if not batch.num_rows:
                continue
            files, blocks = batch.column(0), batch.column(1)
            ends = sorted(
                set(pc.run_end_encode(files).run_ends.to_pylist())
                | set(pc.run_end_encode(blocks).run_ends.to_pylist())
            )
            values = batch.column(2)
            start = 0
            for end in ends:
                place = (files[start].as_py(), blocks[start].as_py())
                yield place, values.slice(start, end - start)
                start = end

    for (file, block), group in itertools.groupby(chunks(), key=lambda chunk: chunk[0]):
        yield file, block, (values for _, values in group)


def split_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[bytes]]]:
    """Group a task's rows by split, as `(file, block, values in order)`."""
    for file, block, chunks in split_chunks(batches):
        yield file, block, itertools.chain.from_iterable(values.to_pylist() for values in chunks)


def offset_of(offsets: dict[tuple[str, int], int], cut: set[str], file: str, block: int) -> int:
    """The offset of a split. A split of a cut object that was never counted is an error."""
    found = offsets.get((file, block))
    if found is None:
        if block or file in cut:
            raise RuntimeError(f"{file}: the split at byte {block} was not counted")
        return 0
    return found


def stitch(edges: DataFrame, rows: list[tuple[str, int, int, int]]) -> DataFrame:
    """Put records together that cross splits, as `file, row, value`.

    `edges` holds the bytes at the borders of splits as `file, block, part,
    value`; `rows` says which row of the object each of them is a piece of (one
    small entry per border). A group is one record.
    """
    spark = edges.sparkSession
    places = local_frame(spark, rows, "file string, block bigint, part int, row bigint")
    pieces = F.array_sort(F.collect_list(F.struct("block", "part", "value")))
    return (
        edges.join(F.broadcast(places), ["file", "block", "part"])
        .groupBy("file", "row")
        .agg(pieces.alias("pieces"))
        .select(
            "file",
            "row",
            F.aggregate(
                "pieces", F.lit(b""), lambda whole, piece: F.concat(whole, piece.getField("value"))
            ).alias("value"),
        )
    )
