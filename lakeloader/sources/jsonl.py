"""JSON lines: one object per line, read in splits."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloader.operators.pieces import Record
from lakeloader.session import Shipped
from lakeloader.sources.textscan import (
    ScanObject,
    cut_and_whole,
    is_blank,
    offset_of,
    scan_parts,
    split_offsets,
    split_runs,
    text_scan,
)

BOM = b"\xef\xbb\xbf"


def _no_constant(name: str):
    raise ValueError(f"{name} is not JSON")


def decode_object(text: bytes, strict: bool = False) -> dict:
    """One JSON object, or a ValueError. Only JSON lines may hold NaN and Infinity."""
    value = json.loads(text.decode("utf-8"), parse_constant=_no_constant if strict else None)
    if not isinstance(value, dict):
        raise ValueError("not a JSON object")
    return value


class JsonLines(Shipped):
    """The scan of a batch's JSON lines objects."""

    def __init__(self, spark: SparkSession, objects: list[ScanObject]):
        self.numbers = {item.file: item.obj for item in objects}
        parts = cut_and_whole(spark, objects)
        self.cut = {item.file for item in parts[0]}
        self.offsets = split_offsets(_count_lines(text_scan(spark, parts[0], None)) if self.cut else [])
        self.lines = scan_parts(spark, parts, None).where(~is_blank(F.col("value")))

    def state(self) -> dict:
        # Tasks get the numbers, not the DataFrame.
        return {**vars(self), "lines": None}

    def records(self, batches: Iterator[pa.RecordBatch]) -> Iterator[Record]:
        """Decode a task's lines."""
        for file, block, lines in split_runs(batches):
            obj, row = self.numbers[file], offset_of(self.offsets, self.cut, file, block)
            for line in lines:
                row += 1
                if row == 1 and line.startswith(BOM):
                    line = line[len(BOM) :]
                try:
                    yield Record(obj, row, decode_object(line), None, len(line))
                except (ValueError, RecursionError) as err:
                    yield Record(obj, row, None, f"{type(err).__name__}: {err}")


def _count_lines(lines: DataFrame) -> list[tuple[str, int, int]]:
    """Records per split: one small row per split, combined before the shuffle."""
    counted = lines.groupBy("file", "block").agg(F.count_if(~is_blank(F.col("value"))))
    return [tuple(row) for row in counted.collect()]


def physical_line(spark: SparkSession, item: ScanObject, row: int) -> int:
    """The line number, blank lines included, of a record. Only for error messages."""
    lines = text_scan(spark, [item], None).withColumn("blank", is_blank(F.col("value")))
    numbered = lines.select("block", "blank", F.monotonically_increasing_id().alias("id"))
    # Within a split ids are consecutive, so the place of the record's line in its
    # split comes from the sorted splits' counts.
    counts = sorted(
        tuple(r)
        for r in numbered.groupBy("block")
        .agg(F.count("*"), F.count_if(~F.col("blank")), F.min("id"))
        .collect()
    )
    records = physical = 0
    for block, total, filled, first in counts:
        if records + filled >= row:
            inside = (
                numbered.where((F.col("block") == block) & ~F.col("blank"))
                .orderBy("id")
                .limit(row - records)
                .agg(F.max("id"))
                .first()[0]
            )
            return physical + inside - first + 1
        records += filled
        physical += total
    return physical
