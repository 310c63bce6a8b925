"""Delimited text, read in splits, with quoted line breaks.

At a line break a row has either ended or continues inside quotes, so the
start of a split has just two cases. A native pass over the bytes tells which
files hold quotes, their encoding, and the rows per split. Only files that are
larger than one split *and* hold quotes need a closer look at their splits.

Rows become Arrow columns `c0, c1, …` in catalog order. Files without quotes
are cut by Arrow kernels; the others by the csv module, which defines the
dialect.
"""

from __future__ import annotations

import csv
import io
import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloader.functions.names import top_level_name
from lakeloader.session import Shipped, written
from lakeloader.sources.textscan import (
    ScanObject,
    cut_and_whole,
    split_chunks,
    split_runs,
    stitch,
    text_scan,
)

_BOM = b"\xef\xbb\xbf"
# Bytes cp1252 leaves undefined.
_NOT_CP1252 = r"[\x81\x8d\x8f\x90\x9d]"
csv.field_size_limit(2**31 - 1)


@dataclass
class DelimitedFile:
    """How to read one file."""

    obj: int
    delimiter: str
    header: list[str]
    header_blank: bool
    line_sep: str = "\n"
    encoding: str = "utf-8"
    simple: bool = False

    def places(self, columns: list[str]) -> list[tuple[int, int]]:
        """Per wanted column, its place under the header and past it (-1: none).

        Cells past the header are named `column_N` and win over a header of
        that name.
        """
        named = {top_level_name(name): place for place, name in enumerate(self.header)}
        found = []
        for column in columns:
            _, _, digits = column.rpartition("column_")
            past = int(digits) - 1 if column == f"column_{digits}" and digits.isdecimal() else -1
            found.append((named.get(column, -1), past if past >= len(self.header) else -1))
        return found


class _Feed:
    """Lines for a csv reader that tell what the reader has taken."""

    def __init__(self, lines: Iterator[bytes], encoding: str, quoted: bool):
        self.lines, self.encoding, self.quoted = lines, encoding, quoted
        self.taken: list[str] = []
        self.count, self.exhausted = 0, False

    def __iter__(self) -> Iterator[str]:
        opening = '"' if self.quoted else ""
        for line in self.lines:
            text = line.decode(self.encoding) + "\n"
            self.count += 1
            for part in io.StringIO(text, newline="") if "\r" in text[:-2] else (text,):
                self.taken.append(part)
                yield opening + part
                opening = ""
        self.exhausted = True


class _Case:
    """A split read under one case of its start, record by record, only counting."""

    def __init__(self, lines: Iterator[bytes], delimiter: str, quoted: bool):
        self.feed = _Feed(lines, "latin-1", quoted)
        self.reader = csv.reader(iter(self.feed), delimiter=delimiter)
        self.in_head = quoted
        self.rows, self.done = 0, False
        self.head: bytes | None = None
        self.tail: bytes | None = None

    def step(self) -> None:
        cells = next(self.reader, None)
        taken = "".join(self.feed.taken).encode("latin-1")
        self.feed.taken.clear()
        if cells is None:
            self.done = True
        elif self.feed.exhausted:
            self.done = True
            if self.in_head:
                self.head = taken
            else:
                self.tail = taken
        elif self.in_head:
            self.head, self.in_head = taken, False
        else:
            self.rows += bool(cells)


_EDGES = (
    "file string, block bigint, rows0 bigint, open0 boolean, rows1 bigint, closed1 boolean, "
    "open1 boolean, edges array<struct<part:int,value:binary>>"
)
_EDGES_ARROW = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("rows0", pa.int64()), ("open0", pa.bool_()),
     ("rows1", pa.int64()), ("closed1", pa.bool_()), ("open1", pa.bool_()),
     ("edges", pa.list_(pa.struct([("part", pa.int32()), ("value", pa.binary())])))]
)


class Delimited(Shipped):
    """The scan of a batch's delimited objects into the columns of one stream."""

    def __init__(
        self, spark: SparkSession, objects: list[ScanObject], files: dict[str, DelimitedFile],
        columns: list[str],
    ):
        self.files = files
        self.columns = columns
        self.places = {name: file.places(columns) for name, file in files.items()}
        self.offsets: dict[tuple[str, int], int] = {}
        self.quoted: set[tuple[str, int]] = set()
        self.last: dict[str, int] = {}
        self.stitched: DataFrame | None = None
        self.scans, cut_scans = self._scan(spark, objects)
        if self._mixed_line_ends():
            self.scans, cut_scans = self._scan(spark, objects)
        self.broken = self._read_stats()
        if self.broken:
            self._find_edges(cut_scans)
        self.schema = pa.schema(
            [("obj", pa.int32()), ("row", pa.int64()), ("notes", pa.list_(pa.string()))]
            + [(f"c{n}", pa.string()) for n in range(len(columns))]
        )

    def state(self) -> dict:
        return {**vars(self), "scans": None, "stitched": None}

    def _scan(self, spark: SparkSession, objects: list[ScanObject]) -> tuple[list[DataFrame], list[DataFrame]]:
        """Scans by line end, those of cut objects apart; these are given once more."""
        scans, cut_scans = [], []
        self.line_seps = []
        for line_sep in sorted({self.files[item.file].line_sep for item in objects}):
            group = [item for item in objects if self.files[item.file].line_sep == line_sep]
            cut, whole = cut_and_whole(spark, group)
            for part in filter(None, (cut, whole)):
                scans.append(text_scan(spark, part, line_sep))
                self.line_seps.append(line_sep)
                if part is cut:
                    cut_scans.append(scans[-1])
        return scans, cut_scans

    def _mixed_line_ends(self) -> bool:
        """Whether objects that begin with bare carriage returns hold line feeds, too.

        Those are then read by line feeds; the row readers know the other ends.
        """
        mixed = False
        for scan, line_sep in zip(self.scans, self.line_seps):
            if line_sep == "\n":
                continue
            fed = F.contains(F.col("value"), F.lit(b"\n"))
            for row in scan.groupBy("file").agg(F.bool_or(fed).alias("fed")).where("fed").collect():
                self.files[row.file].line_sep = "\n"
                mixed = True
        return mixed

    def rows(self) -> DataFrame:
        """The rows as `obj, row, notes, c0, c1, …`."""
        ddl = ", ".join(
            ["obj int", "row bigint", "notes array<string>"] + [f"c{n} string" for n in range(len(self.columns))]
        )
        found = [scan.mapInArrow(self._cut, ddl) for scan in self.scans]
        if self.stitched is not None:
            found.append(self.stitched.mapInArrow(self._cut_stitched, ddl))
        whole = found[0]
        for more in found[1:]:
            whole = whole.unionByName(more)
        return whole

    def _read_stats(self) -> set[str]:
        """Encodings, quotes and rows per split; give the files that need a closer look."""
        text = F.col("value").cast("string")
        stats = []
        for scan in self.scans:
            stats += (
                scan.groupBy("file", "block")
                .agg(
                    F.count_if((F.octet_length("value") > 1) | ~text.isin("", "\r")),
                    F.bool_or(F.contains(text, F.lit('"'))),
                    F.bool_or(F.locate("\r", text).between(1, F.octet_length("value") - 1)),
                    F.bool_and(F.is_valid_utf8(text)),
                    F.bool_and(
                        F.is_valid_utf8(text)
                        | ~F.decode("value", "ISO-8859-1").rlike(_NOT_CP1252)
                    ),
                )
                .collect()
            )
        broken: set[str] = set()
        for name, splits in itertools.groupby(sorted(stats), key=lambda row: row[0]):
            splits = list(splits)
            file = self.files[name]
            quotes = any(row[3] for row in splits)
            if not all(row[5] for row in splits):
                file.encoding = "cp1252" if all(row[6] for row in splits) else "latin-1"
            file.simple = not quotes and file.encoding == "utf-8" and not any(row[4] for row in splits)
            self.last[name] = splits[-1][1]
            total = 0 if file.header_blank else -1
            for _, block, rows, *_ in splits:
                self.offsets[name, block] = total
                total += rows
            if (quotes or any(row[4] for row in splits)) and len(splits) > 1:
                broken.add(name)
        return broken

    def _edges(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Read each split under both cases of its start."""
        for name, block, lines in split_runs(batches):
            if name not in self.broken:
                continue
            delimiter = self.files[name].delimiter
            cases = [_Case(part, delimiter, bool(n)) for n, part in enumerate(itertools.tee(lines))]
            while not all(case.done for case in cases):
                # The case that lags behind goes on, so few lines wait in memory.
                min((case for case in cases if not case.done), key=lambda c: c.feed.count).step()
            plain, quoted = cases
            parts = [quoted.head, plain.tail, quoted.tail]
            yield pa.RecordBatch.from_pylist(
                [{"file": name, "block": block, "rows0": plain.rows, "open0": plain.tail is not None,
                  "rows1": quoted.rows, "closed1": not quoted.in_head,
                  "open1": quoted.tail is not None or quoted.in_head,
                  "edges": [{"part": n, "value": v} for n, v in enumerate(parts) if v is not None]}],
                schema=_EDGES_ARROW,
            )

    def _find_edges(self, scans: list[DataFrame]) -> None:
        edges = scans[0]
        for scan in scans[1:]:
            edges = edges.union(scan)
        # The borders' bytes stay in the cluster; the driver sees the numbers.
        edges = written(edges.mapInArrow(self._edges, _EDGES))
        rows = sorted(edges.drop("edges").collect(), key=lambda row: (row.file, row.block))
        chains: list[tuple[str, int, int, int]] = []
        for name, splits in itertools.groupby(rows, key=lambda row: row.file):
            total = 0 if self.files[name].header_blank else -1
            chain: list[tuple[str, int, int]] = []
            for row in splits:
                self.offsets[name, row.block] = total
                if chain:
                    self.quoted.add((name, row.block))
                    chain.append((name, row.block, 0))
                    if row.closed1:
                        chains += [(*place, total + 1) for place in chain]
                        total += 1
                        self.offsets[name, row.block] = total
                        chain = [(name, row.block, 2)] if row.open1 else []
                    total += row.rows1
                else:
                    total += row.rows0
                    chain = [(name, row.block, 1)] if row.open0 else []
            # A quote that never closes ends with the file. Where the record began
            # in the last split, that split reads it by itself.
            if len(chain) > 1:
                chains += [(*place, total + 1) for place in chain]
        if chains:
            self.stitched = stitch(edges.select("file", "block", F.inline("edges")), chains)

    def _cut(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's lines as rows."""
        for name, block, chunks in split_chunks(batches):
            offset = self.offsets.get((name, block))
            if offset is None:
                raise RuntimeError(f"{name}: the split at byte {block} was not counted")
            file = self.files[name]
            if block == 0:
                chunks = _without_bom(chunks)
            if file.simple:
                yield from self._cut_simple(name, file, block, offset, chunks)
            else:
                yield from self._cut_quoted(name, file, block, offset, chunks)

    def _cut_simple(self, name, file, block, offset, chunks):
        """Rows of a file without quotes: an Arrow kernel cuts the lines."""
        header = block == 0
        for chunk in chunks:
            if header and file.header_blank:
                chunk = chunk.slice(1)
            text = pc.utf8_rtrim(chunk.cast(pa.string()), "\r")
            text = text.filter(pc.not_equal(text, ""))
            if header and len(text) and not file.header_blank:
                text, offset = text.slice(1), offset + 1
                header = False
            header = header and not file.header_blank
            count = len(text)
            if not count:
                continue
            cells = pc.split_pattern(text, file.delimiter)
            widths = pc.list_value_length(cells)
            width = widths[0].as_py()
            if pc.all(pc.equal(widths, width)).as_py():
                flat = cells.flatten()

                def column(place, flat=flat, count=count, width=width):
                    if not 0 <= place < width:
                        return pa.nulls(count, pa.string())
                    return flat.take(pa.array(np.arange(place, count * width, width)))

                columns = [
                    column(past if 0 <= past < width else place) for place, past in self.places[name]
                ]
                notes = [
                    note for place, note in self._unknown(name, width)
                    if pc.any(pc.not_equal(column(place), "")).as_py()
                ]
                yield self._batch(file, np.arange(offset + 1, offset + 1 + count), columns, name, notes)
            else:
                numbers = range(offset + 1, offset + 1 + count)
                yield from self._batches(name, file, zip(numbers, cells.to_pylist()))
            offset += count

    def _cut_quoted(self, name, file, block, offset, chunks):
        """Rows of any file, by the csv module."""
        starts_quoted = (name, block) in self.quoted
        lines = itertools.chain.from_iterable(chunk.to_pylist() for chunk in chunks)
        feed = _Feed(lines, file.encoding, starts_quoted)
        reader = csv.reader(iter(feed), delimiter=file.delimiter)
        last = block == self.last[name]

        def rows():
            number = offset
            if starts_quoted:
                next(reader, None)
            elif block == 0:
                # The header is the first record, even a blank one.
                header = next(reader, None)
                number += bool(header)
            for cells in reader:
                if feed.exhausted and not last:
                    return
                feed.taken.clear()
                if cells:
                    number += 1
                    yield number, cells

        yield from self._batches(name, file, rows())

    def _cut_stitched(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, row, value in zip(*(column.to_pylist() for column in batch.columns)):
                file = self.files[name]
                text = io.StringIO(value.decode(file.encoding), newline="")
                cells = next(csv.reader(text, delimiter=file.delimiter))
                yield from self._batches(name, file, [(row, cells)])

    def _unknown(self, name: str, width: int) -> list[tuple[int, str]]:
        """Cells of a row of some width that no wanted column takes."""
        header, known = self.files[name].header, set(self.columns)
        named = [top_level_name(header[n]) if n < len(header) else f"column_{n + 1}" for n in range(width)]
        return [(n, f"drop:{column}") for n, column in enumerate(named) if column not in known]

    def _batches(self, name: str, file: DelimitedFile, rows: Iterable[tuple[int, list[str]]]):
        """Rows of any width as columns."""
        places = self.places[name]
        for chunk in _chunks(rows):
            columns = [
                [
                    cells[past] if 0 <= past < len(cells)
                    else cells[place] if 0 <= place < len(cells)
                    else None
                    for _, cells in chunk
                ]
                for place, past in places
            ]
            unknown = self._unknown(name, max(len(cells) for _, cells in chunk))
            notes = [
                note for place, note in unknown
                if any(cells[place] for _, cells in chunk if place < len(cells))
            ]
            yield self._batch(file, [number for number, _ in chunk], columns, name, notes)

    def _batch(self, file, numbers, columns, name, notes) -> pa.RecordBatch:
        count = len(numbers)
        # Each task tells a note once per file, not on every row.
        told = self.__dict__.setdefault("_told", set())
        notes = [note for note in notes if (name, note) not in told]
        told.update((name, note) for note in notes)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(count, file.obj), pa.int32()), pa.array(numbers, pa.int64()),
             pa.array([notes or None] + [None] * (count - 1), pa.list_(pa.string())),
             *(column if isinstance(column, pa.Array) else pa.array(column, pa.string())
               for column in columns)],
            schema=self.schema,
        )


# An Arrow batch ends after so many rows, or so many characters.
_BATCH, _BATCH_CHARS = 8192, 16 << 20


def _chunks(rows: Iterable[tuple[int, list[str]]]) -> Iterator[list[tuple[int, list[str]]]]:
    chunk, size = [], 0
    for row in rows:
        chunk.append(row)
        size += sum(map(len, row[1]))
        if len(chunk) >= _BATCH or size >= _BATCH_CHARS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _without_bom(chunks: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Drop a byte order mark from the first line."""
    first = next(chunks, None)
    if first is None:
        return
    if len(first) and first[0].as_py().startswith(_BOM):
        start = pa.array([first[0].as_py().removeprefix(_BOM)], first.type)
        first = pa.concat_arrays([start, first.slice(1)])
    yield first
    yield from chunks
