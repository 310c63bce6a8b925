"""JSON documents: an array of objects, or an object around one such array.

A document may be larger than any task can hold, and may be one single line.
So it is read as text cut at every `}`: Spark splits it at any size, and each
piece holds at most one closing brace, its end. Following strings and depth
over the pieces gives the records.

A split in the middle of a document needs to know where it starts (inside a
string? how deep?). For documents larger than one split, one pass sums up each
split for both cases, and a second one finds the fields, the number of records
per split and the records that cross a border. Each of them hands the driver a
few numbers per split. Smaller arrays are read in a single pass.

Records are checked as JSON. Around them only the structure is checked.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloader.operators.pieces import Record
from lakeloader.session import Shipped, written
from lakeloader.sources.jsonl import BOM, decode_object
from lakeloader.sources.textscan import ScanObject, cut_and_whole, scan_parts, split_runs, stitch, text_scan

CUT = "}"
_CHUNK = 1 << 16
_STRING = re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)
_STRING_END = re.compile(rb'[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)
_TOKEN = re.compile(
    rb'\s+|"[^"\\]*(?:\\.[^"\\]*)*"|(?P<open>".*)|[{}\[\],:]|[^\s{}\[\],:"]+', re.DOTALL
)
_SCALAR = re.compile(rb"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null")


class DocumentError(ValueError):
    """What is wrong with a document."""


def bare(text: bytes, in_string: bool) -> tuple[bytes, bool]:
    """A piece without its strings, and whether a string is still open at its end."""
    if in_string:
        end = _STRING_END.match(text)
        if end is None:
            return b"", True
        text = text[end.end() :]
    if b'"' not in text:
        return text, False
    rest = _STRING.sub(b"", text)
    cut = rest.find(b'"')
    return (rest, False) if cut < 0 else (rest[:cut], True)


def _net(text: bytes) -> int:
    return text.count(b"{") + text.count(b"[") - text.count(b"]")


@dataclass
class Start:
    """Where a split of a document starts, and what is known of its end."""

    in_string: bool = False
    depth: int = 0
    root: str = ""
    field: int = -1
    rows: int = 0
    last: bool = True
    # Whether the document's last piece ended in a brace. None: not known.
    closed: bool | None = None


@dataclass
class Field:
    """What one split shows of a top-level field of an object document."""

    number: int
    name: str | None = None
    opened: str | None = None
    closed: str | None = None
    objects: int = 0
    others: int = 0


class Walk:
    """Follows one split of a document and yields the records complete in it.

    `wanted` is the number of the field that holds the records of an object
    document. None takes the items of every field, to find that field.
    """

    def __init__(self, start: Start, wanted: int | None = None):
        self.start, self.wanted = start, wanted
        self.in_string, self.depth, self.root = start.in_string, start.depth, start.root
        self.rows = start.rows
        # A split starts after a brace, so the next thing is a comma or an end.
        self.expect = "," if self.root else ""
        self.string = b'"?' if start.in_string else b""
        self.field = Field(start.field) if start.field >= 0 else None
        self.fields = [self.field] if self.field else []
        # Bytes of an item that began in an earlier split, and how it ended;
        # bytes of an item that is still open.
        self.head: list[bytes] = []
        self.head_end = ""
        self.item: list[bytes] | None = None
        # Tells for the last piece whether a brace followed it, where that is known.
        self.ends_in_brace = None

    @property
    def base(self) -> int:
        """The depth at which items begin and end."""
        return 1 if self.root == "[" else 2

    @property
    def takes(self) -> bool:
        """Whether the current field's items are records."""
        return self.root == "[" or self.wanted is None or (
            self.field is not None and self.field.number == self.wanted
        )

    def records(self, pieces: Iterator[bytes]) -> Iterator[bytes]:
        """The complete records among the split's pieces, in order."""
        marked = self._marked(pieces)
        if self.root and self.depth > self.base:
            marked = self._finish_head(marked)
        for piece, closed in marked:
            begin = self._outside(piece) if self.item is None else 0
            if self.item is not None:
                rest, self.in_string = bare(piece[begin:], self.in_string)
                self.depth += _net(rest)
                if self.takes:
                    self.item.append(piece[begin - 1 :] if begin else piece)
                    self.item.append(b"}" if closed else b"")
                if closed and not self.in_string:
                    self.depth -= 1
                    if self.depth == self.base:
                        record, self.item, self.expect = b"".join(self.item), None, ","
                        if self.field is not None:
                            self.field.objects += 1
                        if self.takes:
                            self.rows += 1
                            yield record
            elif closed:
                self._brace()
        if self.start.last and (self.in_string or self.depth or not self.root):
            raise DocumentError("the JSON document is incomplete")

    def _marked(self, pieces: Iterator[bytes]) -> Iterator[tuple[bytes, bool]]:
        """Each piece, and whether a closing brace follows it."""
        source = iter(pieces)
        piece = next(source, None)
        while piece is not None:
            after = next(source, None)
            yield piece, after is not None or not self.start.last or self._ends_in_brace(piece)
            piece = after

    def _ends_in_brace(self, piece: bytes) -> bool:
        if self.start.closed is not None:
            return self.start.closed
        if self.ends_in_brace is not None:
            return self.ends_in_brace()
        # The size of a compressed object says nothing. A brace must have
        # followed where an object document would be incomplete without it.
        rest, in_string = bare(piece, self.in_string)
        root = self.root or rest.lstrip()[:1].decode("latin-1")
        return not in_string and root == "{" and self.depth + _net(rest) == 1

    def _finish_head(self, marked) -> Iterator[tuple[bytes, bool]]:
        """Follow the item that began in an earlier split to its end."""
        for piece, closed in marked:
            position = 0
            if self.in_string:
                end = _STRING_END.match(piece)
                position = end.end() if end else len(piece)
                self.in_string = end is None
            for token in _TOKEN.finditer(piece, position) if not self.in_string else ():
                if token["open"]:
                    self.in_string = True
                elif token[0] in (b"{", b"["):
                    self.depth += 1
                elif token[0] == b"]":
                    self.depth -= 1
                    if self.depth == self.base:
                        self.head_end = "]"
                        self.expect = ","
                        yield piece[token.end() :], closed
                        yield from marked
                        return
            self.head += [piece, b"}" if closed else b""]
            if closed and not self.in_string:
                self.depth -= 1
                if self.depth == self.base:
                    self.head_end = "}"
                    if self.field is not None:
                        self.field.objects += 1
                    self.rows += self.takes
                    yield from marked
                    return

    def _outside(self, piece: bytes) -> int:
        """Read a piece outside items, up to the start of an item; give that place."""
        position = 0
        if self.in_string:
            end = _STRING_END.match(piece)
            if end is None:
                self.string += piece
                return 0
            position, self.in_string = end.end(), False
            self._value(self.string + piece[:position])
        for token in _TOKEN.finditer(piece, position):
            text = token[0]
            if text.isspace():
                continue
            if token["open"]:
                self.in_string, self.string = True, text
                return 0
            if text == b"{" and self.root and self.depth == self.base:
                if self.root == "[" and self.expect == ",":
                    raise DocumentError(f"no comma before item {self.rows + 1} of the array")
                self.depth += 1
                self.item = []
                return token.end()
            if text in (b"{", b"["):
                self._open(text.decode())
            elif text == b"]":
                self._close("]")
            elif text == b",":
                self._comma()
            elif text == b":":
                self._colon()
            elif text[:1] == b'"' or _SCALAR.fullmatch(text):
                self._value(text)
            else:
                raise DocumentError(f"{text[:40].decode('utf-8', 'replace')!r} is not a JSON value")
        return 0

    def _brace(self) -> None:
        """The closing brace after a piece, outside items."""
        if self.in_string:
            self.string += b"}"
        else:
            self._close("}")

    def _open(self, mark: str) -> None:
        if self.depth == 0:
            if self.root:
                raise DocumentError("the JSON document has content after its end")
            self.root = mark
        elif self.root == "[" and self.depth == 1:
            raise DocumentError(f"item {self.rows + 1} of the array is not a JSON object")
        elif self.depth == 1:
            self.field.opened = mark
        elif self.depth == 2 and self.root == "{":
            self.field.others += 1
        self.depth += 1

    def _close(self, mark: str) -> None:
        self.depth -= 1
        if self.depth < 0:
            raise DocumentError("the JSON document has content after its end")
        if self.depth == 0 and (
            mark != {"[": "]", "{": "}"}[self.root] or (self.root == "[" and self.expect == "item")
        ):
            raise DocumentError("the JSON document does not end as it began")
        if self.depth == 1 and self.root == "{" and self.field is not None:
            self.field.closed = mark

    def _comma(self) -> None:
        if self.root == "[" and self.depth == 1:
            if self.expect != ",":
                raise DocumentError("the array has a comma without an item")
            self.expect = "item"
        elif self.depth == 0:
            self._value(b",")

    def _colon(self) -> None:
        if self.depth == 1 and self.root == "{":
            number = (self.fields[-1].number if self.fields else self.start.field) + 1
            self.field = Field(number, self.string[1:-1].decode("utf-8", "replace"))
            self.fields.append(self.field)

    def _value(self, text: bytes) -> None:
        if self.depth == 0:
            raise DocumentError(
                "the JSON document has content after its end"
                if self.root
                else "the JSON document is not an array or an object"
            )
        if self.root == "[" and self.depth == 1:
            raise DocumentError(f"item {self.rows + 1} of the array is not a JSON object")
        if self.root == "{" and self.depth == 1:
            self.string = text
        elif self.root == "{" and self.depth == 2 and self.field is not None:
            self.field.others += 1


def record_field(fields: list[Field]) -> int | None:
    """The number of the field that holds the records; None if it holds no item.

    Candidates are arrays without an item that is no object. Empty ones matter only
    if none has items, and then there has to be just one.
    """
    fullest_first = sorted(
        (item for item in fields if item.opened == "[" and item.others == 0), key=lambda item: -item.objects
    )
    match [item.objects > 0 for item in fullest_first[:2]]:
        case [True, True]:
            rivals = ", ".join(sorted(str(item.name) for item in fullest_first if item.objects))
            raise DocumentError(f"several fields of the document hold records: {rivals}")
        case [True, *_]:
            return fullest_first[0].number
        case [False]:
            return None
    raise DocumentError("it can't be told which field of the document holds records")


_SUMS = "file string, block bigint, bytes bigint, first string, out_string boolean, out_depth int, in_string boolean, in_depth int"
_OUTLINE = (
    "file string, block bigint, root string, rows bigint, head_end string, head_open boolean, "
    "tail_field int, fields array<struct<number:int,name:string,opened:string,closed:string,"
    "objects:bigint,others:bigint>>, error string, "
    "edges array<struct<part:int,value:binary>>"
)


def _rows_to_batches(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_pylist(rows, schema=schema)


_SUMS_ARROW = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("bytes", pa.int64()), ("first", pa.string()),
     ("out_string", pa.bool_()), ("out_depth", pa.int32()), ("in_string", pa.bool_()),
     ("in_depth", pa.int32())]
)
_FIELD_ARROW = pa.struct(
    [("number", pa.int32()), ("name", pa.string()), ("opened", pa.string()),
     ("closed", pa.string()), ("objects", pa.int64()), ("others", pa.int64())]
)
_EDGE_ARROW = pa.struct([("part", pa.int32()), ("value", pa.binary())])
_OUTLINE_ARROW = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("root", pa.string()), ("rows", pa.int64()),
     ("head_end", pa.string()), ("head_open", pa.bool_()), ("tail_field", pa.int32()),
     ("fields", pa.list_(_FIELD_ARROW)), ("error", pa.string()), ("edges", pa.list_(_EDGE_ARROW))]
)


def _sum_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: its bytes, and its effect outside and inside a string."""
    for file, block, pieces in split_runs(batches):
        size, first, strings, depths = 0, "", [False, True], [0, 0]
        for piece in pieces:
            size += len(piece) + 1
            first = first or piece.removeprefix(BOM).lstrip()[:1].decode("latin-1")
            for case in (0, 1):
                rest, strings[case] = bare(piece, strings[case])
                depths[case] += _net(rest) - (not strings[case])
        yield from _rows_to_batches(
            [{"file": file, "block": block, "bytes": size, "first": first,
              "out_string": strings[0], "out_depth": depths[0],
              "in_string": strings[1], "in_depth": depths[1]}], _SUMS_ARROW
        )


class _Measured:
    """Pieces, and how many bytes of the object they stand for so far."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.size = pieces, 0

    def __iter__(self) -> Iterator[bytes]:
        for piece in self.pieces:
            self.size += len(piece) + 1
            yield piece


def _without_bom(pieces: Iterator[bytes]) -> Iterator[bytes]:
    first = next(pieces, None)
    if first is not None:
        yield first.removeprefix(BOM)
        yield from pieces


class Documents(Shipped):
    """The scan of a batch's JSON documents. `arrays` names the files that start with `[`."""

    def __init__(
        self, spark: SparkSession, objects: list[ScanObject], arrays: set[str],
        sample_rows: int | None = None,
    ):
        self.sample_rows = sample_rows
        self.numbers = {item.file: item.obj for item in objects}
        self.sizes = {item.file: None if item.compressed else item.size for item in objects}
        cut, whole = cut_and_whole(spark, objects)
        self.cut = {item.file for item in cut}
        # Arrays that are read whole need no outline.
        self.plain = {item.file for item in whole if item.file in arrays}
        self.starts: dict[tuple[str, int], Start] = {}
        self.wanted: dict[str, int | None] = {}
        # Object documents that fail as a whole, before any row.
        self.failed: dict[str, str] = {}
        self.stitched: DataFrame | None = None
        if cut:
            self._find_starts(text_scan(spark, cut, CUT))
        outlined = (cut, whole if len(self.plain) < len(whole) else [])
        if any(outlined):
            self._find_fields(scan_parts(spark, outlined, CUT))
        # Objects without records are skipped as they are read: a scan without them
        # could be cut at other places.
        self.skipped = {file for file, field in self.wanted.items() if field is None} | set(self.failed)
        parts = tuple(part if any(x.file not in self.skipped for x in part) else [] for part in (cut, whole))
        self.pieces = scan_parts(spark, parts, CUT) if any(parts) else None

    def state(self) -> dict:
        # Tasks get the numbers, not the DataFrames.
        return {**vars(self), "pieces": None, "stitched": None}

    def records(self, batches: Iterator[pa.RecordBatch]) -> Iterator[Record]:
        """Decode the records that lie inside a task's splits."""
        for file, block, pieces in split_runs(batches):
            if file in self.skipped:
                continue
            obj = self.numbers[file]
            walk = self._walk(file, block, self.wanted.get(file))
            try:
                for text in walk.records(self._pieces(walk, file, block, pieces)):
                    if self.sample_rows is None or walk.rows <= self.sample_rows:
                        yield _decode(obj, walk.rows, text)
            except DocumentError as err:
                yield Record(obj, walk.rows + 1, None, str(err))

    def stitched_records(self, batches: Iterator[pa.RecordBatch]) -> Iterator[Record]:
        """Decode the records that cross a border, from `file, row, value`."""
        for batch in batches:
            for file, row, text in zip(*(column.to_pylist() for column in batch.columns)):
                yield _decode(self.numbers[file], row, text)

    def _walk(self, file: str, block: int, wanted: int | None) -> Walk:
        start = self.starts.get((file, block))
        if start is None and (block or file in self.cut):
            raise RuntimeError(f"{file}: the split at byte {block} was not counted")
        return Walk(start or Start(), wanted)

    def _pieces(self, walk: Walk, file: str, block: int, pieces: Iterator[bytes]) -> Iterator[bytes]:
        size = self.sizes[file]
        if walk.start.closed is None and size is not None:
            measured = _Measured(pieces)
            walk.ends_in_brace = lambda: measured.size == size
            pieces = iter(measured)
        return pieces if block else _without_bom(iter(pieces))

    def _find_starts(self, pieces: DataFrame) -> None:
        sums = pieces.mapInArrow(_sum_splits, _SUMS).collect()
        for file, splits in itertools.groupby(sorted(sums), key=lambda row: row.file):
            splits = list(splits)
            closed = sum(row.bytes for row in splits) == self.sizes[file]
            in_string, depth, root = False, 0, ""
            for number, row in enumerate(splits):
                self.starts[file, row.block] = Start(
                    in_string, depth, root, field=0 if root == "{" else -1,
                    last=number == len(splits) - 1, closed=closed,
                )
                root = root or row.first
                depth += row.in_depth if in_string else row.out_depth
                in_string = row.in_string if in_string else row.out_string

    def _outline(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per split: its fields, its records, and the bytes at its borders."""
        for file, block, pieces in split_runs(batches):
            if file in self.plain:
                continue
            walk = self._walk(file, block, None)
            error = None
            try:
                for _ in walk.records(self._pieces(walk, file, block, pieces)):
                    pass
            except DocumentError as err:
                error = str(err)
            edges = []
            if walk.head and walk.head_end != "]":
                edges.append({"part": 0, "value": b"".join(walk.head)})
            if walk.item is not None:
                edges.append({"part": 1, "value": b"".join(walk.item)})
            tail = None if walk.item is None else walk.field.number if walk.field else -1
            yield from _rows_to_batches(
                [{"file": file, "block": block, "root": walk.root, "rows": walk.rows,
                  "head_end": walk.head_end, "head_open": bool(walk.head) and not walk.head_end,
                  "tail_field": tail, "fields": [vars(item) for item in walk.fields],
                  "error": error, "edges": edges}],
                _OUTLINE_ARROW,
            )

    def _find_fields(self, pieces: DataFrame) -> None:
        # The borders' bytes stay in the cluster; the driver sees the numbers.
        outline = written(pieces.mapInArrow(self._outline, _OUTLINE))
        rows = sorted(outline.drop("edges").collect(), key=lambda row: (row.file, row.block))
        chains: list[tuple[str, int, int, int]] = []
        for file, splits in itertools.groupby(rows, key=lambda row: row.file):
            chains += self._plan(file, list(splits))
        if chains:
            self.stitched = stitch(outline.select("file", "block", F.inline("edges")), chains)

    def _plan(self, file: str, splits: list) -> list[tuple[str, int, int, int]]:
        """Choose the records' field, set where each split starts, find border records."""
        is_object = any(row.root == "{" for row in splits)
        # A split numbers its fields from the one that was open at its start.
        bases = [0]
        for row in splits:
            bases.append(bases[-1] + max((item.number for item in row.fields), default=0))
        merged: dict[int, Field] = {}
        for base, row in zip(bases, splits):
            for item in row.fields:
                whole = merged.setdefault(base + item.number, Field(base + item.number))
                whole.name = whole.name or item.name
                whole.opened = whole.opened or item.opened
                whole.closed = item.closed or whole.closed
                whole.objects += item.objects
                whole.others += item.others
        error = next((row.error for row in splits if row.error), None)
        if is_object or error is None:
            try:
                if error:
                    raise DocumentError(error)
                if is_object:
                    self.wanted[file] = record_field(list(merged.values()))
            except DocumentError as err:
                self.failed[file] = str(err)
                return []
        wanted = self.wanted.get(file)
        if is_object and wanted is None:
            return []
        chains, before, open_chain = [], 0, []
        for base, row in zip(bases, splits):
            start = self.starts.get((file, row.block))
            if start is not None:
                start.rows, start.field = before, base if is_object and start.root else -1
            if open_chain and (row.head_open or row.head_end):
                open_chain.append((file, row.block, 0))
                if row.head_end == "}":
                    chains += [(*place, before + 1) for place in open_chain]
                if row.head_end:
                    open_chain = []
            if row.tail_field is not None and (not is_object or base + row.tail_field == wanted):
                open_chain = [(file, row.block, 1)]
            before += (
                sum(item.objects for item in row.fields if base + item.number == wanted)
                if is_object
                else row.rows
            )
        return chains


def _cut(stream: BinaryIO) -> Iterator[bytes]:
    """What a stream holds between its braces, a chunk read at a time."""
    open_piece: list[bytes] = []
    while chunk := stream.read(_CHUNK):
        first, *others = chunk.split(b"}")
        open_piece.append(first)
        for piece in others:
            yield b"".join(open_piece)
            open_piece = [piece]
    yield b"".join(open_piece)


def first_records(stream: BinaryIO, obj: int, count: int) -> Iterator[Record]:
    """The first records of a JSON array. Reads on only while records are asked for.

    What is wrong with the array after its first `count` records stays unseen.
    """
    walk = Walk(Start())
    # The piece after the last brace is given, too, if only as an empty one.
    walk.ends_in_brace = lambda: False
    try:
        texts = walk.records(_without_bom(_cut(stream)))
        for text in itertools.islice(texts, count):
            yield _decode(obj, walk.rows, text)
    except DocumentError as err:
        yield Record(obj, walk.rows + 1, None, str(err))


def _decode(obj: int, row: int, text: bytes) -> Record:
    try:
        return Record(obj, row, decode_object(text, strict=True), None, len(text))
    except (ValueError, RecursionError) as err:
        return Record(obj, row, None, f"{type(err).__name__}: {err}")
