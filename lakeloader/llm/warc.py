"""WARC archives: a writer that never stores a payload twice, and a reader that salvages damaged files.

Every record is a gzip member of its own. A page whose payload another page has
already is written as a revisit that names the other's record. Tasks write whole
files below a shared folder and report them; only reported files are read, so what
a lost task left behind plays no part.

The reader takes records of every type. It checks each one: gzip checksum, version
line, lengths, closing blank lines, and the digests of block and payload where they are
of a known kind and the payload is stored as it was. After a failed check it looks for the next gzip member or
version line that holds a record, goes on there, and reports the bytes in between
as a gap.

Defined results: null payload counts as empty; payloads under `REVISIT_BYTES` are
always responses; of equal payloads the smallest id is the response (rows that tie
on it all are), a null id is never smaller than another; control characters of a
URL are percent-encoded, a null URL has no header; empty tables give no files. A record
of more than `RECORD_BYTES` is an error for the writer, and a gap for the reader. Records
of other makers have no page id; a payload is what follows the HTTP head, or the block.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloader.llm.base import column, in_tasks, slices
from lakeloader.session import fresh_folder, written

#: Payloads of fewer bytes are cheaper to store again.
REVISIT_BYTES = 100
#: A task begins a new file after this many bytes.
FILE_BYTES = 64 << 20
#: No record is written or read beyond this size, its head included.
RECORD_BYTES = 1 << 30
DATE = "1970-01-01T00:00:00Z"
_BLOCK = 1 << 20
_GZIP = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_END = b"\r\n\r\n"
RECORDS = (
    "path string, first_byte long, end_byte long, problem string, record_id string, content_type string, "
    "page_id long, url string, record_type string, "
    "refers_to long, payload_bytes long, payload_digest string, payload binary"
)


class Damaged(Exception):
    """A record that fails a check."""


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, uncompressed; with `refers_to` a revisit without the payload."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f]", lambda x: f"%{ord(x[0]):02X}", url))
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:x-page:{refers_to}>")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    head.append("Content-Type: application/http;msgtype=response")
    head.append(f"Content-Length: {len(block)}")
    record = "\r\n".join(head).encode() + _END + block + _END
    if len(record) > RECORD_BYTES:
        raise ValueError(f"page {page_id}: a record of {len(record)} bytes is more than {RECORD_BYTES}")
    return record


def member(record: bytes) -> bytes:
    """A gzip member of its own; equal records give equal bytes."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


def write_archives(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html") -> DataFrame:
    """Write one record per row; returns the files as `path, records, bytes`."""
    spark = pages.sparkSession
    payload = F.coalesce(column(payload_column).cast("binary"), F.lit(b""))
    rows = pages.select(
        column(id_column).cast("long").alias("page_id"), column(url_column).cast("string").alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    # Which rows are revisits is settled on ids and digests; a digest that very many
    # pages share meets no payload, and payloads are joined by their own page.
    light = written(rows.select("page_id", "digest", F.octet_length("payload").alias("bytes")), "payload-digests")
    firsts = (
        light.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("pages")).where("pages > 1")
    )
    revisits = (
        light.join(firsts, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select(F.col("page_id").alias("__id"), F.col("digest").alias("__digest"), "refers_to").distinct()
    )
    same = F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest"))
    typed = rows.join(revisits, same, "left").select("page_id", "url", "payload", "digest", "refers_to")
    folder = fresh_folder(spark, "warc")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        files, where = _files(folder)
        files.create_dir(where, recursive=True)
        made: list[tuple[str, int, int]] = []
        target = None
        for batch in slices(batches):
            for page_id, url, payload, digest, refers_to in zip(*(x.to_pylist() for x in batch.columns)):
                if target is None:
                    name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{len(made):04d}.warc.gz"
                    target = files.open_output_stream(f"{where}/{name}", compression=None)
                    made.append((f"{folder}/{name}", 0, 0))
                data = member(record_bytes(page_id, url, payload, digest, refers_to))
                target.write(data)
                made[-1] = (made[-1][0], made[-1][1] + 1, made[-1][2] + len(data))
                if made[-1][2] >= FILE_BYTES:
                    target.close()
                    target = None
        if target is not None:
            target.close()
        names = ("path", "records", "bytes")
        yield pa.RecordBatch.from_pylist(
            [dict(zip(names, x)) for x in made], pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
        )

    return written(in_tasks(typed, work, "path string, records long, bytes long"), "warc-files")


def _files(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


def read_archives(files: DataFrame) -> DataFrame:
    """All records of the files named in `path`, and a row with a `problem` for each gap."""
    paths = files.select("path").repartition(max(files.count(), 1), "path")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow_schema()
        for batch in batches:
            for path in batch.column("path").to_pylist():
                source, where = _files(path)
                with source.open_input_file(where) as opened:
                    rows, held = [], 0
                    for row in salvage(opened):
                        rows.append(row | {"path": path})
                        held += len(row.get("payload") or b"") + 500
                        if held > _BLOCK * 8:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return in_tasks(paths, work, RECORDS)


def _arrow_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in RECORDS.split(", "))])


def records(rows: DataFrame) -> DataFrame:
    return rows.where("problem IS NULL").drop("problem")


def undamaged(rows: DataFrame) -> DataFrame:
    """The records of archives that must be whole: a gap is an error."""
    problem = F.concat(F.lit("a gap in "), "path", F.lit(" at byte "), F.col("first_byte").cast("string"), F.lit(": "), "problem")
    return rows.where(F.when(F.col("problem").isNull(), True).otherwise(F.raise_error(problem).cast("boolean"))).drop("problem")


def gaps(rows: DataFrame) -> DataFrame:
    return rows.where("problem IS NOT NULL").select("path", "first_byte", "end_byte", "problem")


def salvage(source) -> Iterator[dict]:
    """Records and gaps of an open file, in order of their bytes."""
    size, at = source.size(), 0
    gap = None
    while at < size:
        try:
            found, end = _record_at(source, at, size)
        except Damaged as damage:
            end = _next_start(source, at + 1, size)
            # Places that only looked like a record lengthen the gap.
            gap = gap or {"first_byte": at, "problem": str(damage)}
            gap["end_byte"] = end
        else:
            if gap:
                yield gap
                gap = None
            yield found | {"first_byte": at, "end_byte": end}
        at = end
    if gap:
        yield gap


def _record_at(source, at: int, size: int) -> tuple[dict, int]:
    start = source.read_at(10, at)
    if start.startswith(_GZIP):
        data, end = _unpacked(source, at, size)
        found, length = parse(data)
        if length != len(data):
            raise Damaged("bytes after the record of a member")
        return found, end
    if _VERSION.match(start):
        most, step = min(size - at, RECORD_BYTES), 1 << 14
        data = source.read_at(min(step, most), at)
        while _END not in data and len(data) < most:
            step *= 4
            data = source.read_at(min(step, most), at)
        length = _lengths(data)
        if at + length > size:
            raise Damaged("the file ends within a record")
        found, length = parse(source.read_at(length, at))
        return found, at + length
    raise Damaged("no record begins here")


def _unpacked(source, at: int, size: int, most: int = RECORD_BYTES) -> tuple[bytes, int]:
    """A gzip member's content and the place after it; at most about `most` bytes."""
    unpack, parts, done, read = zlib.decompressobj(31), [], 0, at
    try:
        while not unpack.eof:
            block = source.read_at(1 << 16, read)
            if not block:
                raise Damaged("the file ends within a member")
            read += len(block)
            while block and not unpack.eof:
                parts.append(unpack.decompress(block, _BLOCK))
                block = unpack.unconsumed_tail
                done += len(parts[-1])
                if done > most:
                    raise Damaged("a record is too large")
    except zlib.error as error:
        raise Damaged(f"gzip: {error}") from None
    return b"".join(parts), read - len(unpack.unused_data)


def _lengths(data: bytes) -> int:
    """Bytes of the record whose head `data` begins with."""
    head, close, _ = data.partition(_END)
    if not close or not _VERSION.match(data):
        raise Damaged("no head of a record")
    length = _fields(head, _ONCE).get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,12}", length) or len(head) + 8 + int(length) > RECORD_BYTES:
        raise Damaged("no valid Content-Length")
    return len(head) + 4 + int(length) + 4


#: Fields a record has once.
_ONCE = frozenset(("warc-type", "warc-record-id", "warc-date", "content-length"))


def _fields(head: bytes, once: frozenset = frozenset()) -> dict[str, str]:
    """Names and first values below the first line; a cut-off head runs into another one's lines."""
    made: dict[str, str] = {}
    for line in re.sub(rb"\r\n[ \t]+", b" ", head).split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!-~]+", name) or re.search(rb"[\x00-\x08\x0a-\x1f\x7f]", value):
            raise Damaged("a line of the head is no field")
        try:
            field, text = name.decode().lower(), value.decode().strip()
        except UnicodeDecodeError:
            raise Damaged("the head is not UTF-8") from None
        if field in made and field in once:
            raise Damaged("a field stands twice in the head")
        made.setdefault(field, text)
    return made


def _differs(data: bytes, stated: str) -> bool:
    """Whether data has another digest than the stated one; digests of unknown kinds tell nothing."""
    name, _, value = stated.partition(":")
    kind = name.lower().replace("-", "")
    if kind not in ("md5", "sha1", "sha256", "sha512"):
        return False
    digest = hashlib.new(kind, data).digest()
    return value.lower() != digest.hex() and value.upper().rstrip("=") != base64.b32encode(digest).decode().rstrip("=")


def parse(data: bytes) -> tuple[dict, int]:
    """The record at the start of `data` and its length."""
    length = _lengths(data)
    if len(data) < length or data[length - 4 : length] != _END:
        raise Damaged("the block does not end where it should")
    head, _, block = data[: length - 4].partition(_END)
    fields = _fields(head, _ONCE)
    kind, content = fields.get("warc-type", ""), fields.get("content-type")
    if not kind:
        raise Damaged("a record without a type")
    if _differs(block, fields.get("warc-block-digest", "")):
        raise Damaged("the block differs from its digest")
    payload, http = block, {}
    if (content or "").lower().startswith("application/http"):
        answer, _, payload = block.partition(_END)
        try:
            http = _fields(answer)
        except Damaged:
            # Servers write heads of all kinds; the record is whole.
            http = {}
    # A revisit's payload is elsewhere, and others may be stored in part or in transfer coding.
    stated, stored = fields.get("warc-payload-digest", ""), kind != "revisit"
    as_it_was = stored and "warc-truncated" not in fields and "transfer-encoding" not in http
    if as_it_was and _differs(payload, stated):
        raise Damaged("the payload differs from its digest")
    known = re.fullmatch(r"(?i)sha-?256:([0-9a-f]{64})", stated)
    size = http.get("content-length", "")
    return {
        "record_id": fields.get("warc-record-id"), "content_type": content,
        "page_id": _page(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "record_type": kind,
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload_bytes": len(payload) if stored else int(size) if re.fullmatch("[0-9]{1,18}", size) else None,
        "payload_digest": known[1].lower() if known else hashlib.sha256(payload).hexdigest() if stored else None,
        "payload": payload if stored else None,
    }, length


def _page(text: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?[0-9]+)>", text or "")
    return int(found[1]) if found else None


def _next_start(source, at: int, size: int) -> int:
    """The next place from `at` on where a member or a version line begins a record; else the end."""
    sign = re.compile(re.escape(_GZIP) + rb"|WARC/1\.[01]\r\n")
    while at < size:
        # A little more than a block, for a sign across its border.
        block = source.read_at(_BLOCK + 16, at)
        for found in sign.finditer(block):
            place = at + found.start()
            if found[0] != _GZIP:
                return place
            try:
                unpack = zlib.decompressobj(31)
                if _VERSION.match(unpack.decompress(source.read_at(1 << 12, place), 16)):
                    return place
            except zlib.error:
                pass
        at += _BLOCK
    return size
