"""Archives: written, read back, and read after damage."""

import hashlib
import io
import random

import pytest

from lakeloader.llm import warc as W
from llm_cases import rows_of

BIG = "<p>" + "page " * 40 + "</p>"
PAGES = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, None), (4, "http://a/\r\n4", ""), (5, "u", "short"), (6, "u", "short"),
    (7, "u", "é" * 50), (8, "u", "é" * 50), (9, "u", "x" * 99), (10, "u", "x" * 99), (None, "u", BIG), (2, "http://a/2", BIG),
    (11, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 20), (12, "u", "y" * 300_000), (13, "u", "\r\n\r\n" * 60),
]
SCHEMA = "page_id long, url string, html string"


def expected(rows):
    first = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page_id is not None:
            first[data] = min(first.get(data, page_id), page_id)
    made = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        known = first.get(data)
        again = known is not None and known != page_id
        made.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", known if again else None))
    return sorted(made, key=repr)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_pages_come_back(spark, monkeypatch):
    monkeypatch.setattr(W, "FILE_BYTES", 600)
    pages = spark.createDataFrame([(*row, "x", 1) for row in PAGES], SCHEMA + ", digest string, refers_to long")
    files = W.write_archives(pages)
    found = W.read_archives(files)
    assert rows_of(W.records(found), *COLUMNS) == expected(PAGES)
    assert W.gaps(found).count() == 0
    payloads = {row.page_id: row.payload for row in W.records(found).where("record_type = 'response'").collect()}
    assert payloads[12] == b"y" * 300_000 and payloads[3] == b""
    assert {row.url for row in W.records(found).where("page_id in (3, 4)").collect()} == {None, "http://a/%0D%0A4"}
    assert files.selectExpr("sum(records)").first()[0] == len(PAGES)


def test_empty_table(spark):
    files = W.write_archives(spark.createDataFrame([], SCHEMA))
    assert W.read_archives(files).count() == 0


class Opened(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, count, at):
        self.seek(at)
        return self.read(count)


def archive(packed, count=12):
    draw, parts = random.Random(3), []
    for i in range(count):
        payload = bytes(draw.choices(b"abc \r\n", k=draw.randrange(2000)))
        record = W.record_bytes(i, "u", payload, hashlib.sha256(payload).hexdigest(), None)
        parts.append(W.member(record) if packed else record)
    return parts


def read(data):
    rows = list(W.salvage(Opened(data)))
    at = 0
    for row in rows:
        assert row["first_byte"] == at
        at = row["end_byte"]
    assert at == len(data)
    return [row["page_id"] for row in rows if "problem" not in row], [row for row in rows if "problem" in row]


@pytest.mark.parametrize("packed", [True, False])
def test_whole_archives(packed):
    assert read(b"".join(archive(packed))) == (list(range(12)), [])


@pytest.mark.parametrize("packed", [True, False])
def test_later_records_are_recovered(packed):
    parts = archive(packed)
    for broken in (0, 5, 11):
        for spoil in (
            lambda x: x[: len(x) // 2],
            lambda x: x[: len(x) // 2] + b"\x00\xff" + x[len(x) // 2 + 2 :],
            lambda x: b"noise" + x[9:],
            lambda x: b"",
        ):
            data = b"".join(spoil(x) if i == broken else x for i, x in enumerate(parts))
            found, gaps = read(data)
            assert found == [i for i in range(12) if i != broken]
            assert len(gaps) == (0 if spoil(parts[broken]) == b"" else 1)


def test_both_kinds_in_one_file_and_noise_between():
    parts = [x for pair in zip(archive(True), archive(False)) for x in pair]
    found, gaps = read(b"start\n" + b"\x1f\x8b\x08noise\n".join(parts) + b"WARC/1.1\r\n")
    assert found == [i for i in range(12) for _ in range(2)]
    assert len(gaps) == len(parts) + 1


def test_a_lying_length_costs_one_record():
    parts = archive(False)
    parts[4] = parts[4].replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 9", 1)
    found, gaps = read(b"".join(parts))
    assert found == [i for i in range(12) if i != 4] and len(gaps) == 1


def test_a_wrong_digest_is_a_gap():
    payload = b"payload"
    data = W.member(W.record_bytes(1, "u", payload, hashlib.sha256(b"other").hexdigest(), None))
    found, gaps = read(data + W.member(W.record_bytes(2, "u", payload, hashlib.sha256(payload).hexdigest(), None)))
    assert found == [2] and "digest" in gaps[0]["problem"]


def test_random_damage_never_raises():
    draw, whole = random.Random(8), b"".join(archive(True) + archive(False))
    for _ in range(60):
        data = bytearray(whole)
        for _ in range(draw.randrange(1, 6)):
            at = draw.randrange(len(data))
            data[at : at + draw.randrange(40)] = bytes(draw.choices(range(256), k=draw.randrange(40)))
        read(bytes(data))


def other(kind, block=b"data", *fields):
    head = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:1>", "WARC-Date: 2020-01-01T00:00:00Z", *fields]
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


HTTP = "Content-Type: application/http; msgtype=response"
PAGE = b"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nSet-Cookie: b=2\r\n\r\n<html>"
BASE32 = "sha1:" + __import__("base64").b32encode(hashlib.sha1(b"<html>").digest()).decode()
OTHERS = [
    (other("warcinfo", b"software: x\r\n", "Content-Type: application/warc-fields"), "warcinfo", b"software: x\r\n"),
    (other("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "Content-Type: application/http; msgtype=request"), "request", b""),
    (other("metadata", b""), "metadata", b""),
    (other("response", PAGE, HTTP), "response", b"<html>"),
    (other("response", PAGE, HTTP, f"WARC-Payload-Digest: {BASE32}", "WARC-Concurrent-To: <urn:1>", "WARC-Concurrent-To: <urn:2>"), "response", b"<html>"),
    (other("response", PAGE.replace(b"Set", b"Transfer-Encoding: chunked\r\nSet"), HTTP, "WARC-Payload-Digest: sha1:AAAA"), "response", b"<html>"),
    (other("response", PAGE, HTTP, "WARC-Payload-Digest: xyz:1", "WARC-Truncated: length"), "response", b"<html>"),
    (other("resource", b"\x00\xff" * 9, "Content-Type: image/png", "X-Long: a\r\n  b"), "resource", b"\x00\xff" * 9),
    (other("response", b"not http at all", HTTP), "response", b""),
]


@pytest.mark.parametrize("packed", [True, False])
def test_records_of_other_makers_are_no_damage(packed):
    data = b"".join(W.member(x) if packed else x for x, _, _ in OTHERS)
    rows = list(W.salvage(Opened(data)))
    assert not [row for row in rows if "problem" in row]
    assert [(row["record_type"], row["payload"]) for row in rows] == [(kind, payload) for _, kind, payload in OTHERS]
    assert all(row["record_id"] == "<urn:uuid:1>" and row["page_id"] is None for row in rows)
    assert [row["payload_digest"] for row in rows] == [hashlib.sha256(x).hexdigest() for _, _, x in OTHERS]


@pytest.mark.parametrize("digest", [BASE32, "sha256:" + hashlib.sha256(b"<html>").hexdigest(), "md5:" + hashlib.md5(b"<html>").hexdigest()])
def test_digests_of_known_kinds_are_checked(digest):
    good = other("response", PAGE, HTTP, f"WARC-Payload-Digest: {digest}")
    bad = good.replace(b"<html>", b"<htmk>")
    assert [row.get("problem") for row in W.salvage(Opened(good + bad + good))] == [None, "the payload differs from its digest", None]
    spoiled = other("resource", b"abc", "WARC-Block-Digest: sha1:" + "A" * 32)
    assert "block differs" in next(W.salvage(Opened(spoiled)))["problem"]


def test_one_limit_for_writer_and_reader(spark, monkeypatch):
    record = W.record_bytes(1, "u", b"x" * 5000, hashlib.sha256(b"x" * 5000).hexdigest(), None)
    monkeypatch.setattr(W, "RECORD_BYTES", len(record))
    assert W.record_bytes(1, "u", b"x" * 5000, hashlib.sha256(b"x" * 5000).hexdigest(), None) == record
    assert read(record) == ([1], []) and len(read(record + b"WARC/1.1\r\n")[1]) == 1
    with pytest.raises(ValueError, match="more than"):
        W.record_bytes(1, "u", b"x" * 5001, hashlib.sha256(b"x" * 5001).hexdigest(), None)


def test_a_long_head_is_read(monkeypatch):
    payload = b"p"
    record = W.record_bytes(1, "u" * 3_000_000, payload, hashlib.sha256(payload).hexdigest(), None)
    assert read(record + record) == ([1, 1], [])


def test_a_gap_in_own_archives_is_an_error(spark):
    rows = spark.createDataFrame([("a", 0, None), ("a", 9, "torn")], "path string, first_byte long, problem string")
    with pytest.raises(Exception, match="a gap in a at byte 9: torn"):
        W.undamaged(rows).collect()
    assert W.undamaged(rows.limit(1)).count() == 1
