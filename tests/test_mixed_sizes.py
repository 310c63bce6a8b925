"""One large object among small ones, at Spark's own split settings, and changing line ends."""

import json

import pytest
from cases import minutes

from lakeloader import Sink

LARGE, SMALL = 220_000, 20_000


def records(first, count):
    return [{"id": n, "v": f"v{n}" + ' "x"\n' * (n % 3 == 0) + "-" * (n % 90)} for n in range(first, first + count)]


def quoted(rows):
    return "id,v\n" + "".join('{},"{}"\n'.format(row["id"], row["v"].replace('"', '""')) for row in rows)


FORMATS = {
    "csv": quoted,
    "jsonl": lambda rows: "\n".join(map(json.dumps, rows)),
    "array.json": json.dumps,
    "wrapped.json": lambda rows: json.dumps({"n": len(rows), "rows": rows}),
}


@pytest.mark.parametrize("kind", FORMATS)
def test_rows_keep_their_numbers(bucket, kind):
    end = kind.rpartition(".")[2]
    for number in range(9):
        rows = records(number * 1_000_000, LARGE if number == 4 else SMALL)
        bucket.put(f"t/2026-01-0{number + 1}.{end}", FORMATS[kind](rows), minutes(number))
    found = bucket.discover()
    (name,) = found.catalog.streams
    bucket.sync()
    frame = Sink(bucket.spark, bucket.sink_folder).read(found.catalog.streams[name])
    wrong = frame.where("cast(id as bigint) % 1000000 + 1 <> _row_number").count()
    assert (frame.count(), wrong) == (LARGE + 8 * SMALL, 0)
    assert frame.select("id").distinct().count() == LARGE + 8 * SMALL


@pytest.mark.parametrize("first, then", [("\r", "\n"), ("\n", "\r"), ("\r\n", "\r"), ("\r", "\r\n"), ("\r", "\r")])
def test_line_ends_may_change_after_any_number_of_characters(bucket, first, then):
    body = "id,v" + first + first.join(f"{n},a" for n in range(4000)) + first
    bucket.put("t.csv", body + then.join(f"{n},b" for n in range(4000, 4010)), minutes(1))
    bucket.discover()
    bucket.sync()
    assert [(row["_row_number"], row["id"]) for row in bucket.rows("t")] == [(n + 1, str(n)) for n in range(4010)]
