"""Parquet by row groups: types Spark lacks, and files gzipped as a whole."""

import datetime
import gzip
import io

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from cases import minutes

from lakeloader import LoadError
from lakeloader.functions.jsontext import plain_json
from lakeloader.sources.heads import parquet_head
from lakeloader.sources.parquet import readable, readable_type

NANOS = [1_788_264_000_000_000_000, None, -1, -1_000, 1_788_264_000_123_456_789, 1_000_000]


def stored(table, **options):
    buffer = io.BytesIO()
    pq.write_table(table, buffer, **options)
    return buffer.getvalue()


def shown(value):
    """A nanosecond timestamp as text, from its digits."""
    if value is None:
        return None
    second, rest = divmod(value, 10**9)
    clock = datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=second)
    digits = "" if not rest else f".{rest // 1000:06d}" if rest % 1000 == 0 else f".{rest:09d}"
    return clock.isoformat() + digits + "+00:00"


def cut(value):
    return None if value is None else datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=value // 1000)


def arrays():
    at = pa.array(NANOS, pa.timestamp("ns"))
    size = len(NANOS)
    return {
        "at": at,
        "zoned": at.cast(pa.timestamp("ns", "UTC")),
        "clock": pa.array([None, *range(0, (size - 1) * 1500, 1500)], pa.time32("ms")),
        "span": pa.array([90_061_000, None, 0, 1, 2, 3], pa.duration("ms")),
        "big": pa.array([2**64 - 1, None, 0, 1, 2, 3], pa.uint64()),
        "kind": pa.array(["a", "b", None, "a", "b", "a"]).dictionary_encode(),
        "meta": pa.array([{"at": x, "n": i} if i != 2 else None for i, x in enumerate(NANOS)], pa.struct([("at", pa.timestamp("ns")), ("n", pa.int16())])),
        "times": pa.array([[x, None] if i % 2 else [] for i, x in enumerate(NANOS)], pa.list_(pa.timestamp("ns"))),
        "items": pa.array([None, [], [{"at": 5_000}], [None, {"at": None}], [{"at": 1}] * 3, [{"at": -7}]], pa.list_(pa.struct([("at", pa.timestamp("ns"))]))),
        "named": pa.array([[("k", x)] if i % 2 else None for i, x in enumerate(NANOS)], pa.map_(pa.string(), pa.timestamp("ns"))),
        "pair": pa.array([[x, x] for x in NANOS], pa.list_(pa.timestamp("ns"), 2)),
    }


@pytest.mark.parametrize("name", sorted(arrays()))
@pytest.mark.parametrize("span", [(0, 6), (1, 4), (3, 0)])
def test_arrays_keep_their_values(name, span):
    array = arrays()[name].slice(*span)
    values = NANOS[span[0] : span[0] + span[1]]
    dated = readable(array, readable_type(array.type, (name,))).to_pylist()
    text = readable(array, readable_type(array.type, (name,), frozenset())).to_pylist()
    assert len(dated) == len(text) == span[1]
    if name in ("at", "zoned"):
        assert [x and x.replace(tzinfo=None) for x in dated] == list(map(cut, values))
        assert text == list(map(shown, values))
    elif name == "meta":
        rows = list(range(len(NANOS)))[span[0] : span[0] + span[1]]
        assert text == [None if i == 2 else {"at": shown(NANOS[i]), "n": i} for i in rows]
        assert dated == [None if i == 2 else {"at": cut(NANOS[i]), "n": i} for i in rows]
    elif name == "pair":
        assert text == [[shown(x)] * 2 for x in values]
    elif name == "items":
        expected = [None, [], [{"at": shown(5000)}], [None, {"at": None}], [{"at": shown(1)}] * 3, [{"at": shown(-7)}]]
        assert text == expected[span[0] : span[0] + span[1]]
    elif name == "times":
        assert text == [[shown(x), None] if i % 2 else [] for i, x in enumerate(NANOS)][span[0] : span[0] + span[1]]
    elif name == "named":
        assert text == [[("k", shown(x))] if i % 2 else None for i, x in enumerate(NANOS)][span[0] : span[0] + span[1]]
    elif name == "big":
        assert [None if x is None else int(x) for x in text] == array.to_pylist()
    elif name == "span":
        assert text == [None if x is None else str(x) for x in array.to_pylist()]
    else:
        assert text == [plain_json(x) for x in array.to_pylist()]


def odd(first, count, nanos=1):
    rows = range(first, first + count)
    return pa.table(
        {
            "id": list(rows), "at": pa.array([x * 10**9 + nanos for x in rows], pa.timestamp("ns")),
            "lines": pa.array([[{"no": x, "at": x * 1000}] * (x % 3) for x in rows], pa.list_(pa.struct([("no", pa.int64()), ("at", pa.timestamp("ns"))]))),
            "pad": ["x" * 200 + str(x) for x in rows],
        }
    )


def test_rows_are_numbered_over_row_groups_and_children_found(bucket):
    bucket.put("odd.parquet", stored(odd(0, 1000), row_group_size=130))
    bucket.discover()
    assert bucket.kinds("odd") == {"id": "integer", "at": "date-time", "pad": "string"}
    bucket.sync()
    rows = bucket.rows("odd")
    assert [(row["id"], row["_row_number"]) for row in rows] == [(n, n + 1) for n in range(1000)]
    assert rows[7]["at"] == "1970-01-01T00:00:07+00:00"
    children = bucket.rows("odd__lines", "no", "at", "_parent__id", "_parent__at", "_parent_row")
    assert len(children) == sum(n % 3 for n in range(1000))
    assert all(row["no"] == row["_parent__id"] and row["_parent_row"] == f"odd.parquet#{row['no'] + 1}" for row in children)
    assert {row["at"] for row in children if row["no"] == 1} == {"1970-01-01T00:00:00.000001+00:00"}
    assert {row["_parent__at"] for row in children if row["no"] == 4} == {"1970-01-01T00:00:04+00:00"}


def test_a_text_column_shows_all_digits(bucket):
    bucket.put("t/a.parquet", stored(pa.table({"at": pa.array(NANOS, pa.timestamp("ns"))})), minutes(1))
    bucket.put("t/b.parquet", stored(pa.table({"at": ["later"]})), minutes(2))
    bucket.discover()
    assert bucket.kinds("t") == {"at": "string"}
    bucket.sync()
    assert [row["at"] for row in bucket.data("t")] == [*map(shown, NANOS), "later"]


def test_several_schemas_and_no_rows(bucket):
    bucket.put("t/a.parquet", stored(odd(0, 3)), minutes(1))
    bucket.put("t/b.parquet", stored(odd(3, 1).slice(0, 0)), minutes(2))
    bucket.put("t/c.parquet", stored(pa.table({"id": [9], "span": pa.array([61], pa.duration("s"))})), minutes(3))
    bucket.discover()
    bucket.sync()
    assert [(row["id"], row["span"]) for row in bucket.data("t")] == [(0, None), (1, None), (2, None), (9, "0:01:01")]


@pytest.mark.parametrize("suffix", ["", ".gz"])
def test_a_damaged_row_group_fails_with_its_key(bucket, suffix):
    whole = stored(odd(0, 4000), row_group_size=1000, compression="none", use_dictionary=False)
    bucket.put("t/a.parquet", stored(odd(0, 5)), minutes(1))
    bucket.put(f"t/b.parquet{suffix}", whole, minutes(2))
    bucket.discover()
    # The footer stays; pages in the middle have no valid header.
    middle = len(whole) // 2
    damaged = whole[: middle - 60_000] + b"\xff" * 120_000 + whole[middle + 60_000 :]
    bucket.put_raw(f"t/b.parquet{suffix}", gzip.compress(damaged) if suffix else damaged, minutes(2))
    with pytest.raises(LoadError, match="t/b.parquet"):
        bucket.sync()
    assert [row["id"] for row in bucket.rows("t")] == [0, 1, 2, 3, 4]
    bucket.put(f"t/b.parquet{suffix}", whole, minutes(2))
    bucket.sync()
    assert len(bucket.rows("t")) == 4005


def test_gzipped_files_are_read_by_their_row_groups(bucket, monkeypatch):
    bucket.put("t/a.parquet.gz", stored(odd(0, 400), row_group_size=100), minutes(1))
    bucket.put("t/b.parquet.gz", stored(pa.table({"id": list(range(400, 800))}), row_group_size=100), minutes(2))
    bucket.discover()
    bucket.sync()
    assert [(row["id"], row["_row_number"]) for row in bucket.rows("t")] == [(n, n % 400 + 1) for n in range(800)]
    (key,) = {row["_s3_key"] for row in bucket.rows("t") if row["id"] == 0}
    assert key == "t/a.parquet.gz"


def test_a_truncated_gzipped_file_is_an_error(bucket):
    data = gzip.compress(stored(odd(0, 400)))
    bucket.put("t/a.parquet", stored(odd(0, 2)), minutes(1))
    bucket.discover()
    bucket.put_raw("t/b.parquet.gz", data[: len(data) // 2], minutes(2))
    with pytest.raises(LoadError, match="t/b.parquet.gz"):
        bucket.sync()
    assert len(bucket.rows("t")) == 2


def test_a_footer_tells_the_row_groups(tmp_path):
    path = tmp_path / "x.parquet"
    path.write_bytes(stored(odd(0, 25), row_group_size=10))
    schema, groups = parquet_head(str(path))
    assert groups == [10, 10, 5] and schema.field("at").type == pa.timestamp("ns")
