"""Objects cut into many splits: rows at every kind of border, numbered as in the file."""

import csv
import io
import json
import random

import pytest
from cases import minutes


@pytest.fixture
def tiny_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "1500")
    spark.conf.set(names[1], "10")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def text(rng, alphabet, longest):
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest)))


def test_delimited(bucket, tiny_splits):
    rng = random.Random(3)
    expected = {}
    for number, encoding in enumerate(["utf-8", "cp1252", "utf-8"]):
        rows = [[str(n), text(rng, 'ab",\n\r é;' if number < 2 else "abc ", 40)] for n in range(150)]
        if number == 0:
            rows[70][1] = 'x"\n' * 700
        out = io.StringIO(newline="")
        writer = csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL if number < 2 else csv.QUOTE_MINIMAL)
        writer.writerows([["id", "v"], *rows])
        bucket.put(f"t{number}.csv", out.getvalue().encode(encoding), minutes(1))
        expected[f"t{number}"] = [(n + 1, row[0], row[1] or None) for n, row in enumerate(rows)]
    bucket.discover()
    bucket.sync()
    for name, rows in expected.items():
        assert [(r["_row_number"], r["id"], r["v"]) for r in bucket.rows(name)] == rows


def test_json(bucket, tiny_splits):
    rng = random.Random(4)
    rows = [
        {"id": n, "v": text(rng, '}{][",\\ é\n', 30), "o": {"a": {"b": n}}, "l": [{"w": k} for k in range(n % 4)]}
        for n in range(120)
    ]
    rows[50]["v"] = '}"' * 900
    bucket.put("lines.jsonl", "\n\n".join(json.dumps(row, ensure_ascii=False) for row in rows), minutes(1))
    bucket.put("array.json", json.dumps(rows, ensure_ascii=False), minutes(1))
    bucket.put("pretty.json", json.dumps(rows, indent=1) + "\n", minutes(1))
    skip = {"big": "}" * 1500, "deep": [[{"x": [1, {"y": 2}]}] * 40], "notes": [{"n": 1}] * 50 + ["x"]}
    bucket.put("wrapped.json", json.dumps({**skip, "rows": rows, "after": skip}), minutes(1))
    bucket.discover()
    bucket.sync()
    for name in ("lines", "array", "pretty", "wrapped"):
        found = [(r["_row_number"], r["id"], r["v"], r["o__a__b"]) for r in bucket.rows(name)]
        assert found == [(n + 1, n, row["v"], n) for n, row in enumerate(rows)], name
        kids = sorted((r["_parent__id"], r["_index"], r["w"]) for r in bucket.rows(f"{name}__l"))
        assert kids == [(n, k, k) for n in range(120) for k in range(n % 4)], name


def test_an_error_in_a_late_split(bucket, tiny_splits):
    from lakeloader import LoadError

    rows = [json.dumps({"id": n, "v": "x" * 50}) for n in range(100)]
    bucket.put("a.jsonl", "\n".join(rows), minutes(1))
    bucket.discover()
    rows[90] = '{"id": '
    bucket.put("a.jsonl", "\n".join(rows), minutes(2))
    with pytest.raises(LoadError, match="a.jsonl.*row 91"):
        bucket.sync()
    bucket.put("a.json", "[" + ",".join(rows) + "]", minutes(3))
    assert "a.json" in bucket.discover().skipped
