"""Discovery: sampling, kinds, naming, and the catalog's forms."""

import gzip
import io
import itertools
import json

import pytest
from cases import minutes

from lakeloader import Catalog, Column, Stream
from lakeloader.functions import kinds as K
from lakeloader.plans import discover as discovery
from lakeloader.plans.catalog import plan_child_names
from lakeloader.sources import document
from lakeloader.sources.document import first_records


def lines(*rows):
    return "".join(json.dumps(row) + "\n" for row in rows)


def test_kinds_of_json_values(bucket):
    values = {
        "i": ([1, 2], "integer"), "n": ([1, 2.5], "number"), "b": ([True, None], "boolean"),
        "d": (["2026-09-01", "2026-09-01T12:30:00Z"], "date-time"), "q": (["42", "43"], "string"),
        "us": (["09/01/2026", None], "string"), "e": (["", None], "string"), "m": ([1, "x"], "string"),
        "db": (["2026-09-01", ""], "date-time"), "bi": ([True, 1], "string"), "w": ([10**20, 1], "wide-integer"),
        "dm": (["2026-09-01", 1], "string"),
    }
    bucket.put("a.jsonl", lines(*({k: v[n] for k, (v, _) in values.items()} for n in range(2))))
    bucket.discover()
    assert bucket.kinds("a") == {name: kind for name, (_, kind) in values.items()}
    bucket.sync()
    first, second = bucket.data("a")
    assert (first["w"], first["d"], first["m"], first["bi"], second["e"]) == (
        10**20, "2026-09-01T00:00:00+00:00", "1", "true", None,
    )
    assert (first["e"], second["db"], second["n"]) == ("", None, 2.5)


def test_the_newest_objects_that_parse_are_sampled(bucket):
    for number in range(12):
        body = "not json\n" if number in (9, 11) else lines({f"c{number}": 1})
        bucket.put(f"s/{number:02}.jsonl", body, minutes(number))
    found = bucket.discover()
    assert list(bucket.kinds("s")) == ["c10", "c8", "c7", "c6", "c5"]
    assert sorted(found.skipped) == ["s/09.jsonl", "s/11.jsonl"]


def test_only_the_first_rows_are_sampled(bucket):
    rows = [{"id": n} for n in range(1000)]
    bucket.put("a.jsonl", lines(*rows, {"id": "x", "late": 1}) + "broken")
    bucket.put("b.json", json.dumps([*rows, {"id": "x", "late": 1}])[:-1])
    found = bucket.discover()
    assert bucket.kinds("a") == {"id": "integer"}
    assert bucket.kinds("b") == {"id": "integer"}
    assert found.skipped == {}


def test_formats_of_one_stream_merge(bucket):
    bucket.put("t/a.csv", "id,v\n1,2\n", minutes(1))
    bucket.put("t/b.jsonl", lines({"id": 1, "v": None, "w": 1.5}), minutes(2))
    bucket.put("t/c.jsonl", lines({"w": 2}), minutes(3))
    bucket.discover()
    assert bucket.kinds("t") == {"w": "number", "id": "string", "v": "string"}
    bucket.sync()
    assert bucket.data("t") == [
        {"w": None, "id": "1", "v": "2"}, {"w": 1.5, "id": "1", "v": None}, {"w": 2.0, "id": None, "v": None},
    ]


def test_clashing_child_names(bucket):
    bucket.put("orders.json", '[{"id": 1, "items": [{"v": 1, "sub": [{"w": 2}]}]}]')
    bucket.put("orders__items.json", '[{"id": 2}]')
    found = bucket.discover()
    assert found.clashes == [("orders__items", "orders__items_2")]
    assert sorted(bucket.catalog.streams) == [
        "orders", "orders__items", "orders__items_2", "orders__items_2__sub",
    ]
    bucket.sync()
    assert [row["v"] for row in bucket.data("orders__items_2")] == [1]
    assert bucket.rows("orders__items_2__sub")[0]["_row_key"] == "orders.json#1/items#0/sub#0"


def test_child_names_are_planned_parents_first():
    children = [("a", (("b",), ("c",))), ("a", (("b",),)), ("a__b", (("c",),))]
    planned = {child.lineage: child for child in plan_child_names(children, ["a", "a__b", "a__b__c"])}
    assert planned[(("b",),)].name == "a__b_2"
    assert planned[(("b",), ("c",))].name == "a__b_2__c"
    assert [c.name for c in plan_child_names([("x", (("y",),))], ["x"])] == ["x__y"]


def catalog():
    return Catalog(
        {
            "orders": Stream("orders", (Column("id", K.INTEGER), Column("at", K.DATE_TIME), Column("w", K.WIDE_INTEGER))),
            "orders__l": Stream("orders__l", (Column("v", K.NUMBER, False),), "orders", ("l",), False, True),
            "none": Stream("none"),
        }
    )


def test_catalog_forms(spark):
    assert Catalog.from_json(catalog().to_json()).streams == catalog().streams
    assert Catalog.from_frame(catalog().to_frame(spark)).streams == catalog().streams


def test_catalog_from_another_tool():
    text = json.dumps({"streams": [
        {"stream": "o", "schema": {"properties": {
            "_s3_key": {"type": ["string"]}, "a": {"type": ["null", "integer"]}, "b": {"type": "string", "format": "date"},
            "c": {"type": ["string", "integer", "null"]}, "d": {"type": ["object", "null"]}}},
         "metadata": [{"breadcrumb": [], "metadata": {"selected": True}},
                      {"breadcrumb": ["properties", "a"], "metadata": {"selected": False}}]},
        {"stream": "o__x", "schema": {"properties": {"_index": {"type": ["integer"]}, "v": {"type": ["number", "null"]}}},
         "metadata": [{"breadcrumb": [], "metadata": {"some.parent-stream": "o", "some.list-path": ["x"]}}]},
        {"stream": "bad", "schema": {}, "metadata": [{"breadcrumb": [], "metadata": {"some.parent-stream": "o"}}]},
    ]})
    found = Catalog.from_json(text)
    assert [(c.name, c.kind, c.selected) for c in found.streams["o"].columns] == [
        ("a", "integer", False), ("b", "date", True), ("c", "any", True), ("d", "object", True),
    ]
    groups, skipped = found.link()
    assert [sorted(group.members) for group in groups] == [[(), (("x",),)]]
    assert "not valid" in skipped["bad"]


def test_links_follow_recorded_parents():
    streams = {
        "a": Stream("a"),
        "renamed": Stream("renamed", (), "a", ("l",)),
        "deep": Stream("deep", (), "renamed", ("m",)),
        "lost": Stream("lost", (), "gone", ("l",)),
        "lost_child": Stream("lost_child", (), "lost", ("m",)),
        "hidden_child": Stream("hidden_child", (), "only_objects", ("l",)),
        "c1": Stream("c1", (), "c2", ("l",)),
        "c2": Stream("c2", (), "c1", ("l",)),
    }
    groups, skipped = Catalog(streams).link(["a", "only_objects"])
    members = {group.root: group.members for group in groups}
    assert members["a"][(("l",), ("m",))].name == "deep"
    assert not members["only_objects"][()].selected
    assert sorted(skipped) == ["c1", "c2", "lost", "lost_child"]


@pytest.mark.parametrize("kind", [K.INTEGER, K.NUMBER, K.BOOLEAN, K.DATE_TIME, K.DATE, K.STRING, K.OBJECT, K.ARRAY])
def test_properties_and_back(kind):
    assert K.kind_of_property(K.json_property(kind)) == kind


def test_merge_lattice(spark):
    from itertools import product

    from pyspark.sql import functions as F

    def merge(a, b):
        if a == b or b == "empty":
            return a
        if a == "empty":
            return b
        return "number" if {a, b} == {"integer", "number"} else "string"

    kinds = ["empty", "integer", "number", "boolean", "date-time", "date", "string"]
    cases = [(n, list(case)) for n, case in enumerate(product(kinds, repeat=3))]
    rows = spark.createDataFrame(cases, "n int, kinds array<string>")
    found = dict(rows.select("n", K.merged_kind(F.array_distinct("kinds"))).collect())
    for n, (a, b, c) in cases:
        assert found[n] == merge(merge(a, b), c)


def test_objects_that_changed_since_the_listing_are_skipped(bucket):
    from lakeloader import discover

    bucket.put("s/a.jsonl", lines({"a": 1}), minutes(1))
    bucket.put("s/b.jsonl", lines({"b": 1}), minutes(2))
    listing = bucket.spark.createDataFrame(bucket.listing().collect(), bucket.listing().schema)
    bucket.put("s/b.jsonl", lines({"b": 1, "c": 2}), minutes(3))
    found = discover(listing)
    assert "changed" in found.skipped["s/b.jsonl"]
    assert [column.name for column in found.catalog.streams["s"].columns] == ["a"]


class Counted(io.BytesIO):
    """Bytes that count how many were read of them."""

    taken = 0

    def read(self, size=-1):
        data = super().read(size)
        self.taken += len(data)
        return data


@pytest.mark.parametrize("tail", [b"]", b"", b", 7]", b"}}"])
def test_an_array_is_read_as_far_as_it_is_sampled(tail):
    rows = [{"n": n, "t": "}{\"[" * (n % 3), "l": [{"a": [n]}, {}], "o": {"p": {}}} for n in range(60_000)]
    text = b"\xef\xbb\xbf [" + ",\n".join(map(json.dumps, rows)).encode() + tail
    source = Counted(text)
    found = list(first_records(source, 4, 1000))
    assert [record.value for record in found] == rows[:1000]
    assert {record.obj for record in found} == {4} and found[-1].row == 1000
    assert source.taken < len(text) / 5


@pytest.mark.parametrize(
    "text, good, error",
    [
        ("[]", 0, None), (" [ ] ", 0, None), ('[{"a": 1}]', 1, None), ('[{"a": "}"}, {}]', 2, None),
        ("[", 0, "incomplete"), ('[{"a": 1}', 1, "incomplete"), ('[{"a": 1', 0, "incomplete"),
        ('[{"a": 1}}', 1, "DocumentError"), ('[{"a": 1}, 2]', 1, "DocumentError"), ('[{"a": 01}, {}]', 0, "ValueError"),
    ],
)
@pytest.mark.parametrize("chunk", [1, 3, 1 << 16])
def test_short_and_broken_arrays(monkeypatch, text, good, error, chunk):
    monkeypatch.setattr(document, "_CHUNK", chunk)
    found = list(first_records(io.BytesIO(text.encode()), 0, 1000))
    assert len(list(itertools.takewhile(lambda record: record.error is None, found))) == good
    assert any(record.error for record in found) == (error is not None)
    if error == "incomplete":
        assert "incomplete" in found[-1].error


def test_streams_with_many_bad_objects_are_looked_at_in_even_rounds(bucket, monkeypatch):
    monkeypatch.setattr(discovery, "_LOOK_AGAIN", 3)
    # Only every fifth object of the first stream parses, none of the second, all of the third.
    for number in range(31):
        bucket.put(f"a/{number:02}.json", f'[{{"c{number}": 1}}]' if number % 5 == 0 else "[{", minutes(number))
        bucket.put(f"b/{number:02}.json", "[{]", minutes(number))
    for number in range(7):
        bucket.put(f"c/{number:02}.json", f'[{{"c{number}": 1}}]', minutes(0))
    found = bucket.discover()
    assert list(bucket.kinds("a")) == ["c30", "c25", "c20", "c15", "c10"]
    assert list(bucket.kinds("b")) == []
    assert list(bucket.kinds("c")) == ["c6", "c5", "c4", "c3", "c2"]
    bad = [f"a/{n}.json" for n in range(11, 30) if n % 5] + [f"b/{n:02}.json" for n in range(31)]
    assert sorted(found.skipped) == bad


def test_arrays_that_end_early_are_skipped(bucket):
    whole = gzip.compress(json.dumps([{"x": n} for n in range(5000)]).encode())
    bucket.put("s/a.json.gz", '[{"a": 1}]', minutes(0))
    bucket.put_raw("s/b.json.gz", whole[: len(whole) // 50], minutes(1))
    found = bucket.discover()
    assert list(bucket.kinds("s")) == ["a"] and list(found.skipped) == ["s/b.json.gz"]
