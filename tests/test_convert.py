"""Conversion of text, cells and typed values."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloader.functions import kinds as K
from lakeloader.functions.convert import convert_cell, convert_native, convert_text, is_number_text, typed_view
from lakeloader.functions.datetimes import iso_datetime, parse_bookmark
from lakeloader.functions.jsontext import dump, float_text, json_text

BAD = object()


def run(spark, values, expression, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"n int, v {kind}")
    found = rows.select("n", expression(F.col("v")).alias("out")).collect()
    return [row.out for row in sorted(found, key=lambda row: row.n)]


def converted(spark, values, kind, convert):
    rows = spark.createDataFrame(list(enumerate(values)), "n int, v string")
    result = convert(F.col("v"), kind)
    found = rows.select("n", result.value.alias("value"), result.failed.alias("failed")).collect()
    return [BAD if row.failed else row.value for row in sorted(found, key=lambda row: row.n)]


TEXTS = {
    K.INTEGER: {"42": 42, " +7 ": 7, "-0": 0, "": None, "007": BAD, "1.5": BAD, "1.0": BAD, "x": BAD, "true": BAD, "9" * 19: BAD},
    K.WIDE_INTEGER: {"9" * 30: decimal.Decimal("9" * 30), "x": BAD},
    K.NUMBER: {".5": 0.5, "1e6": 1e6, "+7": 7.0, " -1.25 ": -1.25, "1.": BAD, "007": BAD, "1,000": BAD, "e5": BAD,
               "NaN": BAD, "inf": BAD, "1e400": None, "-1e400": None, "": None, "0.1": 0.1},
    K.BOOLEAN: {"true": True, " FALSE ": False, "1": BAD, "yes": BAD, "": None},
    K.DATE_TIME: {"2026-09-01": "2026-09-01T00:00:00+00:00", "2026-09-01T12:30:00Z": "2026-09-01T12:30:00+00:00",
                  "2026-09-01 12:30:00+02:00": "2026-09-01T12:30:00+02:00", "2026-09-01T12:30:00.5": BAD, "x": BAD, "": None},
    K.DATE: {"anything": "anything", "": None},
    K.STRING: {"": "", "x": "x"},
}


@pytest.mark.parametrize("kind", sorted(TEXTS))
def test_text(spark, kind):
    cases = TEXTS[kind]
    assert converted(spark, list(cases), kind, convert_text) == list(cases.values())


CELLS = {
    K.INTEGER: {"i5": 5, "f5.0": 5, "f5.5": BAD, "btrue": BAD, "s42": 42, "s": None, "fnan": None, "f1e+20": BAD, "f-0.0": 0},
    K.NUMBER: {"i5": 5.0, "f5.5": 5.5, "btrue": BAD, "s42": 42.0, "finf": None, "sx": BAD, "i" + "9" * 400: None},
    K.BOOLEAN: {"btrue": True, "bfalse": False, "i1": BAD, "sTrue": True, "f1.0": BAD},
    K.DATE_TIME: {"s2026-09-01": "2026-09-01T00:00:00+00:00", "i5": BAD, "btrue": BAD, "fnan": None},
    K.STRING: {"i5": "5", "f1e+16": "1e+16", "btrue": "true", "s": "", "sx": "x", "fnan": None},
    K.OBJECT: {"s{}": BAD, "i1": BAD, "s": None},
}


@pytest.mark.parametrize("kind", sorted(CELLS))
def test_cells(spark, kind):
    cases = CELLS[kind]
    assert converted(spark, [*cases, None], kind, convert_cell) == [*cases.values(), None]


def test_untyped_columns_pass_values_on(spark):
    rows = spark.createDataFrame([("i5",), ("sx",), ("btrue",)], "v string")
    found = rows.select(F.to_json(convert_cell(F.col("v"), K.ANY).value).alias("out")).collect()
    assert [row.out for row in found] == ["5", '"x"', "true"]


def test_native_values(spark):
    row = {
        "i": 7, "d": 2.0, "h": 2.5, "f": 1e16, "m": decimal.Decimal("9.90"), "b": True, "s": "42",
        "t": datetime.datetime(2026, 9, 1, 12), "y": datetime.date(2026, 9, 1), "x": b"\x00\x01",
        "nan": float("nan"), "l": ["a", None], "st": {"k": 1},
    }
    schema = (
        "i int, d double, h double, f double, m decimal(10,2), b boolean, s string, t timestamp, y date, "
        "x binary, nan double, l array<string>, st struct<k:int>"
    )
    rows = spark.createDataFrame([row], schema)
    cases = [
        ("i", K.NUMBER, 7.0), ("i", K.STRING, "7"), ("i", K.BOOLEAN, BAD), ("d", K.INTEGER, 2), ("h", K.INTEGER, BAD),
        ("f", K.STRING, "1e+16"), ("d", K.STRING, "2.0"), ("m", K.NUMBER, 9.9), ("m", K.STRING, "9.9"), ("m", K.INTEGER, BAD),
        ("b", K.STRING, "true"), ("b", K.NUMBER, BAD), ("s", K.INTEGER, 42), ("t", K.DATE_TIME, "2026-09-01T12:00:00+00:00"),
        ("t", K.DATE, "2026-09-01"), ("t", K.STRING, "2026-09-01T12:00:00+00:00"), ("t", K.INTEGER, BAD),
        ("y", K.DATE_TIME, "2026-09-01T00:00:00+00:00"), ("y", K.DATE, "2026-09-01"), ("x", K.STRING, "AAE="),
        ("nan", K.NUMBER, None), ("nan", K.STRING, None), ("l", K.STRING, '["a", null]'), ("st", K.STRING, '{"k": 1}'),
        ("l", K.INTEGER, BAD), ("i", K.DATE_TIME, BAD), ("y", K.STRING, "2026-09-01"),
    ]
    outputs = []
    for n, (column, kind, _) in enumerate(cases):
        result = convert_native(F.col(column), rows.schema[column].dataType, kind)
        outputs += [result.value.alias(f"v{n}"), result.failed.alias(f"f{n}")]
    found = rows.select(*outputs).first()
    for n, (column, kind, expected) in enumerate(cases):
        got = BAD if found[f"f{n}"] else found[f"v{n}"]
        assert got is expected or got == expected, (column, kind, got)


def test_number_text(spark):
    yes, no = ["0", "-1.5", "2e3", ".5", "1E-2"], ["", "abc", "007", "NaN", "inf", "1.", "e5", "-", "."]
    assert run(spark, yes + no, is_number_text) == [True] * len(yes) + [False] * len(no)


def test_iso_forms(spark):
    cases = {
        "2026-09-01T12:30": "2026-09-01T12:30:00+00:00", "2026-09-01T12:30:15.123": "2026-09-01T12:30:15.123000+00:00",
        "2026-09-01T12:30:15.000Z": "2026-09-01T12:30:15+00:00", "2026-09-01T12:30:15.123456+00:00": "2026-09-01T12:30:15.123456+00:00",
        "2026-09-01T12:30:15.1234567": "2026-09-01T12:30:15.123456+00:00", "2026-09-01t12:30z": "2026-09-01T12:30:00+00:00",
        "2026-09-01T12:30:00+0530": "2026-09-01T12:30:00+05:30", "2026-09-01T12:30:00-05": "2026-09-01T12:30:00-05:00",
        "2026-09-01T12:30:00-00:00": "2026-09-01T12:30:00+00:00", "\t2026-09-01\n": "2026-09-01T00:00:00+00:00",
        "2024-02-29": "2024-02-29T00:00:00+00:00", "2026-02-29": None, "2026-02-30T12:30:00Z": None, "2026-13-01": None,
        "0000-01-01": None, "2026-09-01T24:00": None, "2026-09-01T12:60": None, "2026-09-01T12:30.123": None,
        "2026-09-01T12:30:15.12": None, "2026-09-01T12": None, "2026-9-1": None, "20260901": None, "Sep 1 2026": None,
    }
    assert run(spark, cases, iso_datetime) == list(cases.values())


def test_bookmarks(spark):
    found = run(spark, ["2026-09-01T12:00:00Z", "2026-09-01T12:00:00", " 2026-09-01T14:00:00+02:00"], parse_bookmark)
    assert [str(value) for value in found] == ["2026-09-01 12:00:00"] * 3


def test_json_text():
    value = {"a": [1, 2.5, None, True], "d": decimal.Decimal("1.5"), "t": datetime.time(9, 30), "n": float("inf"), "b": b"\0",
             "m": [("k", 1)], "e": [], "é": datetime.datetime(2026, 9, 1)}
    assert dump(value) == (
        '{"a": [1, 2.5, null, true], "d": 1.5, "t": "09:30:00", "n": null, "b": "AA==", "m": {"k": 1}, "e": [], '
        '"é": "2026-09-01T00:00:00+00:00"}'
    )


def test_json_text_columns(spark):
    texts = ["a", 'q"\\', "\n\t\x01\x1f", "é ", None]
    rows = spark.createDataFrame([(texts, [[1], None], [True])], "t array<string>, n array<array<int>>, b array<boolean>")
    row = rows.select(*[json_text(F.col(c), rows.schema[c].dataType).alias(c) for c in rows.columns]).first()
    assert (row.t, row.n, row.b) == (dump(texts), "[[1], null]", "[true]")


def test_float_text(spark):
    values = [0.1, 1e16, 1.0, -3.0, 1e-5, 123456789.125, 5e-324, 1.7976931348623157e308, 0.0, 2.0**60]
    assert run(spark, values, float_text, "double") == [repr(value) for value in values]


def test_typed_views(spark):
    rows = spark.createDataFrame([("2026-09-01T12:00:00+02:00", "2026-09-01")], "t string, d string")
    row = rows.select(typed_view(F.col("t"), K.DATE_TIME).alias("t"), typed_view(F.col("d"), K.DATE).alias("d"))
    assert isinstance(row.schema["t"].dataType, T.TimestampType) and isinstance(row.schema["d"].dataType, T.DateType)
    assert row.select(F.date_format("t", "HH:mm")).first()[0] == "10:00"
