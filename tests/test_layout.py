"""Listing and layout."""

import datetime

import pytest
from pyspark.sql import functions as F

from lakeloader import build_layout
from lakeloader.sources import layout as L
from lakeloader.sources.listing import list_objects, normalize_prefix


def texts(spark, values, expression):
    rows = spark.createDataFrame(list(enumerate(values)), "n int, text string")
    found = rows.select("n", expression(F.col("text")).alias("value")).collect()
    return [row.value for row in sorted(found)]


def test_trailing_tokens(spark):
    cases = {
        "accounts": "accounts", "accounts_2026-09-01": "accounts", "accounts-20260901T1200": "accounts",
        "accounts-20260901": "accounts", "accounts_2026-09-01T12:30:00Z": "accounts",
        "accounts_2026-09-01_12-30-00": "accounts", "accounts 2026-09-01 123000": "accounts",
        "accounts_2026-09-01T12:30:00.123+02:00": "accounts", "accounts_2026_09_01": "accounts",
        "accounts.2026-09-01": "accounts", "accounts_1727500000": "accounts", "accounts_001": "accounts",
        "accounts_2026-09-01_2": "accounts", "accounts (1)": "accounts", "accounts_part_3": "accounts_part",
        "sales_q3": "sales_q3", "report2026": "report2026", "2026-09-01": "2026-09-01",
        "20260901": "20260901", "v2_accounts": "v2_accounts", "a" + " 1" * 60: "a", "é_1": "é",
    }
    assert texts(spark, cases, L.strip_trailing_tokens) == list(cases.values())


def test_sanitized_names(spark):
    cases = {
        "accounts": "accounts", "Accounts": "Accounts", "my accounts": "my_accounts",
        "my-accounts.v2": "my_accounts_v2", "Café Clients": "Caf_Clients", "--x--": "x", "a__b": "a__b", "é": "",
    }
    assert texts(spark, cases, L.sanitize_name) == list(cases.values())


def test_file_names(spark):
    cases = {
        "a.csv": ("a", "csv"), "A.CSV": ("A", "csv"), "a.b.csv.gz": ("a.b", "csv"), "a.NDJSON.GZ": ("a", "ndjson"),
        "a.snappy.parquet": ("a.snappy", "parquet"), "a.xlsx": ("", ""), "a.gz": ("", ""), ".csv": ("", ""),
        "csv": ("", ""), "a.csv.zip": ("", ""), "a.csv.gz.gz": ("", ""),
    }
    assert texts(spark, cases, L.file_stem) == [stem for stem, _ in cases.values()]
    assert texts(spark, cases, L.file_extension) == [extension for _, extension in cases.values()]


def test_hidden(spark):
    hidden = [".accounts.csv", "_SUCCESS", "accounts/_temporary/0/part.csv", "accounts/.DS_Store", "_staging/a.csv"]
    shown = ["accounts.csv", "my_accounts/data_file.csv"]
    assert texts(spark, hidden + shown, L.is_hidden) == [True] * 5 + [False] * 2


@pytest.mark.parametrize(
    "prefix, expected",
    [(None, ""), ("", ""), ("  ", ""), ("exports", "exports/"), ("exports/", "exports/"), ("/exports/crm", "exports/crm/")],
)
def test_prefix(prefix, expected):
    assert normalize_prefix(prefix) == expected


def listing(spark, *keys, size=1):
    when = datetime.datetime(2026, 9, 1)
    rows = [(key, key, when, size, "t") for key in keys]
    return spark.createDataFrame(rows, "key string, path string, last_modified timestamp, size bigint, etag string")


def test_streams_of_a_bucket(spark):
    found = build_layout(
        listing(
            spark, "x/accounts.csv", "x/accounts_2026-09-01.csv.gz", "x/accounts/2026/p.json", "x/Accounts.csv",
            "x/2026-09-01.csv", "x/é.csv", "x/readme.md", "x/.hid.csv", "x2/other.csv", "x/folder/", "x/a b.csv",
        ),
        "x",
    )
    streams = {row.key: (row.stream, row.kind, row.compressed) for row in found.manifest.collect()}
    assert streams == {
        "x/accounts.csv": ("accounts", "delimited", False),
        "x/accounts_2026-09-01.csv.gz": ("accounts", "delimited", True),
        "x/accounts/2026/p.json": ("accounts", "json", False),
        "x/Accounts.csv": ("Accounts", "delimited", False),
        "x/2026-09-01.csv": ("2026_09_01", "delimited", False),
        "x/a b.csv": ("a_b", "delimited", False),
    }
    assert sorted(tuple(row) for row in found.rejected.collect()) == [
        ("x/readme.md", "unsupported type"), ("x/é.csv", "unusable name"),
    ]
    assert found.rejected_report() == (["x/readme.md", "x/é.csv"], 0)
    assert found.merged_names().count() == 0


def test_merged_names(spark):
    found = build_layout(listing(spark, "Sales Data/a.csv", "Sales-Data/b.csv", "other/c.csv"))
    assert [tuple(row) for row in found.merged_names().collect()] == [("Sales_Data", ["Sales Data", "Sales-Data"])]


def test_exclude(spark):
    rows = listing(spark, "a/manifest.json", "a/x.json", "b.csv")
    kept = build_layout(rows, exclude="(^|/)manifest").manifest
    assert sorted(row.key for row in kept.collect()) == ["a/x.json", "b.csv"]
    assert L.excluded_count(rows, None, "(^|/)manifest") == 1
    with pytest.raises(ValueError, match="not a valid regex"):
        build_layout(rows, exclude="(")


def test_read_order_counts_over_partitions(spark):
    when = datetime.datetime(2026, 9, 1)
    rows = [
        (stream, f"k{n:04}", when + datetime.timedelta(minutes=n % 7), n + 1)
        for stream, count in (("big", 500), ("small", 3))
        for n in range(count)
    ]
    frame = spark.createDataFrame(rows, "stream string, key string, last_modified timestamp, size bigint")
    found = L.read_order(frame).collect()
    for stream in ("big", "small"):
        mine = sorted((r.last_modified, r.key, r.size, r["rank"], r.bytes_before) for r in found if r.stream == stream)
        before = 0
        for place, (_, _, size, rank, bytes_before) in enumerate(mine, 1):
            assert (rank, bytes_before) == (place, before)
            before += size
    top = L.newest(frame, 5).where("stream = 'small'").orderBy("newest_rank").collect()
    assert [row.key for row in top] == ["k0002", "k0001", "k0000"]


def test_listing_of_a_folder(spark, tmp_path):
    (tmp_path / "in" / "k=v").mkdir(parents=True)
    for name in ("a b.csv", "k=v/p%20q+r.json", "w[1]{2}.csv"):
        (tmp_path / "in" / name).write_text("x")
    rows = list_objects(spark, str(tmp_path / "in")).collect()
    assert sorted(row.key for row in rows) == ["a b.csv", "k=v/p%20q+r.json", "w[1]{2}.csv"]
    assert all(row.size == 1 and row.etag for row in rows)
    below = list_objects(spark, str(tmp_path), "in/k=v").collect()
    assert [row.key for row in below] == ["in/k=v/p%20q+r.json"]
