"""Streams as DataFrames and views, and streaming listings."""

import pytest
from cases import minutes
from pyspark.sql import functions as F

from lakeloader import Settings, Sink, read_tables
from lakeloader.streaming.follow import follow


def test_views_and_errors(bucket, spark):
    bucket.put("orders.jsonl", '{"id": 1, "l": [{"v": 1}, {"v": 2}]}\n{"id": 2}\n')
    found = bucket.discover()
    read_tables(found.layout.manifest, found.catalog).register()
    joined = spark.sql("SELECT o.id, count(l.v) AS n FROM orders o LEFT JOIN orders__l l ON l._parent__id = o.id GROUP BY 1")
    assert sorted(tuple(row) for row in joined.collect()) == [(1, 2), (2, 0)]
    bucket.put("orders.jsonl", '{"id": 1}\nbroken\n{"id": "x"}\n')
    found = bucket.discover().layout
    catalog = bucket.catalog if "orders" in bucket.catalog.streams else None
    tables = read_tables(found.manifest, catalog.with_kind("orders", "id", "integer"))
    assert [(row.row, row.error.split(":")[0]) for row in tables.errors("orders").orderBy("row").collect()] == [
        (2, "JSONDecodeError"), (3, "column 'id'"),
    ]
    assert [row.id for row in tables.good_rows("orders").collect()] == [1]
    with pytest.raises(Exception, match="orders.jsonl row"):
        tables.rows("orders").collect()


def test_limits_take_the_first_rows_in_read_order(bucket):
    for number in range(3):
        bucket.put(f"a/{2 - number}.csv", f"id\n{number}0\n{number}1\n", minutes(number))
    found = bucket.discover()
    rows = read_tables(found.layout.manifest, found.catalog, {"a": 3}).rows("a")
    assert sorted(row.id for row in rows.collect()) == ["00", "01", "10"]


def test_streaming_listings(bucket, spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    bucket.put("orders/a.csv", "id\n1\n", minutes(1))
    bucket.discover()
    catalog = bucket.catalog

    def arrive():
        bucket.listing().write.mode("append").parquet(inbox)
        arriving = spark.readStream.schema(bucket.listing().schema).parquet(inbox)
        done = []
        query = follow(
            arriving, catalog, bucket.sink_folder, str(tmp_path / "checkpoint"), Settings(),
            clock=lambda: bucket.now, done=lambda _, result: done.append(result.objects_read),
        )
        query.awaitTermination()
        return sum(done)

    bucket.now = minutes(30)
    assert arrive() == 1
    assert arrive() == 0
    bucket.put("orders/a.csv", "id\n1\n5\n", minutes(2))
    bucket.put("orders/b.csv", "id\n2\n", minutes(1))
    assert arrive() == 2
    rows = Sink(spark, bucket.sink_folder).read(catalog.streams["orders"])
    assert sorted(row.id for row in rows.select(F.col("id")).collect()) == ["1", "1", "2", "5"]
    assert bucket.window("orders") == ["orders/a.csv", "orders/b.csv"]
