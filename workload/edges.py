"""Edges of discovery, selection and state: unparsable objects, byte order marks, columns and streams without data."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloader import Catalog, Column, Settings, Sink, Stream, discover, sync
from lakeloader.functions import kinds as K
from lakeloader.functions.convert import convert_cell, convert_native
from lakeloader.functions.datetimes import parse_bookmark
from lakeloader.session import fresh_folder, local_frame
from workload.nested import _CHILD, _child_sql, _jsonl
from workload.objects import (
    ROWS_PER_OBJECT, bucket_sql, delimited_lines, json_array, json_lines, listing, spread, table, write_text,
)
from workload.scans import _EVENT, _EVENT_COLUMNS, _EVENT_VALUES, _expected, load

_LISTED = datetime.datetime(2026, 9, 2, 12, tzinfo=datetime.timezone.utc)

# Objects of the sampled stream: the newest and most others break off in their second record.
_PER_SAMPLED = 1250
_SAMPLED = f"CAST(floor(o_orderkey / {_PER_SAMPLED}) AS BIGINT)"
_BROKEN = "(({top} - {bucket}) % 4 < 3 AND {bucket} > 0)"


def newest_unparsable(spark: SparkSession, folder: str) -> DataFrame:
    """Arrays of which the newest can't be read: the columns come from the newest that can, and their first 1,000 rows."""
    rows = table(spark, folder, "orders").withColumns(
        {"bucket": F.expr(_SAMPLED), "pos": F.col("o_orderkey").cast("bigint")}
    )
    # One row.
    rows = rows.join(F.broadcast(rows.agg(F.max("bucket").alias("top"))), how="left")
    place = f"o_orderkey % {_PER_SAMPLED}"
    record = F.expr(
        f"""CASE WHEN {_BROKEN.format(top='top', bucket='bucket')} AND {place} = 1 THEN '{{"id": '
        ELSE concat('{{"id": ', o_orderkey, ', "of_', bucket, '": "}}', o_orderstatus, '"',
          CASE WHEN {place} >= 1000 THEN ', "late": 1' ELSE '' END, '}}') END"""
    )
    found = discover(listing(spark, write_text(json_array(rows, record)), "orders", ".json"))
    shown = [("column", column.name, column.kind) for column in found.catalog.streams["orders"].columns]
    shown += [("skipped", key, None) for key in found.skipped]
    return local_frame(spark, shown, "part string, name string, kind string")


def with_mark(spark: SparkSession, folder: str) -> DataFrame:
    """Delimited text after a byte order mark: the first column's name is without it."""
    rows = spread(table(spark, folder, "orders"), "o_orderkey")
    lines = delimited_lines(rows, ["o_orderkey", "o_orderstatus"])
    marked = F.concat(F.when(F.col("pos") == -1, "﻿").otherwise(""), F.col("line"))
    where = write_text(lines.withColumn("line", marked))
    read = load(listing(spark, where, "orders", ".csv"), "orders")
    return read.select("_s3_key", "_row_number", "o_orderkey", "o_orderstatus")


def marked_lines(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines after a byte order mark."""
    rows = spread(table(spark, folder, "events"), "event_id")
    mark = F.when(F.col("event_id") % ROWS_PER_OBJECT == 0, "﻿").otherwise("")
    where = write_text(json_lines(rows, F.concat(mark, F.expr(_EVENT))))
    read = load(listing(spark, where, "events", ".jsonl"), "events")
    return read.select("_s3_key", "_row_number", *_EVENT_COLUMNS)


def placeholders(spark: SparkSession, folder: str) -> DataFrame:
    """What is null in some rows and an object or a list in others has no column of its own."""
    rows = spread(table(spark, folder, "events"), "event_id")
    record = F.expr(
        """concat('{"id": ', event_id, ', "place": ', if(event_id % 2 = 0, 'null', '{"x": 1, "inner": {"y": "a"}}'),
        ', "items": ', CASE event_id % 3 WHEN 0 THEN 'null' WHEN 1 THEN '[]' ELSE '[{"v": 0.5}]' END,
        ', "mixed": ', if(event_id % 2 = 0, '7', '{"z": true}'), ', "never": null}')"""
    )
    found = discover(listing(spark, write_text(json_lines(rows, record)), "events", ".jsonl"))
    columns = found.catalog.to_frame(spark).select("stream", "column", "kind")
    return columns.where(~F.col("column").startswith("_parent__"))


def containers(spark: SparkSession, folder: str) -> DataFrame:
    """Plain values in columns of the kinds object and array: an error for each that is not null."""
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.expr("nullif(o_orderkey % 3, 0)").alias("n"), F.expr("if(o_orderkey % 2 = 0, '{}', null)").alias("t"),
        F.expr("CASE o_orderkey % 3 WHEN 0 THEN 'i1' WHEN 1 THEN 's[]' END").alias("c"),
    )
    outputs = []
    for kind in (K.OBJECT, K.ARRAY):
        for column, made in (
            ("n", convert_native(F.col("n"), rows.schema["n"].dataType, kind)),
            ("t", convert_native(F.col("t"), rows.schema["t"].dataType, kind)),
            ("c", convert_cell(F.col("c"), kind)),
        ):
            outputs += [made.value.isNull().alias(f"{column}_{kind}_null"), made.failed.alias(f"{column}_{kind}_bad")]
    return rows.select("o_orderkey", *outputs)


_MOMENTS = """concat(date_format(o_orderdate, 'yyyy-MM-dd'), CASE o_orderkey % 5 WHEN 0 THEN 'T01:02:03Z' WHEN 1 THEN 'T01:02:03z'
    WHEN 2 THEN 'T01:02:03' WHEN 3 THEN 'T01:02:03.25+05:30' ELSE '' END)"""


def moments(spark: SparkSession, folder: str) -> DataFrame:
    """Bookmarks and start dates as text: no zone means UTC."""
    moment = parse_bookmark(F.expr(_MOMENTS))
    return table(spark, folder, "orders").select("o_orderkey", F.unix_millis(moment).alias("millis"))


_LOOKBACKS = [None, -5, 100_000]


def window_starts(spark: SparkSession, folder: str) -> DataFrame:
    """The bookmark after a whole sync: the start of the window before the listing, past or before its newest object."""
    rows = spread(table(spark, folder, "orders"), "o_orderkey").select("bucket", "pos", F.expr("concat('{\"id\": ', o_orderkey, '}')").alias("line"))
    objects = listing(spark, write_text(rows), "orders", ".jsonl")
    catalog = discover(objects).catalog
    listed = objects.agg(F.max("last_modified").alias("at")).first().at + datetime.timedelta(minutes=30)
    made = []
    for lookback in _LOOKBACKS:
        sink = fresh_folder(spark, "sink")
        sync(objects, catalog, sink, Settings(lookback_minutes=lookback), listed.replace(tzinfo=datetime.timezone.utc))
        marks, _ = Sink(spark, sink).load_state()
        made.append(marks.select(F.lit(lookback).cast("long").alias("lookback"), F.unix_seconds("bookmark").alias("bookmark")))
    whole = made[0]
    for more in made[1:]:
        whole = whole.unionByName(more)
    return whole


def root_left_out(spark: SparkSession, folder: str) -> DataFrame:
    """Child rows of a file stream that the catalog doesn't have."""
    objects = _jsonl(spark, folder)
    streams = discover(objects).catalog.streams
    catalog = Catalog({name: stream for name, stream in streams.items() if name != "orders"})
    result = sync(objects, catalog, fresh_folder(spark, "sink"), Settings(), _LISTED)
    return result.rows("orders__lines").select(*_CHILD)


def late_child(spark: SparkSession, folder: str) -> DataFrame:
    """A list of objects that appears after discovery is left out; the record's other columns are read."""
    rows = spread(table(spark, folder, "events"), "event_id")

    def objects(late: str) -> DataFrame:
        record = F.expr(f"""concat('{{"id": ', event_id, {late} ', "type": "', event_type, '"}}')""")
        return listing(spark, write_text(json_lines(rows, record)), "events", ".jsonl")

    catalog = discover(objects("")).catalog
    found = objects("""if(event_id % 2 = 0, ', "parts": [{"v": 1}, {"v": 2}]', ''),""")
    result = sync(found, catalog, fresh_folder(spark, "sink"), Settings(), _LISTED)
    return result.rows("events").drop("_s3_last_modified").withColumn("streams", F.lit(",".join(sorted(result.catalog.streams))))


def no_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A child stream no object has rows for still has its table; its parent has all rows."""
    rows = spread(table(spark, folder, "events"), "event_id")
    record = F.expr("""concat('{"id": ', event_id, ', "parts": []}')""")
    objects = listing(spark, write_text(json_lines(rows, record)), "events", ".jsonl")
    columns = (Column("v", K.NUMBER), Column("at", K.DATE_TIME), Column("_parent__id", K.INTEGER))
    catalog = Catalog({**discover(objects).catalog.streams, "events__parts": Stream("events__parts", columns, "events", ("parts",))})
    result = sync(objects, catalog, fresh_folder(spark, "sink"), Settings(), _LISTED)
    made = []
    for name in ("events", "events__parts"):
        read = result.rows(name)
        shape = ",".join(f"{field.name}:{field.dataType.simpleString()}" for field in read.schema)
        made.append(read.groupBy().agg(F.count("*").alias("rows")).select(F.lit(name).alias("stream"), F.lit(shape).alias("shape"), "rows"))
    return made[0].unionByName(made[1])


QUERIES = {
    "discover_newest_unparsable": newest_unparsable,
    "scan_csv_mark": with_mark,
    "scan_jsonl_mark": marked_lines,
    "infer_placeholders": placeholders,
    "convert_containers": containers,
    "convert_moments": moments,
    "sync_window_start": window_starts,
    "select_root_left_out": root_left_out,
    "sync_late_child": late_child,
    "sync_stream_without_rows": no_rows,
}

_BUCKETS = f"(SELECT DISTINCT {_SAMPLED} AS bucket, (SELECT max({_SAMPLED}) FROM orders) AS top FROM orders)"
_TRIED = f"""(SELECT bucket, {_BROKEN.format(top='top', bucket='bucket')} AS broken,
    count(*) FILTER (NOT {_BROKEN.format(top='top', bucket='bucket')}) OVER (ORDER BY bucket DESC) AS good FROM {_BUCKETS})"""
# The fifth good object ends the search; broken ones older than it are not looked at.
_FIRST_GOOD = f"SELECT max(bucket) FROM {_TRIED} WHERE good = 5"


def _containers() -> str:
    given = {"n": "o_orderkey % 3 <> 0", "t": "o_orderkey % 2 = 0", "c": "o_orderkey % 3 <> 2"}
    shown = [
        f"true AS {column}_{kind}_null, {where} AS {column}_{kind}_bad"
        for kind in ("object", "array")
        for column, where in given.items()
    ]
    return f"SELECT o_orderkey, {', '.join(shown)} FROM orders"


_NEWEST = f"(SELECT 1788264000 + 60 * max({bucket_sql('o_orderkey')}) AS newest FROM orders)"
ORACLES = {
    "discover_newest_unparsable": f"""SELECT 'column' AS part, 'id' AS name, 'integer' AS kind
        UNION ALL SELECT 'column', 'of_' || bucket, 'string' FROM {_TRIED} WHERE NOT broken AND good <= 5
        UNION ALL SELECT 'skipped', 'orders/' || bucket || '.json', NULL FROM {_TRIED}
          WHERE broken AND bucket > coalesce(({_FIRST_GOOD} AND NOT broken), -1)""",
    "scan_csv_mark": _expected("orders", "o_orderkey", ["o_orderkey", "o_orderstatus"], ".csv"),
    "scan_jsonl_mark": _expected("events", "event_id", _EVENT_COLUMNS, ".jsonl", _EVENT_VALUES),
    "infer_placeholders": """SELECT * FROM (VALUES ('events', 'id', 'integer'), ('events', 'place__x', 'integer'),
        ('events', 'place__inner__y', 'string'), ('events', 'mixed', 'integer'), ('events', 'mixed__z', 'boolean'),
        ('events', 'never', 'string'), ('events__items', 'v', 'number')) AS columns(stream, "column", kind)
        WHERE EXISTS (SELECT * FROM events)""",
    "convert_containers": _containers(),
    "convert_moments": """SELECT o_orderkey, CAST(epoch_ms(CAST(o_orderdate AS DATE)::TIMESTAMP) AS BIGINT) + CASE o_orderkey % 5
        WHEN 3 THEN 3723250 - 19800000 WHEN 4 THEN 0 ELSE 3723000 END AS millis FROM orders""",
    "sync_window_start": f"""SELECT CAST(lookback AS BIGINT) AS lookback,
        CAST(newest + 1800 - 60 * greatest(coalesce(lookback, 60), 0) AS BIGINT) AS bookmark
        FROM {_NEWEST}, (VALUES (NULL), (-5), (100000)) AS lookbacks(lookback)""",
    "select_root_left_out": f"SELECT {', '.join(_CHILD)} FROM ({_child_sql('.jsonl')})",
    "sync_late_child": f"""SELECT *, 'events' AS streams FROM ({_expected('events', 'event_id', [], '.jsonl',
        ['event_id AS id', 'event_type AS type'])})""",
    "sync_stream_without_rows": """SELECT 'events' AS stream, count(*) AS "rows",
        'id:bigint,_s3_key:string,_s3_last_modified:string,_row_number:bigint' AS shape FROM events
        UNION ALL SELECT 'events__parts', 0, 'v:double,at:string,_parent__id:bigint,_s3_key:string,_s3_last_modified:string,'
          || '_parent_row:string,_index:bigint,_row_key:string'""",
}
