"""Type inference, value conversion and errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloader import build_layout, discover, read_tables
from lakeloader.functions import kinds as K
from lakeloader.functions.convert import convert_cell, convert_native, convert_text
from lakeloader.plans.discover import observe
from lakeloader.plans.read import Batch, named_pieces
from workload.objects import (
    bucket_sql, delimited_lines, json_lines, listing, spread, table, write_text,
)

_ID = "CAST(o_orderkey AS STRING)"


def _texts(spark: SparkSession, folder: str, text: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr("o_orderkey", f"{text} AS text", "*")


def _converted(spark, folder, text, kind):
    found = convert_text(F.col("text"), kind)
    return _texts(spark, folder, text).select(
        "o_orderkey", found.value.alias("value"), found.failed.alias("failed")
    )


_INTEGERS = f"""CASE o_orderkey % 8 WHEN 0 THEN {_ID} WHEN 1 THEN '  ' || {_ID} || ' '
  WHEN 2 THEN '00' || {_ID} WHEN 3 THEN {_ID} || '.0' WHEN 4 THEN '+' || {_ID} WHEN 5 THEN ''
  WHEN 6 THEN '99999999999' || {_ID} || '9999999999' ELSE '-' || {_ID} END"""
_NUMBERS = f"""CASE o_orderkey % 10 WHEN 0 THEN {_ID} WHEN 1 THEN ' -' || {_ID} || '.25'
  WHEN 2 THEN '.5' WHEN 3 THEN {_ID} || '.' WHEN 4 THEN '1e6' WHEN 5 THEN '007' WHEN 6 THEN '1,000'
  WHEN 7 THEN '1e400' WHEN 8 THEN 'e5' ELSE 'NaN' END"""
_BOOLEANS = """CASE o_orderkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN ' FALSE ' WHEN 2 THEN '1'
  WHEN 3 THEN 'yes' WHEN 4 THEN '' ELSE 'True' END"""
_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
_DATES = f"""CASE o_orderkey % 12 WHEN 0 THEN {_DAY} WHEN 1 THEN {_DAY} || 'T12:30'
  WHEN 2 THEN {_DAY} || ' 12:30:15.5' WHEN 3 THEN ' ' || {_DAY} || 't12:30:15.123z'
  WHEN 4 THEN {_DAY} || 'T12:30:15.1234567+0230' WHEN 5 THEN substring({_DAY}, 1, 5) || '02-30'
  WHEN 6 THEN {_DAY} || 'T24:00' WHEN 7 THEN '09/01/2026' WHEN 8 THEN {_DAY} || 'T12:30:15.000-05'
  WHEN 9 THEN {_DAY} || 'T12:30.123' WHEN 10 THEN '' ELSE {_DAY} || 'T12:30:15-00:00' END"""
_CELLS = f"""CASE o_orderkey % 7 WHEN 0 THEN concat('i', {_ID}) WHEN 1 THEN concat('f', {_ID}, '.5')
  WHEN 2 THEN concat('f', {_ID}, '.0') WHEN 3 THEN 'btrue' WHEN 4 THEN concat('s', {_ID})
  WHEN 5 THEN 'fnan' ELSE 's' END"""


def integers(spark: SparkSession, folder: str) -> DataFrame:
    return _converted(spark, folder, _INTEGERS, K.INTEGER)


def numbers(spark: SparkSession, folder: str) -> DataFrame:
    return _converted(spark, folder, _NUMBERS, K.NUMBER)


def booleans(spark: SparkSession, folder: str) -> DataFrame:
    return _converted(spark, folder, _BOOLEANS, K.BOOLEAN)


def date_times(spark: SparkSession, folder: str) -> DataFrame:
    return _converted(spark, folder, _DATES, K.DATE_TIME)


def cells(spark: SparkSession, folder: str) -> DataFrame:
    """Tagged cells, as the JSON lanes give them, in columns of every kind."""
    rows = _texts(spark, folder, _CELLS)
    outputs = []
    for kind in (K.INTEGER, K.NUMBER, K.BOOLEAN, K.STRING):
        found = convert_cell(F.col("text"), kind)
        outputs += [found.value.alias(f"as_{kind}"), found.failed.alias(f"bad_{kind}")]
    return rows.select("o_orderkey", *outputs)


def native(spark: SparkSession, folder: str) -> DataFrame:
    """Typed Parquet values in columns of other kinds."""
    rows = table(spark, folder, "orders")
    pairs = {
        "price_text": ("o_totalprice", K.STRING), "price_whole": ("o_totalprice", K.INTEGER),
        "key_text": ("o_orderkey", K.STRING), "key_flag": ("o_orderkey", K.BOOLEAN),
        "day": ("o_orderdate", K.DATE), "moment": ("o_orderdate", K.STRING),
        "status_number": ("o_orderstatus", K.NUMBER),
    }
    outputs = []
    for name, (column, kind) in pairs.items():
        found = convert_native(F.col(column), rows.schema[column].dataType, kind)
        outputs += [found.value.alias(name), found.failed.alias(f"{name}_bad")]
    return rows.select("o_orderkey", *outputs)


def _typed_csv(spark: SparkSession, folder: str):
    rows = spread(table(spark, folder, "orders").withColumn("n", F.expr(_NUMBERS)), "o_orderkey")
    where = write_text(delimited_lines(rows, ["o_orderkey", "n", "o_orderstatus"]))
    found = discover(listing(spark, where, "orders", ".csv"))
    catalog = (
        found.catalog.with_kind("orders", "o_orderkey", K.INTEGER)
        .with_kind("orders", "n", K.NUMBER)
        .with_kind("orders", "added", K.DATE_TIME)
        .deselect_columns("orders", "o_orderstatus")
    )
    return read_tables(found.layout.manifest, catalog)


def errors(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose value doesn't fit an older, typed catalog, and why."""
    return _typed_csv(spark, folder).errors("orders").withColumnRenamed("_s3_key", "key")


def drop_and_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Columns a catalog lacks are dropped; columns the objects lack are null."""
    return _typed_csv(spark, folder).good_rows("orders").drop("_s3_last_modified")


def infer_events(spark: SparkSession, folder: str) -> DataFrame:
    """The columns and kinds discovery finds for the events, in order."""
    rows = spread(table(spark, folder, "events"), "event_id")
    record = F.expr(
        """concat('{"event_id": ', event_id, ', "ts": "', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        '", "type": "', event_type, '", "value": ', if(event_id % 2 = 0, cast(value AS string), '3'),
        ', "props": ', props, ', "none": null, "late": {"flag": true}, "gone": null, "big": 99999999999999999999}')"""
    )
    found = discover(listing(spark, write_text(json_lines(rows, record)), "events", ".jsonl"))
    return found.catalog.to_frame(spark).select("stream", "column", "ordinal", "kind")


_MIXED = """concat('{"id": ', o_orderkey, ', "v": ', CASE {bucket} % 5
    WHEN 0 THEN cast(o_orderkey AS string)
    WHEN 1 THEN if(o_orderkey % 2 = 0, cast(o_orderkey AS string), '1.5')
    WHEN 2 THEN concat('"', cast(o_orderdate AS date), '"')
    WHEN 3 THEN if(o_orderkey % 2 = 0, '"42"', '42')
    ELSE if(o_orderkey % 2 = 0, 'null', '""') END, '}')"""


def infer_objects(spark: SparkSession, folder: str) -> DataFrame:
    """The merged kind of a column in every object, over all of its rows."""
    rows = spread(table(spark, folder, "orders"), "o_orderkey")
    where = write_text(json_lines(rows, F.expr(_MIXED.replace("{bucket}", "bucket"))))
    manifest = build_layout(listing(spark, where, "orders", ".jsonl")).manifest
    batch = Batch.collect(manifest)
    batch.read_heads()
    seen = observe(named_pieces(batch, None)).where((F.col("column") == "v") & ~F.col("container"))
    kinds = seen.groupBy("obj").agg(K.merged_kind(F.collect_set("kind")).alias("kind"))
    keys = batch.places().select(F.col("__obj").alias("obj"), F.col("__key").alias("key"))
    return kinds.join(F.broadcast(keys), "obj").select("key", "kind")


QUERIES = {
    "convert_integer": integers,
    "convert_number": numbers,
    "convert_boolean": booleans,
    "convert_datetime": date_times,
    "convert_cells": cells,
    "convert_native": native,
    "convert_errors": errors,
    "convert_drop_fill": drop_and_fill,
    "infer_kinds_events": infer_events,
    "infer_kinds_objects": infer_objects,
}

_OBJECT = f"'orders/' || {bucket_sql('o_orderkey')} || '"
_ROW = f"row_number() OVER (PARTITION BY {bucket_sql('o_orderkey')} ORDER BY o_orderkey)"
_BAD_NUMBER = "o_orderkey % 10 IN (3, 5, 6, 8, 9)"
_NUMBER_VALUE = """CASE o_orderkey % 10 WHEN 0 THEN o_orderkey WHEN 1 THEN -(o_orderkey + 0.25)
  WHEN 2 THEN 0.5 WHEN 4 THEN 1000000 END::DOUBLE"""
ORACLES = {
    "convert_integer": """SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN o_orderkey WHEN 1 THEN o_orderkey
        WHEN 4 THEN o_orderkey WHEN 7 THEN -o_orderkey END AS value,
        o_orderkey % 8 IN (2, 3, 6) AS failed FROM orders""",
    "convert_number": f"SELECT o_orderkey, {_NUMBER_VALUE} AS value, {_BAD_NUMBER} AS failed FROM orders",
    "convert_boolean": """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN true WHEN 1 THEN false
        WHEN 5 THEN true END AS value, o_orderkey % 6 IN (2, 3) AS failed FROM orders""",
    "convert_datetime": f"""SELECT o_orderkey, {_DAY} || CASE o_orderkey % 12 WHEN 0 THEN 'T00:00:00+00:00'
        WHEN 1 THEN 'T12:30:00+00:00' WHEN 3 THEN 'T12:30:15.123000+00:00'
        WHEN 4 THEN 'T12:30:15.123456+02:30' WHEN 8 THEN 'T12:30:15-05:00'
        WHEN 11 THEN 'T12:30:15+00:00' END AS value,
        o_orderkey % 12 IN (2, 5, 6, 7, 9) AS failed FROM orders""",
    "convert_cells": """SELECT o_orderkey,
        CASE WHEN o_orderkey % 7 IN (0, 2, 4) THEN o_orderkey END AS as_integer,
        o_orderkey % 7 IN (1, 3) AS bad_integer,
        CASE WHEN o_orderkey % 7 IN (0, 2, 4) THEN o_orderkey WHEN o_orderkey % 7 = 1 THEN o_orderkey + 0.5 END::DOUBLE AS as_number,
        o_orderkey % 7 = 3 AS bad_number, CASE WHEN o_orderkey % 7 = 3 THEN true END AS as_boolean,
        o_orderkey % 7 IN (0, 1, 2, 4) AS bad_boolean,
        CASE o_orderkey % 7 WHEN 0 THEN '' || o_orderkey WHEN 1 THEN o_orderkey || '.5' WHEN 2 THEN o_orderkey || '.0'
          WHEN 3 THEN 'true' WHEN 4 THEN '' || o_orderkey WHEN 6 THEN '' END AS as_string,
        false AS bad_string FROM orders""",
    "convert_native": """SELECT o_orderkey, CAST(o_totalprice AS VARCHAR) AS price_text, false AS price_text_bad,
        CASE WHEN o_totalprice = floor(o_totalprice) THEN CAST(o_totalprice AS BIGINT) END AS price_whole,
        o_totalprice <> floor(o_totalprice) AS price_whole_bad, '' || o_orderkey AS key_text, false AS key_text_bad,
        CAST(NULL AS BOOLEAN) AS key_flag, true AS key_flag_bad, strftime(o_orderdate, '%Y-%m-%d') AS day,
        false AS day_bad, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') AS moment, false AS moment_bad,
        CAST(NULL AS DOUBLE) AS status_number, true AS status_number_bad FROM orders""",
    "convert_errors": f"""SELECT key, "row", 'column ''n'': value ' || text || ' is not a valid number' AS error
        FROM (SELECT o_orderkey, {_OBJECT}.csv' AS key, {_ROW} AS "row", {_NUMBERS} AS text FROM orders)
        WHERE {_BAD_NUMBER}""",
    "convert_drop_fill": f"""SELECT * EXCLUDE (bad) FROM (SELECT {_OBJECT}.csv' AS _s3_key, {_ROW} AS _row_number,
        o_orderkey, {_NUMBER_VALUE} AS n, CAST(NULL AS VARCHAR) AS added, {_BAD_NUMBER} AS bad FROM orders)
        WHERE NOT bad""",
    "infer_kinds_events": """SELECT 'events' AS stream, "column", ordinal, kind FROM (VALUES
        ('event_id', 0, 'integer'), ('ts', 1, 'date-time'), ('type', 2, 'string'), ('value', 3, 'number'),
        ('props__k', 4, 'integer'), ('none', 5, 'string'), ('late__flag', 6, 'boolean'), ('gone', 7, 'string'),
        ('big', 8, 'wide-integer')) AS columns("column", ordinal, kind)""",
    "infer_kinds_objects": f"""SELECT DISTINCT {_OBJECT}.jsonl' AS key,
        CASE {bucket_sql('o_orderkey')} % 5 WHEN 0 THEN 'integer' WHEN 1 THEN 'number'
        WHEN 2 THEN 'date-time' WHEN 3 THEN 'string' ELSE 'empty' END AS kind FROM orders""",
}
