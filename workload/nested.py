"""Nested data taken apart, from Parquet (by schema) and from JSON (by row)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloader import Catalog, build_layout, discover, read_tables
from workload.objects import (
    bucket_sql, json_array, json_lines, listing, spread, table, write_parquet, write_text,
)
from workload.scans import load

_ORDER = """named_struct(
  'id', o_orderkey,
  'status', o_orderstatus,
  'region', named_struct('code', o_orderpriority, 'meta', named_struct('tier', o_orderkey % 5)),
  'lines', array(
    named_struct('sku', concat('A', o_orderkey), 'price', named_struct('amount', o_totalprice),
      'taxes', array(named_struct('kind', 'vat', 'rate', 0.25D), named_struct('kind', 'eco', 'rate', 0.5D))),
    null,
    named_struct('sku', concat('B', o_custkey), 'price', named_struct('amount', cast(null AS double)),
      'taxes', if(o_orderkey % 2 = 0, array(named_struct('kind', 'vat', 'rate', 1.0D)), array()))),
  'empty', if(o_orderkey % 3 = 0, null, array()),
  'tags', array(o_orderstatus, null, o_orderpriority),
  'grid', array(array(o_orderkey, 1), array()))"""


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    rows = spread(table(spark, folder, "orders"), "o_orderkey")
    return rows.select("bucket", "pos", F.expr(_ORDER).alias("rec"))


def _parquet(spark: SparkSession, folder: str) -> DataFrame:
    where = write_parquet(_orders(spark, folder).select("bucket", "pos", "rec.*"))
    return listing(spark, where, "orders", ".parquet")


def _jsonl(spark: SparkSession, folder: str) -> DataFrame:
    text = F.to_json("rec", {"ignoreNullFields": "false"})
    return listing(spark, write_text(json_lines(_orders(spark, folder), text)), "orders", ".jsonl")


def _json(spark: SparkSession, folder: str) -> DataFrame:
    text = F.to_json("rec", {"ignoreNullFields": "false"})
    where = write_text(json_array(_orders(spark, folder), text, '{"n": 1, "data": [', "]}"))
    return listing(spark, where, "orders", ".json")


_ROOT = ["_s3_key", "_row_number", "id", "status", "region__code", "region__meta__tier", "tags", "grid"]
_CHILD = ["_s3_key", "_parent_row", "_index", "_row_key", "sku", "price__amount", "_parent__id", "_parent__status"]
_GRANDCHILD = ["_parent_row", "_index", "_row_key", "kind", "rate", "_parent__sku"]


def _query(objects, stream, columns):
    return lambda spark, folder: load(objects(spark, folder), stream).select(*columns)


def flatten_struct(spark: SparkSession, folder: str) -> DataFrame:
    """Struct fields become columns, with encoded names."""
    rows = spread(table(spark, folder, "customer"), "c_custkey").selectExpr(
        "bucket", "pos", "c_custkey AS id",
        "named_struct('full name', c_name, '_seg__ment', c_mktsegment, "
        "'account', named_struct('balance', c_acctbal)) AS profile",
        "c_nationkey AS a__b",
    )
    read = load(listing(spark, write_parquet(rows), "customer", ".parquet"), "customer")
    return read.select(
        "id", "profile__full_x20_name", "profile___x5f_seg_x5f__ment", "profile__account__balance", "a_x5f__b"
    )


def list_json_text(spark: SparkSession, folder: str) -> DataFrame:
    """Lists of plain values, and a map, become JSON text."""
    rows = spread(table(spark, folder, "embeddings"), "vec_id").selectExpr(
        "bucket", "pos", "vec_id",
        "transform(embedding, x -> cast(floor(cast(x AS double) * 1000) AS int)) AS whole",
        "map('label', label) AS attrs", "array(concat('q\"', label), '\\\\') AS words",
        "slice(array(1.5D, double('nan'), null), 1, 1 + label % 3) AS reals",
    )
    read = load(listing(spark, write_parquet(rows), "embeddings", ".parquet"), "embeddings")
    return read.select("vec_id", "whole", "attrs", "words", "reals")


def row_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """One path that is a value, an object, a plain list or a mixed list, row by row."""
    rows = spread(table(spark, folder, "customer"), "c_custkey")
    shape = F.expr(
        """CASE c_custkey % 4 WHEN 0 THEN concat('"', c_mktsegment, '"')
        WHEN 1 THEN concat('{"name": "', c_name, '", "none": null}')
        WHEN 2 THEN concat('[', c_custkey, ', null, "x"]')
        ELSE concat('[{"n": ', c_nationkey, '}, "x"]') END"""
    )
    line = F.concat(F.lit('{"id": '), F.col("c_custkey"), F.lit(', "v": '), shape, F.lit("}"))
    read = load(listing(spark, write_text(json_lines(rows, line)), "shapes", ".jsonl"), "shapes")
    return read.select("id", "v", "v__name")


def depth_cap(spark: SparkSession, folder: str) -> DataFrame:
    """Past ten levels an object stays whole, as JSON text."""
    rows = spread(table(spark, folder, "customer"), "c_custkey")
    opened = "".join(f'{{"l{level}": ' for level in range(12))
    line = F.concat(F.lit(opened), F.col("c_custkey"), F.lit("}" * 12))
    read = load(listing(spark, write_text(json_lines(rows, line)), "deep", ".jsonl"), "deep")
    name = "__".join(f"l{level}" for level in range(10))
    return read.select("_row_number", F.col(name).alias("capped"))


def select_child_only(spark: SparkSession, folder: str) -> DataFrame:
    """A child stream without its file stream."""
    found = discover(_jsonl(spark, folder))
    catalog = found.catalog.select("orders__lines")
    return read_tables(found.layout.manifest, catalog).rows("orders__lines").select(*_CHILD)


def select_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Deselected columns are left out; keys stay."""
    found = discover(_parquet(spark, folder))
    catalog = found.catalog.deselect_columns("orders", "status", "tags", "region__code", "grid")
    read = read_tables(found.layout.manifest, catalog).rows("orders")
    return read.drop("_s3_last_modified")


def name_clash(spark: SparkSession, folder: str) -> DataFrame:
    """A file stream takes the natural name of a child stream."""
    taken = _orders(spark, folder).selectExpr("bucket", "pos", "rec.id")
    objects = _parquet(spark, folder).unionByName(
        listing(spark, write_parquet(taken), "orders__lines", ".parquet")
    )
    found = discover(objects)
    tables = read_tables(found.layout.manifest, found.catalog)
    counts = [
        tables.rows(name).groupBy().agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("stream"), F.lit(stream.parent).cast("string").alias("parent"), "rows"
        )
        for name, stream in found.catalog.streams.items()
    ]
    whole = counts[0]
    for more in counts[1:]:
        whole = whole.unionByName(more)
    return whole


def catalog_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Rows read by a catalog that went through its JSON form and its table form."""
    found = discover(_jsonl(spark, folder))
    catalog = Catalog.from_frame(Catalog.from_json(found.catalog.to_json()).to_frame(spark))
    return read_tables(found.layout.manifest, catalog).rows("orders__lines__taxes").select(*_GRANDCHILD)


QUERIES = {
    "flatten_struct": flatten_struct,
    "flatten_json": _query(_jsonl, "orders", _ROOT),
    "flatten_parquet": _query(_parquet, "orders", _ROOT),
    "explode_child": _query(_parquet, "orders__lines", _CHILD),
    "explode_child_jsonl": _query(_jsonl, "orders__lines", _CHILD),
    "explode_child_document": _query(_json, "orders__lines", _CHILD),
    "explode_grandchild": _query(_parquet, "orders__lines__taxes", _GRANDCHILD),
    "explode_grandchild_jsonl": _query(_jsonl, "orders__lines__taxes", _GRANDCHILD),
    "list_json_text": list_json_text,
    "row_shapes": row_shapes,
    "depth_cap": depth_cap,
    "select_child_only": select_child_only,
    "select_columns": select_columns,
    "child_name_clash": name_clash,
    "catalog_round_trip": catalog_round_trip,
}


def _numbered(extension: str) -> str:
    """Orders with their object key and row number."""
    bucket = bucket_sql("o_orderkey")
    return f"""(SELECT *, 'orders/' || {bucket} || '{extension}' AS _s3_key,
      row_number() OVER (PARTITION BY {bucket} ORDER BY o_orderkey) AS _row_number FROM orders)"""


def _root_sql(extension: str) -> str:
    return f"""SELECT _s3_key, _row_number, o_orderkey AS id, o_orderstatus AS status,
      o_orderpriority AS region__code, o_orderkey % 5 AS region__meta__tier,
      '["' || o_orderstatus || '", null, "' || o_orderpriority || '"]' AS tags,
      '[[' || o_orderkey || ', 1], []]' AS grid FROM {_numbered(extension)}"""


def _child_sql(extension: str) -> str:
    return f"""SELECT _s3_key, _s3_key || '#' || _row_number AS _parent_row, _index,
      _s3_key || '#' || _row_number || '/lines#' || _index AS _row_key,
      CASE _index WHEN 0 THEN 'A' || o_orderkey ELSE 'B' || o_custkey END AS sku,
      CASE _index WHEN 0 THEN o_totalprice END AS price__amount,
      o_orderkey AS _parent__id, o_orderstatus AS _parent__status
      FROM {_numbered(extension)}, (VALUES (0), (2)) AS items(_index)"""


def _grandchild_sql(extension: str) -> str:
    return f"""SELECT _s3_key || '#' || _row_number || '/lines#' || line AS _parent_row, _index,
      _s3_key || '#' || _row_number || '/lines#' || line || '/taxes#' || _index AS _row_key, kind, rate,
      CASE line WHEN 0 THEN 'A' || o_orderkey ELSE 'B' || o_custkey END AS _parent__sku
      FROM {_numbered(extension)},
      (VALUES (0, 0, 'vat', 0.25::DOUBLE), (0, 1, 'eco', 0.5::DOUBLE), (2, 0, 'vat', 1.0::DOUBLE))
        AS items(line, _index, kind, rate) WHERE line = 0 OR o_orderkey % 2 = 0"""


_CAPPED = '{"l10": {"l11": '
ORACLES = {
    "flatten_struct": """SELECT c_custkey AS id, c_name AS profile__full_x20_name,
        c_mktsegment AS profile___x5f_seg_x5f__ment, c_acctbal AS profile__account__balance,
        c_nationkey AS a_x5f__b FROM customer""",
    "flatten_json": _root_sql(".jsonl"),
    "flatten_parquet": _root_sql(".parquet"),
    "explode_child": _child_sql(".parquet"),
    "explode_child_jsonl": _child_sql(".jsonl"),
    "explode_child_document": _child_sql(".json"),
    "explode_grandchild": _grandchild_sql(".parquet"),
    "explode_grandchild_jsonl": _grandchild_sql(".jsonl"),
    "list_json_text": """SELECT vec_id,
        '[' || array_to_string(list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000) AS INT)), ', ') || ']' AS whole,
        '{"label": ' || label || '}' AS attrs, '["q\\"' || label || '", "\\\\"]' AS words,
        CASE label % 3 WHEN 0 THEN '[1.5]' WHEN 1 THEN '[1.5, null]' ELSE '[1.5, null, null]' END AS reals
        FROM embeddings""",
    "row_shapes": """SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN c_mktsegment
        WHEN 2 THEN '[' || c_custkey || ', null, "x"]'
        WHEN 3 THEN '[{"n": ' || c_nationkey || '}, "x"]' END AS v,
        CASE c_custkey % 4 WHEN 1 THEN c_name END AS v__name FROM customer""",
    "depth_cap": f"""SELECT row_number() OVER (PARTITION BY {bucket_sql('c_custkey')}
        ORDER BY c_custkey) AS _row_number, '{_CAPPED}' || c_custkey || '}}}}' AS capped FROM customer""",
    "select_child_only": _child_sql(".jsonl"),
    "select_columns": f"""SELECT _s3_key, _row_number, o_orderkey AS id,
        o_orderkey % 5 AS region__meta__tier, CAST(NULL AS VARCHAR) AS empty FROM {_numbered('.parquet')}""",
    "child_name_clash": """SELECT stream, parent, n * rows + m AS rows FROM (SELECT count(*) AS n,
        count(*) FILTER (o_orderkey % 2 = 0) AS even FROM orders),
        (VALUES ('orders', NULL, 1), ('orders__lines', NULL, 1), ('orders__lines_2', 'orders', 2),
          ('orders__lines_2__taxes', 'orders__lines_2', 2)) AS streams(stream, parent, rows),
        LATERAL (SELECT CASE WHEN stream LIKE '%taxes' THEN even ELSE 0 END AS m)""",
    "catalog_round_trip": _grandchild_sql(".jsonl"),
}
__all__ = ["ORACLES", "QUERIES", "build_layout"]
