"""Listing, layout and naming over listings made from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloader.functions.names import decode_name_column, encode_key_column, top_level_name_column
from lakeloader.sources.layout import build_layout, newest, read_order
from workload.objects import table

# A key per order: dated files, folders, hidden and unusable objects, and some
# outside the prefix. The same text is valid in Spark and in the expected SQL.
_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
_ID = "CAST(o_orderkey AS STRING)"
_KEY = f"""CASE o_orderkey % 9
  WHEN 0 THEN 'exports/accounts_' || {_DAY} || '_' || {_ID} || '.csv'
  WHEN 1 THEN 'exports/Deal Notes/' || substring({_DAY}, 1, 7) || '/part-' || {_ID} || '.json'
  WHEN 2 THEN 'exports/.hidden/x' || {_ID} || '.csv'
  WHEN 3 THEN 'exports/contacts/_temporary/' || {_ID} || '.csv'
  WHEN 4 THEN 'exports/report-' || replace({_DAY}, '-', '') || 'T1200 (' || {_ID} || ').JSONL.GZ'
  WHEN 5 THEN 'exports/sheet' || {_ID} || '.xlsx'
  WHEN 6 THEN 'exports2/other' || {_ID} || '.csv'
  WHEN 7 THEN 'exports/é/' || {_ID} || '.csv'
  ELSE 'exports/Deal-Notes/' || {_ID} || '/' END"""
_SIZE = "o_orderkey % 7 * 10"
# The objects of `_KEY` that a stream can use, with the stream they must land in.
_USABLE = f"""SELECT o_orderkey, {_KEY} AS key, {_SIZE} AS size, o_orderdate AS last_modified,
  CASE o_orderkey % 9 WHEN 0 THEN 'accounts' WHEN 1 THEN 'Deal_Notes' ELSE 'report' END AS stream,
  CASE o_orderkey % 9 WHEN 0 THEN 'delimited' WHEN 1 THEN 'json' ELSE 'jsonl' END AS kind
  FROM orders WHERE o_orderkey % 9 IN (0, 1, 4) AND o_orderkey % 7 > 0"""


def _orders_listing(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        f"{_KEY} AS key", f"{_KEY} AS path", "CAST(o_orderdate AS TIMESTAMP) AS last_modified",
        f"{_SIZE} AS size", "md5(CAST(o_orderkey AS STRING)) AS etag",
    )


def streams(spark: SparkSession, folder: str) -> DataFrame:
    found = build_layout(_orders_listing(spark, folder), "/exports")
    return found.manifest.groupBy("stream", "kind", "compressed").agg(
        F.count("*").alias("objects"), F.sum("size").alias("bytes"), F.min("key").alias("first_key")
    )


def rejected(spark: SparkSession, folder: str) -> DataFrame:
    return build_layout(_orders_listing(spark, folder), "exports/").rejected


def exclude(spark: SparkSession, folder: str) -> DataFrame:
    found = build_layout(_orders_listing(spark, folder), "exports", r"^accounts_1996|-0[1-6]/")
    return found.manifest.select("stream", "key")


def rank(spark: SparkSession, folder: str) -> DataFrame:
    found = build_layout(_orders_listing(spark, folder), "exports")
    return read_order(found.manifest).select("stream", "key", "rank", "bytes_before")


def newest_five(spark: SparkSession, folder: str) -> DataFrame:
    found = build_layout(_orders_listing(spark, folder), "exports")
    return newest(found.manifest, 5).select("stream", "key", "newest_rank")


def strip_tokens(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        f"""CASE o_orderkey % 6
          WHEN 0 THEN 'sales q3_' || {_DAY} WHEN 1 THEN 'sales q3 ' || {_DAY} || 'T12:30:00.123+02:00'
          WHEN 2 THEN 'sales q3 (' || {_ID} || ')' WHEN 3 THEN 'sales q3.' || {_DAY} || '-2 (3)_' || {_ID}
          WHEN 4 THEN {_DAY} ELSE 'report' || {_ID} || '-12-x' END AS stem""",
    )
    listed = keys.select(
        F.concat("stem", F.lit(".csv")).alias("key"), F.col("stem").alias("path"),
        F.lit(1).alias("size"), F.lit(None).cast("timestamp").alias("last_modified"),
        F.col("o_orderkey").cast("string").alias("etag"),
    )
    return build_layout(listed).manifest.select(F.col("etag").alias("o_orderkey"), "stream")


def merged_names(spark: SparkSession, folder: str) -> DataFrame:
    both = table(spark, folder, "customer").selectExpr(
        "inline(array(struct(c_name || '/a.csv' AS key), "
        "struct(replace(c_name, '#', '-') || '/b.csv' AS key), struct('x' || c_custkey || '.csv' AS key)))"
    )
    listed = both.selectExpr(
        "key", "key AS path", "CAST(NULL AS TIMESTAMP) AS last_modified", "1 AS size", "'' AS etag"
    )
    found = build_layout(listed).merged_names()
    return found.select("stream", F.concat_ws("|", "raw_names").alias("raw_names"))


_NAME = """CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', '_')
  WHEN 2 THEN replace(p_name, ' ', '__') WHEN 3 THEN '_' || replace(p_name, ' ', '-')
  ELSE replace(p_name, ' ', '_xa_') END"""


def names(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "part").selectExpr("p_partkey", f"{_NAME} AS name")
    encoded = keys.withColumn("encoded", encode_key_column(F.col("name")))
    back = decode_name_column(F.col("encoded"))
    return encoded.select(
        "p_partkey",
        "encoded",
        top_level_name_column(F.col("name")).alias("top_level"),
        ((F.size(back) == 1) & (F.element_at(back, 1) == F.col("name"))).alias("round_trip"),
    )


QUERIES = {
    "layout_streams": streams,
    "layout_rejected": rejected,
    "layout_exclude": exclude,
    "layout_rank": rank,
    "layout_newest": newest_five,
    "layout_strip_tokens": strip_tokens,
    "layout_merged_names": merged_names,
    "name_encoding": names,
}

ORACLES = {
    "layout_streams": f"""SELECT stream, kind, stream = 'report' AS compressed, count(*) AS objects,
        sum(size) AS bytes, min(key) AS first_key FROM ({_USABLE}) GROUP BY ALL""",
    "layout_rejected": f"""SELECT {_KEY} AS key,
        CASE o_orderkey % 9 WHEN 5 THEN 'unsupported type' ELSE 'unusable name' END AS reason
        FROM orders WHERE o_orderkey % 9 IN (5, 7) AND o_orderkey % 7 > 0""",
    "layout_exclude": f"""SELECT stream, key FROM ({_USABLE})
        WHERE NOT starts_with(key, 'exports/accounts_1996') AND NOT regexp_matches(key, '-0[1-6]/')""",
    "layout_rank": f"""SELECT stream, key,
        row_number() OVER (PARTITION BY stream ORDER BY last_modified, key) AS rank,
        coalesce(sum(size) OVER (PARTITION BY stream ORDER BY last_modified, key
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bytes_before FROM ({_USABLE})""",
    "layout_newest": f"""SELECT stream, key, newest_rank FROM (SELECT stream, key,
        row_number() OVER (PARTITION BY stream ORDER BY last_modified DESC, key DESC) AS newest_rank
        FROM ({_USABLE})) WHERE newest_rank <= 5""",
    "layout_strip_tokens": f"""SELECT {_ID} AS o_orderkey, CASE o_orderkey % 6
        WHEN 4 THEN replace({_DAY}, '-', '_') WHEN 5 THEN 'report' || {_ID} || '_12_x'
        ELSE 'sales_q3' END AS stream FROM orders""",
    "layout_merged_names": """SELECT replace(c_name, '#', '_') AS stream,
        c_name || '|' || replace(c_name, '#', '-') AS raw_names FROM customer""",
    "name_encoding": f"""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN replace(p_name, ' ', '_x20_')
          WHEN 1 THEN name WHEN 2 THEN replace(p_name, ' ', '_x5f__')
          WHEN 3 THEN '_x5f_' || replace(p_name, ' ', '_x2d_')
          ELSE replace(p_name, ' ', '_x5f_xa_') END AS encoded,
        CASE p_partkey % 5 WHEN 2 THEN replace(p_name, ' ', '_x5f__')
          WHEN 4 THEN replace(p_name, ' ', '_x5f_xa_') ELSE name END AS top_level,
        true AS round_trip FROM (SELECT p_partkey, p_name, {_NAME} AS name FROM part)""",
}
