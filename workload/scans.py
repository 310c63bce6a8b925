"""Every source format: the given tables written as objects, discovered and read back."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloader import build_layout, discover, read_tables
from lakeloader.functions.jsontext import quoted
from workload.objects import (
    bucket_sql, delimited_lines, json_array, json_lines, listing, spread, table,
    write_arrow, write_parquet, write_text,
)


def load(objects: DataFrame, stream: str) -> DataFrame:
    """Discover the objects of a listing and read one stream."""
    found = discover(objects)
    return read_tables(found.layout.manifest, found.catalog).rows(stream)


def _delimited(spark, folder, name, key, columns, sep=",", extension=".csv", gzip=False, quote=True):
    rows = spread(table(spark, folder, name), key)
    where = write_text(delimited_lines(rows, columns, sep, quote), gzip)
    read = load(listing(spark, where, name, extension), name)
    return read.select("_s3_key", "_row_number", *columns)


def _expected(name, key, columns, extension, values=None):
    """Expected rows of a table spread over objects by a dense key."""
    values = values or [f"CAST({column} AS VARCHAR) AS {column}" for column in columns]
    return f"""SELECT '{name}/' || {bucket_sql(key)} || '{extension}' AS _s3_key,
        row_number() OVER (PARTITION BY {bucket_sql(key)} ORDER BY {key}) AS _row_number,
        {', '.join(values)} FROM {name}"""


_CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_SUPPLIER = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
_PART = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def csv(spark: SparkSession, folder: str) -> DataFrame:
    return _delimited(spark, folder, "customer", "c_custkey", _CUSTOMER)


def csv_plain(spark: SparkSession, folder: str) -> DataFrame:
    return _delimited(spark, folder, "orders", "o_orderkey", _ORDERS, quote=False)


def tsv(spark: SparkSession, folder: str) -> DataFrame:
    return _delimited(spark, folder, "supplier", "s_suppkey", _SUPPLIER, "\t", ".tsv", quote=False)


def pipes(spark: SparkSession, folder: str) -> DataFrame:
    return _delimited(spark, folder, "part", "p_partkey", _PART, "|", ".txt", quote=False)


def csv_gz(spark: SparkSession, folder: str) -> DataFrame:
    return _delimited(spark, folder, "part", "p_partkey", _PART, ";", ".csv.gz", gzip=True)


def csv_multiline(spark: SparkSession, folder: str) -> DataFrame:
    return _delimited(spark, folder, "documents", "doc_id", ["doc_id", "text", "lang", "source"])


def csv_encodings(spark: SparkSession, folder: str) -> DataFrame:
    """German documents in an 8-bit encoding, the others in UTF-8, in one stream."""
    rows = spread(table(spark, folder, "documents"), "doc_id")
    columns = ["doc_id", "text", "lang"]
    german = rows.where(F.col("lang") == "de").select(*columns)
    other = write_text(delimited_lines(rows.where(F.col("lang") != "de"), columns))
    eight_bit = f"{other}-de"
    german.write.option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').option(
        "quoteAll", True
    ).csv(eight_bit)
    listed = listing(spark, other, "documents", ".csv").unionByName(
        listing(spark, eight_bit, "documents", ".csv").withColumns(
            {
                "key": F.concat(F.lit("documents/de/"), F.substring_index("path", "/", -1)),
                "last_modified": F.timestamp_seconds(F.lit(1788000000)),
            }
        )
    )
    return load(listed, "documents").select(*columns)


def csv_ragged(spark: SparkSession, folder: str) -> DataFrame:
    """Missing cells, extra cells, blank and repeated headers, blank lines."""
    rows = spread(table(spark, folder, "customer"), "c_custkey")
    full = F.concat_ws(",", "c_custkey", "c_name", F.lit(""), "c_mktsegment")
    line = (
        F.when(F.col("c_custkey") % 3 == 0, F.concat_ws(",", "c_custkey", "c_name"))
        .when(F.col("c_custkey") % 3 == 1, F.concat_ws(",", full, "c_nationkey", F.lit("x")))
        .otherwise(F.concat(full, F.lit("\n")))
    )
    lines = delimited_lines(rows, ["c_custkey"], quote=False)
    lines = lines.where(F.col("pos") < 0).withColumn("line", F.lit("id,name, ,name")).unionByName(
        rows.select("bucket", "pos", line.alias("line"))
    )
    read = load(listing(spark, write_text(lines), "ragged", ".csv"), "ragged")
    return read.select("_row_number", "id", "name", "column_3", "name_2", "column_5", "column_6")


_EVENT = """concat('{"event_id": ', event_id, ', "ts": "', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
  '", "user": {"id": ', user_id, ', "type": "', event_type, '"}, "value": ', value, ', "props": ', props, '}')"""
_EVENT_COLUMNS = ["event_id", "ts", "user__id", "user__type", "value", "props__k"]
_EVENT_VALUES = [
    "event_id",
    """strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN extract('microsecond' FROM ts) % 1000000 = 0
       THEN '' ELSE strftime(ts, '.%f') END || '+00:00' AS ts""",
    "user_id AS user__id",
    "event_type AS user__type",
    "value",
    "CAST(json_extract(props, '$.k') AS BIGINT) AS props__k",
]


def jsonl(spark: SparkSession, folder: str) -> DataFrame:
    rows = spread(table(spark, folder, "events"), "event_id")
    # A blank line now and then.
    line = F.concat(F.expr(_EVENT), F.when(F.col("event_id") % 50 == 7, "\n").otherwise(""))
    where = write_text(json_lines(rows, line))
    read = load(listing(spark, where, "events", ".jsonl"), "events")
    return read.select("_s3_key", "_row_number", *_EVENT_COLUMNS)


def ndjson_gz(spark: SparkSession, folder: str) -> DataFrame:
    rows = spread(table(spark, folder, "events"), "event_id")
    where = write_text(json_lines(rows, F.expr(_EVENT)), gzip=True)
    read = load(listing(spark, where, "events", ".ndjson.gz"), "events")
    return read.select("_s3_key", "_row_number", *_EVENT_COLUMNS)


def _document_record():
    return F.concat(
        F.lit('{"doc_id": '), F.col("doc_id"), F.lit(', "text": '), quoted(F.col("text")),
        F.lit(', "source": {"lang": '), quoted(F.col("lang")), F.lit(', "braces": "}{][\\""}}'),
    )


_DOCUMENT_COLUMNS = ["doc_id", "text", "source__lang", "source__braces"]
_DOCUMENT_VALUES = ["doc_id", "text", "lang AS source__lang", """'}{]["' AS source__braces"""]


def json_document(spark: SparkSession, folder: str) -> DataFrame:
    rows = spread(table(spark, folder, "documents"), "doc_id")
    where = write_text(json_array(rows, _document_record()))
    read = load(listing(spark, where, "documents", ".json"), "documents")
    return read.select("_s3_key", "_row_number", *_DOCUMENT_COLUMNS)


def json_wrapper(spark: SparkSession, folder: str) -> DataFrame:
    rows = spread(table(spark, folder, "documents"), "doc_id")
    before = '{"meta": {"page": {"size": 2}}, "ids": [1, [2, {}]], "notes": [{"n": 1}, "}"], "data": ['
    where = write_text(json_array(rows, _document_record(), before, '], "none": []}'))
    read = load(listing(spark, where, "documents", ".json"), "documents")
    return read.select("_s3_key", "_row_number", *_DOCUMENT_COLUMNS)


def json_wrapper_gz(spark: SparkSession, folder: str) -> DataFrame:
    rows = spread(table(spark, folder, "orders"), "o_orderkey")
    record = F.to_json(F.struct(*[c for c in _ORDERS]))
    where = write_text(json_array(rows, record, '{"data": [', "]}"), gzip=True)
    read = load(listing(spark, where, "orders", ".json.gz"), "orders")
    return read.select("_s3_key", "_row_number", *_ORDERS)


_PARQUET_VALUES = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
    "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') AS o_orderdate",
    "strftime(o_orderdate, '%Y-%m-%d') AS day", "o_orderkey % 2 = 0 AS even",
    "CAST(o_totalprice AS DECIMAL(12, 2))::DOUBLE AS price",
]


def parquet(spark: SparkSession, folder: str) -> DataFrame:
    rows = spread(table(spark, folder, "orders"), "o_orderkey").withColumns(
        {
            "day": F.col("o_orderdate").cast("date"),
            "even": F.col("o_orderkey") % 2 == 0,
            "price": F.col("o_totalprice").cast("decimal(12,2)"),
        }
    )
    read = load(listing(spark, write_parquet(rows), "orders", ".parquet"), "orders")
    return read.select("_s3_key", "_row_number", *_ORDERS, "o_orderdate", "day", "even", "price")


def _odd_types(rows: pa.Table) -> pa.Table:
    """Nanoseconds, milliseconds of a day and durations, also within an object."""
    at = pa.compute.add(pa.compute.multiply(rows["micros"].cast(pa.int64()), 1000), rows["nanos"]).cast(pa.timestamp("ns"))
    clock = rows["clock"].cast(pa.int32()).cast(pa.time32("ms"))
    span = rows["clock"].cast(pa.int64()).cast(pa.duration("ms"))
    meta = pa.StructArray.from_arrays([at.combine_chunks(), rows["o_custkey"].combine_chunks()], ["at", "custkey"])
    return pa.table({"o_orderkey": rows["o_orderkey"], "at": at, "clock": clock, "span": span, "meta": meta})


def parquet_nanos(spark: SparkSession, folder: str) -> DataFrame:
    """Types Spark can't read, read by row groups."""
    rows = spread(table(spark, folder, "orders"), "o_orderkey")
    # A date-time is cut to microseconds.
    micros = F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 7
    rows = rows.select(
        "bucket", "pos", "o_orderkey", "o_custkey", micros.alias("micros"), (F.col("o_orderkey") % 1000).alias("nanos"),
        (F.col("o_orderkey") % 36_000 * 1000).alias("clock"),
    )
    objects = listing(spark, write_arrow(rows, _odd_types), "orders", ".parquet")
    return load(objects, "orders").select("_s3_key", "_row_number", "o_orderkey", "at", "clock", "span", "meta__at", "meta__custkey")


def parquet_gz(spark: SparkSession, folder: str) -> DataFrame:
    """Parquet files gzipped as a whole."""
    rows = spread(table(spark, folder, "orders"), "o_orderkey").select("bucket", "pos", *_ORDERS, "o_orderdate")
    objects = listing(spark, write_arrow(rows, lambda part: part, gzip=True), "orders", ".parquet.gz")
    return load(objects, "orders").select("_s3_key", "_row_number", *_ORDERS, "o_orderdate")


def csv_marked(spark: SparkSession, folder: str) -> DataFrame:
    """Files that begin with a byte order mark."""
    rows = spread(table(spark, folder, "supplier"), "s_suppkey")
    lines = delimited_lines(rows, _SUPPLIER)
    marked = F.when(F.col("pos") == -1, F.concat(F.lit("\ufeff"), F.col("line"))).otherwise(F.col("line"))
    read = load(listing(spark, write_text(lines.withColumn("line", marked)), "supplier", ".csv"), "supplier")
    return read.select("_s3_key", "_row_number", *_SUPPLIER)


def mixed_formats(spark: SparkSession, folder: str) -> DataFrame:
    """One stream of CSV, JSON lines and Parquet objects with differing types."""
    rows = spread(table(spark, folder, "customer"), "c_custkey")
    columns = ["c_custkey", "c_name", "c_acctbal"]
    text = rows.where(F.col("c_custkey") % 3 == 0)
    lines = rows.where(F.col("c_custkey") % 3 == 1)
    typed = rows.where(F.col("c_custkey") % 3 == 2)
    record = F.to_json(F.struct("c_custkey", "c_name", "c_acctbal", "c_nationkey"))
    listed = (
        listing(spark, write_text(delimited_lines(text, columns)), "customer", ".csv")
        .unionByName(listing(spark, write_text(json_lines(lines, record)), "customer", ".jsonl"))
        .unionByName(
            listing(spark, write_parquet(typed.select("bucket", "pos", *columns)), "customer", ".parquet")
        )
    )
    return load(listed, "customer").select(*columns, "c_nationkey")


_NANOS = """strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') ||
        CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE '.00000' || (o_orderkey % 7) END || '+00:00'"""
_HOUR = "o_orderkey % 36000 // 3600"
_MINUTES = "lpad(CAST(o_orderkey % 3600 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0')"
_ODD_VALUES = [
    "o_orderkey", f"{_NANOS} AS at", f"'0' || {_HOUR} || ':' || {_MINUTES} AS clock", f"{_HOUR} || ':' || {_MINUTES} AS span",
    f"{_NANOS} AS meta__at", "o_custkey AS meta__custkey",
]

QUERIES = {
    "scan_csv": csv,
    "scan_csv_plain": csv_plain,
    "scan_tsv": tsv,
    "scan_pipes": pipes,
    "scan_csv_gz": csv_gz,
    "scan_csv_multiline": csv_multiline,
    "scan_csv_encodings": csv_encodings,
    "scan_csv_ragged": csv_ragged,
    "scan_jsonl": jsonl,
    "scan_ndjson_gz": ndjson_gz,
    "scan_json_array": json_document,
    "scan_json_wrapper": json_wrapper,
    "scan_json_wrapper_gz": json_wrapper_gz,
    "scan_parquet": parquet,
    "scan_parquet_nanos": parquet_nanos,
    "scan_parquet_gz": parquet_gz,
    "scan_csv_marked": csv_marked,
    "scan_mixed_formats": mixed_formats,
}

ORACLES = {
    "scan_csv": _expected("customer", "c_custkey", _CUSTOMER, ".csv"),
    "scan_csv_plain": _expected("orders", "o_orderkey", _ORDERS, ".csv"),
    "scan_tsv": _expected("supplier", "s_suppkey", _SUPPLIER, ".tsv"),
    "scan_pipes": _expected("part", "p_partkey", _PART, ".txt"),
    "scan_csv_gz": _expected("part", "p_partkey", _PART, ".csv.gz"),
    "scan_csv_multiline": _expected("documents", "doc_id", ["doc_id", "text", "lang", "source"], ".csv"),
    "scan_csv_encodings": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents",
    "scan_csv_ragged": f"""SELECT
        row_number() OVER (PARTITION BY {bucket_sql('c_custkey')} ORDER BY c_custkey) AS _row_number,
        CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(NULL AS VARCHAR) AS column_3,
        CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS name_2,
        CASE WHEN c_custkey % 3 = 1 THEN CAST(c_nationkey AS VARCHAR) END AS column_5,
        CASE WHEN c_custkey % 3 = 1 THEN 'x' END AS column_6 FROM customer""",
    "scan_jsonl": _expected("events", "event_id", _EVENT_COLUMNS, ".jsonl", _EVENT_VALUES),
    "scan_ndjson_gz": _expected("events", "event_id", _EVENT_COLUMNS, ".ndjson.gz", _EVENT_VALUES),
    "scan_json_array": _expected("documents", "doc_id", _DOCUMENT_COLUMNS, ".json", _DOCUMENT_VALUES),
    "scan_json_wrapper": _expected("documents", "doc_id", _DOCUMENT_COLUMNS, ".json", _DOCUMENT_VALUES),
    "scan_json_wrapper_gz": _expected("orders", "o_orderkey", _ORDERS, ".json.gz", _ORDERS),
    "scan_parquet": _expected("orders", "o_orderkey", _ORDERS, ".parquet", _PARQUET_VALUES),
    "scan_parquet_nanos": _expected("orders", "o_orderkey", [], ".parquet", _ODD_VALUES),
    "scan_parquet_gz": _expected("orders", "o_orderkey", _ORDERS, ".parquet.gz", _PARQUET_VALUES[:6]),
    "scan_csv_marked": _expected("supplier", "s_suppkey", _SUPPLIER, ".csv"),
    "scan_mixed_formats": """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
        CAST(c_acctbal AS VARCHAR) AS c_acctbal,
        CASE WHEN c_custkey % 3 = 1 THEN c_nationkey END AS c_nationkey FROM customer""",
}
__all__ = ["ORACLES", "QUERIES", "load"]
