"""A large object among small ones, cut into several splits, and line ends that change.

At small scale factors even the large object is small, so these queries lower the
size of splits while they read; what they read is written before the sizes go back.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workload.objects import delimited_lines, json_array, json_lines, listing, table, write_text
from lakeloader.session import written
from workload.scans import (
    _DOCUMENT_COLUMNS, _DOCUMENT_VALUES, _EVENT, _EVENT_COLUMNS, _EVENT_VALUES, _document_record, load,
)

_SIZES = {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "4k"}


@contextlib.contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in _SIZES}
    for name, size in _SIZES.items():
        spark.conf.set(name, size)
    try:
        yield
    finally:
        for name, size in before.items():
            spark.conf.set(name, size)


#: Keys of one large object and eight small ones.
_GROUP = 100_000


def _bucket(key: str) -> str:
    """Of each range of keys the even ones share one object, the odd ones are dealt to eight."""
    group = f"9 * CAST(floor({key} / {_GROUP}) AS BIGINT)"
    return f"{group} + CASE WHEN {key} % 2 = 0 THEN 0 ELSE 1 + CAST(floor({key} / 2) AS BIGINT) % 8 END"


def _uneven(rows: DataFrame, key: str) -> DataFrame:
    return rows.withColumn("bucket", F.expr(_bucket(key)).cast("bigint")).withColumn("pos", F.col(key).cast("bigint"))


def _read(spark: SparkSession, lines: DataFrame, stream: str, extension: str, columns: list[str]) -> DataFrame:
    objects = listing(spark, write_text(lines), stream, extension)
    with small_splits(spark):
        return written(load(objects, stream).select("_s3_key", "_row_number", *columns), "read")


def _expected(name: str, key: str, extension: str, values: list[str]) -> str:
    return f"""SELECT '{name}/' || {_bucket(key)} || '{extension}' AS _s3_key,
        row_number() OVER (PARTITION BY {_bucket(key)} ORDER BY {key}) AS _row_number, {', '.join(values)} FROM {name}"""


_TEXT = ["doc_id", "text", "lang", "source"]


def csv_splits(spark: SparkSession, folder: str) -> DataFrame:
    """Quoted cells with line breaks."""
    rows = _uneven(table(spark, folder, "documents"), "doc_id")
    return _read(spark, delimited_lines(rows, _TEXT), "documents", ".csv", _TEXT)


def jsonl_splits(spark: SparkSession, folder: str) -> DataFrame:
    rows = _uneven(table(spark, folder, "events"), "event_id")
    return _read(spark, json_lines(rows, F.expr(_EVENT)), "events", ".jsonl", _EVENT_COLUMNS)


def json_array_splits(spark: SparkSession, folder: str) -> DataFrame:
    rows = _uneven(table(spark, folder, "documents"), "doc_id")
    return _read(spark, json_array(rows, _document_record()), "documents", ".json", _DOCUMENT_COLUMNS)


def json_wrapper_splits(spark: SparkSession, folder: str) -> DataFrame:
    rows = _uneven(table(spark, folder, "documents"), "doc_id")
    before = '{"meta": {"page": {"size": 2}}, "ids": [1, [2, {}]], "data": ['
    lines = json_array(rows, _document_record(), before, '], "none": []}')
    return _read(spark, lines, "documents", ".json", _DOCUMENT_COLUMNS)


_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus"]


def csv_line_ends(spark: SparkSession, folder: str) -> DataFrame:
    """Objects whose first half ends its lines with carriage returns, with both, or with line feeds, and then changes.

    An object's rows are one line of what is written, up to where its line ends change.
    """
    rows = table(spark, folder, "orders").withColumn("bucket", F.expr("CAST(floor(o_orderkey / 500) AS BIGINT)"))
    rows = rows.withColumn("late", F.col("o_orderkey") % 500 >= 480)
    # The kind of line end of an early and of a late row of each object.
    kind = F.when(F.col("late"), F.floor(F.col("bucket") / 3) % 3).otherwise(F.col("bucket") % 3)
    end = F.element_at(F.array(F.lit("\r"), F.lit("\r\n"), F.lit("\n")), (kind + 1).cast("int"))
    header = F.when(F.col("o_orderkey") % 500 == 0, F.concat(F.lit(",".join(_ORDERS)), end)).otherwise("")
    # 500 short rows of an object; the last one ends with the line feed of the writer.
    text = F.concat(header, F.concat_ws(",", *_ORDERS), end)
    bodies = rows.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", text.alias("text")))).alias("rows"))
    lines = bodies.select(
        "bucket", F.lit(0).cast("bigint").alias("pos"),
        F.array_join(F.transform("rows", lambda row: row["text"]), "").alias("line"),
    )
    return _read(spark, lines, "orders", ".csv", _ORDERS)


QUERIES = {
    "scan_csv_splits": csv_splits,
    "scan_jsonl_splits": jsonl_splits,
    "scan_json_array_splits": json_array_splits,
    "scan_json_wrapper_splits": json_wrapper_splits,
    "scan_csv_line_ends": csv_line_ends,
}
ORACLES = {
    "scan_csv_splits": _expected("documents", "doc_id", ".csv", [f"CAST({x} AS VARCHAR) AS {x}" for x in _TEXT]),
    "scan_jsonl_splits": _expected("events", "event_id", ".jsonl", _EVENT_VALUES),
    "scan_json_array_splits": _expected("documents", "doc_id", ".json", _DOCUMENT_VALUES),
    "scan_json_wrapper_splits": _expected("documents", "doc_id", ".json", _DOCUMENT_VALUES),
    "scan_csv_line_ends": f"""SELECT 'orders/' || CAST(floor(o_orderkey / 500) AS BIGINT) || '.csv' AS _s3_key,
        row_number() OVER (PARTITION BY floor(o_orderkey / 500) ORDER BY o_orderkey) AS _row_number,
        {', '.join(f'CAST({x} AS VARCHAR) AS {x}' for x in _ORDERS)} FROM orders""",
}
