"""Write the given tables out as objects, so that the loader has something to load.

Rows are spread over objects by ranges of a dense primary key, 2,000 keys per
object, so an object's rows, key and place depend on nothing else in the table.
Each object is written by one task, text and plain Parquet row by row.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloader import prepare
from lakeloader.session import fresh_folder
from lakeloader.sources.heads import open_file
from lakeloader.sources.listing import list_objects

ROWS_PER_OBJECT = 2000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def bucket_sql(key: str) -> str:
    return f"CAST(floor({key} / {ROWS_PER_OBJECT}) AS BIGINT)"


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Add `bucket`, the object of a row, and `pos`, its place in it."""
    return rows.withColumn("bucket", F.floor(F.col(key) / ROWS_PER_OBJECT)).withColumn("pos", F.col(key).cast("bigint"))


def cell(value: Column) -> Column:
    """A quoted cell; null is an empty one."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))


def delimited_lines(rows: DataFrame, columns: list[str], sep: str = ",", quote: bool = True) -> DataFrame:
    """`bucket, pos, line`, with a header line at the start of each object."""
    cells = [cell(F.col(c)) if quote else F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    body = rows.select("bucket", "pos", F.concat_ws(sep, *cells).alias("line"))
    head = rows.select("bucket").distinct().select(
        "bucket", F.lit(-1).cast("bigint").alias("pos"), F.lit(sep.join(columns)).alias("line")
    )
    return body.unionByName(head)


def json_lines(rows: DataFrame, record: Column) -> DataFrame:
    return rows.select("bucket", "pos", record.alias("line"))


def json_array(rows: DataFrame, record: Column, before: str = "[", after: str = "]") -> DataFrame:
    """`bucket, pos, line`, so that the lines of each object are one JSON document."""
    first = rows.groupBy("bucket").agg(F.min("pos").alias("first"))
    comma = F.when(F.col("pos") == F.col("first"), "").otherwise(",")
    # One row per object.
    body = rows.join(F.broadcast(first), "bucket").select("bucket", "pos", F.concat(comma, record).alias("line"))
    ends = first.select(
        "bucket",
        F.inline(
            F.array(
                F.struct(F.lit(-1).cast("bigint").alias("pos"), F.lit(before).alias("line")),
                F.struct(F.lit((1 << 62)).alias("pos"), F.lit(after).alias("line")),
            )
        ),
    )
    return body.unionByName(ends)


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket").sortWithinPartitions("bucket", "pos")


def write_text(lines: DataFrame, gzip: bool = False) -> str:
    """Write `bucket, pos, line` as one file per bucket; give the folder."""
    folder = fresh_folder(lines.sparkSession, "objects")
    ordered = _ordered(lines).select("bucket", F.col("line").alias("value"))
    ordered.write.partitionBy("bucket").text(folder, compression="gzip" if gzip else "none")
    return folder


def write_parquet(rows: DataFrame) -> str:
    """Write rows as one Parquet file per bucket; give the folder."""
    folder = fresh_folder(rows.sparkSession, "objects")
    _ordered(rows).drop("pos").write.partitionBy("bucket").parquet(folder)
    return folder


def write_arrow(rows: DataFrame, shaped: Callable[[pa.Table], pa.Table], gzip: bool = False) -> str:
    """Write rows as one Parquet file per bucket with types Spark can't write, in several row groups; give the folder.

    `shaped` makes a file's table of a bucket's rows, of which there are few.
    """
    folder = fresh_folder(rows.sparkSession, "objects")

    def write(part: pa.Table) -> pa.Table:
        bucket = part["bucket"][0].as_py()
        made = shaped(part.sort_by("pos").drop_columns(["bucket", "pos"]))
        system, place = open_file(f"{folder}/bucket={bucket}/part.parquet")
        system.create_dir(place.rpartition("/")[0], recursive=True)
        with system.open_output_stream(place, compression="gzip" if gzip else None) as target:
            pq.write_table(made, target, row_group_size=ROWS_PER_OBJECT // 4)
        return pa.table({"bucket": [bucket]})

    made = rows.groupBy("bucket").applyInArrow(write, "bucket long")
    made.write.format("noop").mode("overwrite").save()
    return folder


def listing(spark: SparkSession, folder: str, stream: str, extension: str) -> DataFrame:
    """The objects below a folder, keyed `<stream>/<bucket><extension>`, a minute apart."""
    bucket = F.regexp_extract("path", r"bucket=(-?\d+)", 1)
    return list_objects(spark, folder).withColumns(
        {
            "key": F.concat(F.lit(f"{stream}/"), bucket, F.lit(extension)),
            "last_modified": F.timestamp_seconds(F.lit(1788264000) + bucket.cast("bigint") * 60),
        }
    )
