"""Sharding by extendible hashing: a directory over prefixes of hash bits.

All rows start in one bucket. A bucket over the byte limit splits on its next hash
bit, only those do, until every shard fits. The sums behind the splits are taken once
per prefix of a cell depth a little finer than the shards; cells that are still too
large go on with more bits in another round.

Equal keys can't be told apart by their bits: past the last of them the bits of a
row's own place go on. Defined results: null text has no bytes; a null key counts
as empty text; a single row over the limit is a shard of its own; an empty table
gives no rows. `shard_documents` puts each row, repeated ones and null ids included,
into one shard once: a row's columns go along with its bits, never by a join of ids.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloader.llm.base import column, unused
from lakeloader.session import written

SHARD_BYTES = 16 << 20
KEY_BITS = 60
#: Bits that cells are finer than shards of the mean size.
FINER = 4
#: Bytes of text a writing task gets on average. It holds whole shards.
TASK_BYTES = 128 << 20
#: Bits a further round adds.
ROUND_BITS = 8


def hash_bits(key: Column) -> Column:
    """The first 60 bits of a key's MD5 as text of 0 and 1."""
    return F.lpad(F.conv(F.substring(F.md5(key.cast("binary")), 1, KEY_BITS // 4), 16, 2), KEY_BITS, "0")


def assign(docs: DataFrame, max_bytes: int = SHARD_BYTES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: `doc_id, bytes, shard` (its bits), `depth, shard_bytes, shard_docs`."""
    placed, _ = _placed(docs, max_bytes, id_column, text_column)
    return placed.select("doc_id", "bytes", "shard", F.length("shard").alias("depth"), "shard_bytes", "shard_docs")


def _tasks(docs: DataFrame, total: int) -> int:
    """The number of writing tasks: it grows with the bytes, whatever the session's number of partitions."""
    return max(-(-total // TASK_BYTES), 4 * docs.sparkSession.sparkContext.defaultParallelism)


def _placed(docs: DataFrame, max_bytes: int, id_column: str, text_column: str, *carried: Column) -> tuple[DataFrame, int]:
    """Rows with their shards, and the bytes of all their texts; carried columns are written beside the bits."""
    rows = docs.select(
        *carried,
        column(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(column(text_column).cast("string")), F.lit(0)).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    bits = F.concat(hash_bits(key), hash_bits(F.concat(F.lit("row "), F.col("row").cast("string"))))
    rows = written(rows.withColumn("bits", bits), "hash-bits")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    depth = min(max(math.ceil(math.log2(max(total, 1) / max_bytes)), 0) + FINER, 2 * KEY_BITS)
    known, pending, above = [], rows.select("bits", "bytes"), 0
    while True:
        cells = written(_cells(pending, above, depth, max_bytes, last=depth == 2 * KEY_BITS), "cells")
        known.append(cells.where("shard IS NOT NULL").select(F.lit(depth).alias("cell_depth"), "cell", "shard", "shard_bytes", "shard_docs"))
        open_cells = cells.where("shard IS NULL").select("cell")
        if not open_cells.head(1):
            break
        pending = written(
            pending.withColumn("cell", F.substring("bits", 1, depth)).join(open_cells, "cell", "left_semi").drop("cell"), "open-buckets"
        )
        above, depth = depth, min(depth + ROUND_BITS, 2 * KEY_BITS)
    shards = known[0]
    for more in known[1:]:
        shards = shards.unionAll(more)
    depths = [x.cell_depth for x in shards.select("cell_depth").distinct().collect()]
    # A cell lies in one round's table only, so each row meets one shard.
    cells_of = F.explode(F.array(*[F.substring("bits", 1, x) for x in depths])) if depths else F.lit("")
    return rows.withColumn("cell", cells_of).join(shards.drop("cell_depth"), "cell"), total


def _cells(rows: DataFrame, above: int, depth: int, max_bytes: int, last: bool) -> DataFrame:
    """For each cell of `depth` bits the first prefix, longer than `above`, that fits; null if none does."""
    cells = rows.groupBy(F.substring("bits", 1, depth).alias("cell")).agg(
        F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("docs")
    )
    depths = F.explode(F.sequence(F.lit(above + 1 if above else 0), F.lit(depth))).alias("depth")
    prefixes = cells.select("cell", "bytes", "docs", depths).withColumn("shard", F.expr("substring(cell, 1, depth)"))
    sums = prefixes.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
    fits = (F.col("shard_bytes") <= max_bytes) | (F.col("shard_docs") == 1) | F.lit(last) & (F.length("shard") == depth)
    best = F.min(F.when(fits, F.struct(F.length("shard").alias("depth"), "shard", "shard_bytes", "shard_docs"))).alias("best")
    joined = prefixes.select("cell", "shard").join(sums, "shard").groupBy("cell").agg(best)
    return joined.select("cell", "best.shard", "best.shard_bytes", "best.shard_docs")


def directory(assigned: DataFrame) -> DataFrame:
    """One row per shard; the longest `depth` is the number of bits the directory is indexed by."""
    return assigned.groupBy("shard", "depth").agg(
        F.first("shard_bytes").alias("shard_bytes"), F.first("shard_docs").alias("shard_docs")
    )


def shard_documents(
    docs: DataFrame, folder: str, max_bytes: int = SHARD_BYTES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Write every shard's documents, each row once, to a folder of its own, and read them back.

    All columns as they are, and the shard's folder as the last one, `shard`.
    """
    (shard,) = unused(docs, "shard")
    document = F.struct(*[column(old).alias(f"c{i}") for i, old in enumerate(docs.columns)]).alias("document")
    placed, total = _placed(docs, max_bytes, id_column, text_column, document)
    made = placed.select(
        *[F.col(f"document.c{i}").alias(old) for i, old in enumerate(docs.columns)], F.concat(F.lit("s"), F.col("shard")).alias(shard)
    )
    made.repartition(_tasks(docs, total), column(shard)).write.option("compression", "zstd").partitionBy(shard).parquet(folder)
    return docs.sparkSession.read.schema(made.schema).parquet(folder)


def read_assignment(sharded: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `assign`, from written shards."""
    rows = sharded.select(
        column(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(column(text_column).cast("string")), F.lit(0)).cast("long").alias("bytes"),
        F.substring(column(sharded.columns[-1]), 2, 2 * KEY_BITS).alias("shard"),
    )
    sums = rows.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_docs"))
    return rows.join(sums, "shard").select("doc_id", "bytes", "shard", F.length("shard").alias("depth"), "shard_bytes", "shard_docs")


def write_shards(docs: DataFrame, assigned: DataFrame, folder: str, id_column: str = "doc_id") -> None:
    """Write every shard's documents by an assignment of their ids; repeated ids are an error (see `shard_documents`)."""
    ids = assigned.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    most, total = ids.agg(F.max("n"), F.sum("bytes")).first()
    if most and most > 1:
        raise ValueError("an assignment by id can't tell rows that share an id apart; use shard_documents")
    key, shard = unused(docs, "key", "shard")
    shards = assigned.select(F.col("doc_id").alias(key), F.concat(F.lit("s"), F.col("shard")).alias(shard))
    joined = docs.join(shards, column(id_column).cast("long").eqNullSafe(F.col(key))).drop(key)
    joined.repartition(_tasks(docs, total or 0), shard).write.partitionBy(shard).parquet(folder)


def oracle(max_bytes: int = SHARD_BYTES, documents: str = "documents") -> str:
    """The same as SQL for DuckDB, for unique ids."""
    return f"""
WITH d AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes,
    lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT), {KEY_BITS}, '0') AS bits FROM {documents}),
p AS (SELECT doc_id, bytes, depth, substr(bits, 1, depth) AS shard FROM d, (SELECT unnest(range(0, {KEY_BITS + 1})) AS depth)),
s AS (SELECT depth, shard, sum(bytes) AS shard_bytes, count(*) AS shard_docs FROM p GROUP BY ALL
  HAVING sum(bytes) <= {max_bytes} OR count(*) = 1)
SELECT doc_id, bytes, shard, depth::INTEGER AS depth, shard_bytes::BIGINT AS shard_bytes, shard_docs
FROM p JOIN s USING (depth, shard) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
"""
