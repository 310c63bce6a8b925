"""What the operators share: reading tables, ASCII case, batches of rows in tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloader.session import fresh_folder, prepare

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows of an Arrow batch that are turned into Python objects at once.
SLICE = 256
#: What a task's table of words may hold, about `ENTRY_BYTES` for each entry itself
#: included, and the longest word it keeps.
TABLE_BYTES, ENTRY_BYTES, LONGEST_KEPT = 96 << 20, 160, 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def column(name: str) -> Column:
    """A column by its exact name, dots and back-quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(frame: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of the frame has, in either case."""
    taken = {name.lower() for name in frame.columns}
    made = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        made.append(name)
    return made


def in_tasks(frame: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """Run `work` on each partition's stream of Arrow batches."""
    prepare(frame.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return frame.mapInArrow(task, schema)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on, for tasks that hold other things."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def one_row_each(docs: DataFrame, kept: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """One row of `docs` for every kept key, all columns as they are.

    `kept` has the keys, once each, and in `rows` how many rows have it. Only keys of
    several rows are looked at by rows; which one stays depends on its values alone.
    """
    names = unused(docs, *keys, "rows", "place")
    rows, place = names[-2:]
    known = kept.select(*[F.col(key).alias(name) for key, name in zip(keys, names)], F.col("rows").alias(rows))
    same = [made.eqNullSafe(F.col(name)) for made, name in zip(keys.values(), names)]
    found = docs.join(known, reduce(Column.__and__, same))
    columns = [column(name) for name in docs.columns]
    first = Window.partitionBy(*names[: len(keys)]).orderBy(F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns))
    # Spark cuts each key to one row before it shuffles it.
    several = found.where(F.col(rows) > 1).withColumn(place, F.row_number().over(first)).where(F.col(place) == 1)
    return found.where(F.col(rows) == 1).select(*columns).unionAll(several.select(*columns))


class Steps:
    """Written steps of one run, which can be deleted after their last use."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, {}

    def write(self, frame: DataFrame, label: str) -> DataFrame:
        """Write a frame to the shared folder and read it back."""
        folder = fresh_folder(self.spark, label)
        frame.write.parquet(folder)
        self.folders[label] = folder
        return self.spark.read.schema(frame.schema).parquet(folder)

    def delete(self, *labels: str) -> None:
        for label in labels:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folders.pop(label))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded length."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def mix(value: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalizer of splitmix64)."""
    value = value.astype(np.uint64)
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))
