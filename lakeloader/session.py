"""Session settings every job relies on, and the shared work folder."""

from __future__ import annotations

import datetime
import pathlib
import posixpath
import re
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark import Broadcast, SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SPLIT_SHARE = "spark.sql.files.minPartitionNum"
_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Tasks per core of a step whose work is spread by tasks of any size.
_TASKS_PER_CORE = 4
_SETTINGS = {
    # `A` and `a` are two columns, `Accounts` and `accounts` two streams.
    "spark.sql.caseSensitive": "true",
    # Timestamps without a zone count as UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Parquet TIME columns, and nanosecond timestamps (read as a bigint).
    "spark.sql.timeType.enabled": "true",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # Wide catalogs give large generated methods, which the JVM's compiler skips
    # past this size; Spark then takes its path with smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Long texts: a batch for a Python worker ends by bytes, too.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    # Results go back to tasks and to the driver as Arrow batches.
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators need. Safe to call many times."""
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    # Two passes over the same list of objects must cut them at the same places,
    # also when executors come or go in between. So the number Spark derives the
    # size of splits from is fixed, beside the objects' total size.
    if spark.conf.get(SPLIT_SHARE, None) is None:
        spark.conf.set(SPLIT_SHARE, str(max(spark.sparkContext.defaultParallelism, 1)))
    # Spark lists up to 10,000 paths in a task each, whose results are mostly overhead.
    if int(spark.conf.get(_LISTING_TASKS)) > spread_tasks(spark):
        spark.conf.set(_LISTING_TASKS, str(spread_tasks(spark)))
    _ship_package(spark)
    return spark


def spread_tasks(spark: SparkSession) -> int:
    """How many tasks spread a step evenly over all cores, whatever their number."""
    return _TASKS_PER_CORE * max(spark.sparkContext.defaultParallelism, 1)


class Shipped:
    """What the tasks of a lane are told about all objects and splits of a batch.

    It reaches them as a broadcast: a Python worker unpickles it once, not in every task. Each
    task has an object of its own, whose values are shared and must not be changed there.
    """

    def state(self) -> dict:
        """The attributes that tasks get."""
        return vars(self)

    def __reduce__(self):
        return _received, (type(self), SparkContext.getOrCreate().broadcast(self.state()))


def _received(kind: type, state: Broadcast):
    made = kind.__new__(kind)
    made.__dict__.update(state.value)
    return made


def _ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package, once per application."""
    context = spark.sparkContext
    if getattr(context, "_lakeloader_shipped", False):
        return
    package = pathlib.Path(__file__).parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="lakeloader-code-")) / "lakeloader.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for source in sorted(package.rglob("*.py")):
            target.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._lakeloader_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: the session's `spark.checkpoint.dir`.

    Only a local session that names none (a test) gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="lakeloader-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return posixpath.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def written(frame: DataFrame, label: str = "step") -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage.

    Unlike a checkpoint it is computed once, and later steps read only the
    columns they need. It survives the loss of executors.
    """
    folder = fresh_folder(frame.sparkSession, label)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def local_frame(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A small table that is part of the plan: reading it takes no job.

    An empty one lets Spark drop the joins it takes part in.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)
    columns = list(zip(*rows)) if rows else [() for _ in arrow]
    arrays = [pa.array([_in_utc(value) for value in cells], field.type) for cells, field in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), struct)


def _in_utc(value):
    # What Spark collects has no zone and is in the driver's own.
    return value.astimezone(datetime.timezone.utc) if isinstance(value, datetime.datetime) else value
