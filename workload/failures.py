"""Objects that fail or change during a sync, limited reads, and what later syncs make of it.

Objects hold 100 events each. One of them is cut off, or overwritten after it was listed.
"""

from __future__ import annotations

import datetime
import gzip
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloader import LoadError, ObjectChanged, Settings, Sink, discover, sync
from lakeloader.session import fresh_folder, written
from lakeloader.sources.heads import open_file
from workload.objects import listing, table
from workload.scans import _EVENT, _EVENT_COLUMNS, _EVENT_VALUES

PER_OBJECT = 100
_LISTED = datetime.datetime(2026, 9, 2, 12, tzinfo=datetime.timezone.utc)
_BUCKET = f"CAST(floor(event_id / {PER_OBJECT}) AS BIGINT)"
_LAST = f"(SELECT max({_BUCKET}) FROM events)"


def _lines(spark: SparkSession, folder: str, record: str = _EVENT) -> DataFrame:
    rows = table(spark, folder, "events").where("event_id IS NOT NULL")
    return rows.select(F.expr(_BUCKET).alias("bucket"), F.col("event_id").alias("pos"), F.expr(record).alias("line"))


def _write(lines: DataFrame, folder: str, cut: int | None = None) -> None:
    """One gzipped file per bucket below a folder, over what is there; the file of bucket `cut` ends early."""

    def write(part: pa.Table) -> pa.Table:
        bucket = part["bucket"][0].as_py()
        rows = part.sort_by("pos")["line"].to_pylist()
        data = gzip.compress("".join(f"{row}\n" for row in rows).encode(), mtime=0)
        system, place = open_file(f"{folder}/bucket={bucket}/part.jsonl.gz")
        system.create_dir(place.rpartition("/")[0], recursive=True)
        with system.open_output_stream(place, compression=None) as target:
            target.write(data[: len(data) // 2] if bucket == cut else data)
        return pa.table({"bucket": [bucket]})

    made = lines.groupBy("bucket").applyInArrow(write, "bucket long")
    made.write.format("noop").mode("overwrite").save()


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """The objects as they are now."""
    return written(listing(spark, folder, "events", ".jsonl.gz"), "listing")


def _last(lines: DataFrame) -> int:
    return lines.agg(F.max("bucket").alias("bucket")).first().bucket


def _committed(spark: SparkSession, sink: str, catalog, phase: str) -> DataFrame:
    rows = Sink(spark, sink).read(catalog.streams["events"])
    return written(rows.select(F.lit(phase).alias("phase"), "_s3_key", "_row_number", *_EVENT_COLUMNS), "committed")


def _sync_twice(spark: SparkSession, objects: DataFrame, again, catalog, failure: type[Exception]) -> DataFrame:
    """What is committed after a sync that fails, and after the next one over the objects `again` gives."""
    sink, settings = fresh_folder(spark, "sink"), Settings(lookback_minutes=0)
    try:
        sync(objects, catalog, sink, settings, _LISTED)
    except failure:
        first = _committed(spark, sink, catalog, "failed")
    else:
        raise AssertionError("the sync should have failed")
    sync(again(), catalog, sink, settings, _LISTED)
    return first.unionByName(_committed(spark, sink, catalog, "mended"))


def after_truncated_gzip(spark: SparkSession, folder: str) -> DataFrame:
    """The newest object is cut off; it is whole when the next sync comes."""
    lines, where = _lines(spark, folder), fresh_folder(spark, "objects")
    _write(lines, where)
    catalog = discover(_listed(spark, where)).catalog
    _write(lines, where, _last(lines))

    def again() -> DataFrame:
        _write(lines, where)
        return _listed(spark, where)

    return _sync_twice(spark, _listed(spark, where), again, catalog, LoadError)


_CHANGED = _EVENT.replace("'event_type', event_type", "'event_type', concat('again ', event_type)")


def after_changed_object(spark: SparkSession, folder: str) -> DataFrame:
    """The newest object is overwritten after it was listed."""
    lines, where = _lines(spark, folder), fresh_folder(spark, "objects")
    _write(lines, where)
    objects = _listed(spark, where)
    catalog = discover(objects).catalog
    last = _last(lines)
    _write(_lines(spark, folder, _CHANGED).where(F.col("bucket") == last), where)
    return _sync_twice(spark, objects, lambda: _listed(spark, where), catalog, ObjectChanged)


def _limited(spark: SparkSession, folder: str, limit: int, cut: int | None, full: bool = False) -> DataFrame:
    lines, where = _lines(spark, folder), fresh_folder(spark, "objects")
    _write(lines, where)
    catalog = discover(_listed(spark, where)).catalog
    if cut is not None:
        _write(lines.where(F.col("bucket") == cut), where, cut)
    objects, sink = _listed(spark, where), fresh_folder(spark, "sink")
    sync(objects, catalog, sink, Settings(limits={"events": limit}), _LISTED)
    if full:
        sync(objects, catalog, sink, Settings(), _LISTED)
    return _committed(spark, sink, catalog, "limited").drop("phase")


_LIMIT = PER_OBJECT // 2


def stops_before_bad_object(spark: SparkSession, folder: str) -> DataFrame:
    """The limit is full within the first object; the second one can't be read."""
    return _limited(spark, folder, _LIMIT, 1)


def object_cap(spark: SparkSession, folder: str) -> DataFrame:
    """A limit no object fills: a limited read ends after 20 objects."""
    return _limited(spark, folder, 1 << 40, None)


def limited_state(spark: SparkSession, folder: str) -> DataFrame:
    """A limited read leaves the state alone, so a full one starts at the first object."""
    rows = _limited(spark, folder, _LIMIT, None, full=True)
    return rows.groupBy("event_id").agg(F.count(F.lit(1)).alias("times"))


QUERIES = {
    "sync_after_truncated_gzip": after_truncated_gzip,
    "sync_after_changed_object": after_changed_object,
    "limit_stops_before_bad_object": stops_before_bad_object,
    "limit_object_cap": object_cap,
    "limit_leaves_state": limited_state,
}


def _rows(values: list[str] = _EVENT_VALUES) -> str:
    return f"""SELECT 'events/' || {_BUCKET} || '.jsonl.gz' AS _s3_key,
        row_number() OVER (PARTITION BY {_BUCKET} ORDER BY event_id) AS _row_number, {', '.join(values)} FROM events"""


def _phases(last: list[str] = _EVENT_VALUES) -> str:
    phases = [
        f"SELECT 'failed' AS phase, * FROM ({_rows()}) WHERE floor(event_id / {PER_OBJECT}) < {_LAST}",
        f"SELECT 'mended' AS phase, * FROM ({_rows()}) WHERE floor(event_id / {PER_OBJECT}) < {_LAST}",
        f"SELECT 'mended' AS phase, * FROM ({_rows(last)}) WHERE floor(event_id / {PER_OBJECT}) = {_LAST}",
    ]
    return reduce("{} UNION ALL {}".format, phases)


ORACLES = {
    "sync_after_truncated_gzip": _phases(),
    "sync_after_changed_object": _phases(
        ["'again ' || event_type AS event_type" if value == "event_type" else value for value in _EVENT_VALUES]
    ),
    "limit_stops_before_bad_object": f"SELECT * FROM ({_rows()}) ORDER BY event_id LIMIT {_LIMIT}",
    "limit_object_cap": f"SELECT * FROM ({_rows()}) WHERE event_id < 20 * {PER_OBJECT}",
    "limit_leaves_state": f"SELECT event_id, CASE WHEN event_id < {_LIMIT} THEN 2 ELSE 1 END AS times FROM events",
}
