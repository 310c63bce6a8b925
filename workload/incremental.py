"""Incremental reads, limits and streaming."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloader import Settings, discover, sync
from lakeloader.operators import incremental as inc
from lakeloader.session import fresh_folder
from lakeloader.sources.layout import build_layout
from lakeloader.streaming.follow import follow
from workload.nested import _child_sql, _jsonl
from workload.objects import bucket_sql, json_lines, listing, spread, table, write_text
from workload.scans import _EVENT, _EVENT_COLUMNS, _EVENT_VALUES, _expected

# A listing with an object per order: many share a time, and one customer
# group is one file stream with two child streams.
_STREAM = "'orders' || CAST(o_custkey % 3 AS STRING)"
_KEY = f"{_STREAM} || '/' || CAST(o_orderkey AS STRING) || '.jsonl'"
_ETAG = "md5(CAST(o_orderkey AS STRING))"
_START = "TIMESTAMP '2000-01-01 00:00:00'"
_START_UTC = datetime.datetime(2000, 1, 1, tzinfo=datetime.timezone.utc)
# Known before: a bookmark for two of the streams, and a window of some orders,
# every fifth of them with another tag.
_MARKS = [
    ("orders0", "_s3_last_modified", datetime.datetime(1998, 6, 1, tzinfo=datetime.timezone.utc), True),
    ("orders0__lines", "_s3_last_modified", datetime.datetime(1997, 1, 1, tzinfo=datetime.timezone.utc), True),
    ("orders1", "updated_at", datetime.datetime(2001, 1, 1, tzinfo=datetime.timezone.utc), True),
    ("orders2", None, datetime.datetime(2000, 6, 1, tzinfo=datetime.timezone.utc), False),
]
_IN_WINDOW = "o_orderkey % 4 = 1"
_WINDOW_TAG = f"CASE WHEN o_orderkey % 5 = 0 THEN 'old' ELSE {_ETAG} END"


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    listed = table(spark, folder, "orders").selectExpr(
        f"{_KEY} AS key", f"{_KEY} AS path", "CAST(o_orderdate AS TIMESTAMP) AS last_modified",
        "1 AS size", f"{_ETAG} AS etag",
    )
    return build_layout(listed).manifest


def _members(spark: SparkSession, incremental: bool = True, complete: bool = False) -> DataFrame:
    rows = [
        (f"orders{n}", f"orders{n}{child}", incremental, complete) for n in range(3) for child in ("", "__lines")
    ]
    return spark.createDataFrame(rows, inc.MEMBERS)


def _state(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    window = table(spark, folder, "orders").where(_IN_WINDOW).selectExpr(
        f"{_STREAM} AS stream", f"{_KEY} AS key", f"{_WINDOW_TAG} AS etag",
        "CAST(o_orderdate AS TIMESTAMP) AS last_modified",
    )
    return spark.createDataFrame(_MARKS, inc.BOOKMARKS), window


def _start():
    return F.lit(_START_UTC)


def first_run(spark: SparkSession, folder: str) -> DataFrame:
    marks, window = inc.empty_state(spark)
    found = inc.targets(_manifest(spark, folder), _members(spark), marks, window, _start())
    return found.groupBy("root", "stream").agg(F.count("*").alias("objects"), F.max("key").alias("last"))


def targets(spark: SparkSession, folder: str) -> DataFrame:
    """Bookmarks, windows, foreign and legacy bookmarks, rewritten objects."""
    marks, window = _state(spark, folder)
    found = inc.targets(_manifest(spark, folder), _members(spark), marks, window, _start())
    return found.select("stream", "key", "etag")


def full_table(spark: SparkSession, folder: str) -> DataFrame:
    marks, window = _state(spark, folder)
    found = inc.targets(_manifest(spark, folder), _members(spark, False), marks, window, _start())
    return found.select("stream", "key")


def start_date(spark: SparkSession, folder: str) -> DataFrame:
    marks, window = _state(spark, folder)
    readable = inc.objects_to_read(
        _manifest(spark, folder), datetime.datetime(1999, 3, 1, tzinfo=datetime.timezone.utc)
    )
    found = inc.targets(readable, _members(spark), marks, window, _start())
    return found.select("stream", "key")


def readers(spark: SparkSession, folder: str) -> DataFrame:
    """Each object once, with the streams of its group that want it."""
    marks, window = _state(spark, folder)
    found = inc.targets(_manifest(spark, folder), _members(spark), marks, window, _start())
    objects = inc.objects_with_readers(found)
    return objects.select("key", F.concat_ws("|", F.array_sort("readers")).alias("readers"))


def _finished(spark: SparkSession, folder: str) -> DataFrame:
    """What is done when the first object of 1999-07-01 or later fails."""
    marks, window = _state(spark, folder)
    found = inc.targets(_manifest(spark, folder), _members(spark), marks, window, _start())
    failing = F.lit(datetime.datetime(1999, 7, 1, tzinfo=datetime.timezone.utc))
    return inc.before_failure(found, failing, F.lit(""))


def bookmarks(spark: SparkSession, folder: str) -> DataFrame:
    """Bookmarks after a failure: they wait at times with unread objects."""
    marks, _ = _state(spark, folder)
    moved = inc.next_bookmarks(
        _manifest(spark, folder), _members(spark), _finished(spark, folder), marks, _start()
    )
    return moved.select("stream", "replication_key", F.col("bookmark").cast("string").alias("bookmark"))


def bookmarks_complete(spark: SparkSession, folder: str) -> DataFrame:
    marks, window = _state(spark, folder)
    members = _members(spark, complete=True)
    found = inc.targets(_manifest(spark, folder), members, marks, window, _start())
    moved = inc.next_bookmarks(_manifest(spark, folder), members, found, marks, _start())
    return moved.select("stream", F.col("bookmark").cast("string").alias("bookmark"))


def window_prune(spark: SparkSession, folder: str) -> DataFrame:
    """The window after a complete run: what is newer than the bookmark."""
    marks, window = _state(spark, folder)
    manifest, members = _manifest(spark, folder), _members(spark, complete=True)
    found = inc.targets(manifest, members, marks, window, _start())
    moved = inc.next_bookmarks(manifest, members, found, marks, _start())
    fresh = inc.refresh_window(window, manifest, members)
    kept = inc.next_window(members, found, moved, fresh)
    return kept.select("stream", "key", "etag")


def window_after_failure(spark: SparkSession, folder: str) -> DataFrame:
    marks, window = _state(spark, folder)
    manifest, members, done = _manifest(spark, folder), _members(spark), _finished(spark, folder)
    moved = inc.next_bookmarks(manifest, members, done, marks, _start())
    fresh = inc.refresh_window(window, manifest, members)
    return inc.next_window(members, done, moved, fresh).select("stream", "key", "etag")


def window_deltas(spark: SparkSession, folder: str) -> DataFrame:
    """The window after the same step, kept as changes: the old entries, then what the step adds."""
    marks, window = _state(spark, folder)
    manifest, members, done = _manifest(spark, folder), _members(spark), _finished(spark, folder)
    moved = inc.next_bookmarks(manifest, members, done, marks, _start())
    changes = inc.window_changes(members, done, moved, inc.window_times(window, manifest, members))
    stored = window.select("*", F.lit(False).alias("gone"), F.lit(0).alias("version"))
    return inc.window_at(stored.unionByName(changes.withColumn("version", F.lit(1))), moved).select("stream", "key", "etag")


def _events(spark: SparkSession, folder: str) -> DataFrame:
    rows = spread(table(spark, folder, "events"), "event_id")
    return listing(spark, write_text(json_lines(rows, F.expr(_EVENT))), "events", ".jsonl")


_LISTED = datetime.datetime(2026, 9, 2, 12, tzinfo=datetime.timezone.utc)


def sync_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the objects first, then all: every row arrives once."""
    objects = _events(spark, folder)
    catalog = discover(objects).catalog
    sink = fresh_folder(spark, "sink")
    half = objects.where(F.regexp_extract("key", r"(\d+)\.", 1).cast("bigint") % 2 == 0)
    sync(half, catalog, sink, Settings(lookback_minutes=60 * 48), _LISTED)
    result = sync(objects, catalog, sink, Settings(lookback_minutes=60 * 48), _LISTED)
    return result.rows("events").select("_s3_key", "_row_number", *_EVENT_COLUMNS)


def sync_group(spark: SparkSession, folder: str) -> DataFrame:
    """A child stream through the whole sync job, with batches."""
    objects = _jsonl(spark, folder)
    catalog = discover(objects).catalog
    settings = Settings(checkpoint_objects=max(3, objects.count() // 4))
    result = sync(objects, catalog, fresh_folder(spark, "sink"), settings, _LISTED)
    return result.rows("orders__lines").drop("_s3_last_modified")


def limited(spark: SparkSession, folder: str) -> DataFrame:
    """A record limit per stream: the first rows in read order."""
    objects = _jsonl(spark, folder)
    catalog = discover(objects).catalog.select("orders", "orders__lines")
    limits = {"orders": 2500, "orders__lines": 700}
    result = sync(objects, catalog, fresh_folder(spark, "sink"), Settings(limits=limits), _LISTED)
    parent = result.rows("orders").selectExpr("'orders' AS stream", "id AS parent", "-1 AS idx")
    child = result.rows("orders__lines").selectExpr(
        "'orders__lines' AS stream", "_parent__id AS parent", "cast(_index AS int) AS idx"
    )
    return parent.unionByName(child)


def streamed(spark: SparkSession, folder: str) -> DataFrame:
    """Listings that arrive as a stream of files; each micro-batch is one sync."""
    objects = _events(spark, folder)
    catalog = discover(objects).catalog
    inbox, sink = fresh_folder(spark, "inbox"), fresh_folder(spark, "sink")
    objects.repartition(2, "key").write.parquet(inbox)
    arriving = spark.readStream.schema(objects.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    settings = Settings(lookback_minutes=60 * 48)
    query = follow(
        arriving, catalog, sink, fresh_folder(spark, "stream"), settings, clock=lambda: _LISTED
    )
    query.awaitTermination()
    from lakeloader import Sink

    read = Sink(spark, sink).read(catalog.streams["events"])
    return read.select("_s3_key", "_row_number", *_EVENT_COLUMNS)


QUERIES = {
    "inc_first_run": first_run,
    "inc_targets": targets,
    "inc_full_table": full_table,
    "inc_start_date": start_date,
    "inc_readers": readers,
    "inc_bookmarks_after_failure": bookmarks,
    "inc_bookmarks_complete": bookmarks_complete,
    "inc_window_prune": window_prune,
    "inc_window_after_failure": window_after_failure,
    "inc_window_deltas": window_deltas,
    "sync_twice": sync_twice,
    "sync_child_batches": sync_group,
    "limit_rows": limited,
    "stream_sync": streamed,
}

_OBJECTS = f"""(SELECT o_orderkey, o_custkey, o_orderdate, root || child AS stream, root, key, etag,
  child = '' AND {_IN_WINDOW} AND o_orderkey % 5 > 0 AS in_window,
  CASE root || child WHEN 'orders0' THEN TIMESTAMP '1998-06-01' WHEN 'orders0__lines' THEN TIMESTAMP '1997-01-01'
    WHEN 'orders2' THEN {_START} END AS mark
  FROM (SELECT *, {_STREAM} AS root, {_KEY} AS key, {_ETAG} AS etag FROM orders),
    (VALUES (''), ('__lines')) AS children(child))"""
_TARGETS = f"(SELECT * FROM {_OBJECTS} WHERE (mark IS NULL OR o_orderdate > mark) AND NOT in_window)"
_FAILED = "TIMESTAMP '1999-07-01'"
# A time counts when its last object by key is done.
_REACHED = f"""(SELECT stream, least(max(o_orderdate), {_START}) AS reached FROM
  (SELECT stream, o_orderdate, arg_max(done, key) AS last_done FROM (SELECT o.*,
     (mark IS NULL OR o_orderdate > mark) AND NOT in_window AND o_orderdate < {_FAILED} AS done FROM {_OBJECTS} o)
   GROUP BY ALL) WHERE last_done GROUP BY stream)"""
_MARK_TEXT = "strftime(bookmark, '%Y-%m-%d %H:%M:%S')"
_MARKED = f"""(SELECT stream, greatest(any_value(mark), any_value(reached)) AS bookmark
  FROM {_OBJECTS} LEFT JOIN {_REACHED} USING (stream) GROUP BY stream)"""
ORACLES = {
    "inc_first_run": f"SELECT root, stream, count(*) AS objects, max(key) AS last FROM {_OBJECTS} GROUP BY ALL",
    "inc_targets": f"SELECT stream, key, etag FROM {_TARGETS}",
    "inc_full_table": f"SELECT stream, key FROM {_OBJECTS}",
    "inc_start_date": f"SELECT stream, key FROM {_TARGETS} WHERE o_orderdate >= TIMESTAMP '1999-03-01'",
    "inc_readers": f"SELECT key, string_agg(stream, '|' ORDER BY stream) AS readers FROM {_TARGETS} GROUP BY key",
    "inc_bookmarks_after_failure": f"""SELECT stream, CASE WHEN bookmark IS NOT NULL THEN '_s3_last_modified' END AS replication_key,
        {_MARK_TEXT} AS bookmark FROM {_MARKED}""",
    "inc_bookmarks_complete": f"""SELECT DISTINCT stream,
        CASE WHEN stream = 'orders2' THEN '2000-01-01 00:00:00' ELSE '2000-01-01 00:00:00' END AS bookmark
        FROM {_OBJECTS}""",
    "inc_window_prune": f"""SELECT stream, key, etag FROM {_OBJECTS} WHERE o_orderdate > {_START}""",
    "inc_window_after_failure": f"""SELECT stream, key,
        CASE WHEN done OR in_window THEN etag ELSE 'old' END AS etag FROM (SELECT o.*, bookmark,
          (mark IS NULL OR o_orderdate > mark) AND NOT in_window AND o_orderdate < {_FAILED} AS done
          FROM {_OBJECTS} o JOIN {_MARKED} USING (stream))
        WHERE (done OR (stream = root AND {_IN_WINDOW})) AND (bookmark IS NULL OR o_orderdate > bookmark)""",
    "sync_twice": _expected("events", "event_id", _EVENT_COLUMNS, ".jsonl", _EVENT_VALUES),
    "sync_child_batches": _child_sql(".jsonl"),
    "limit_rows": f"""SELECT 'orders' AS stream, o_orderkey AS parent, -1 AS idx FROM
          (SELECT * FROM orders ORDER BY {bucket_sql('o_orderkey')}, o_orderkey LIMIT 2500)
        UNION ALL SELECT * FROM (SELECT 'orders__lines', o_orderkey, idx FROM orders, (VALUES (0), (2)) AS items(idx)
          ORDER BY {bucket_sql('o_orderkey')}, o_orderkey, idx LIMIT 700)""",
    "stream_sync": _expected("events", "event_id", _EVENT_COLUMNS, ".jsonl", _EVENT_VALUES),
}
# Stored as changes or whole, a window is the same.
ORACLES["inc_window_deltas"] = ORACLES["inc_window_after_failure"]
