"""The sink: rows per stream, and the state, committed together.

A commit writes its files below a folder of its own and then claims the next version
in the log (`plans.log`). A run that dies, or that another one has overtaken, leaves
only files no reader looks at. The window and the list of row folders are stored as
what each commit adds; every `MERGE_EVERY` commits they are written whole, so a
reader opens a bounded number of folders however long the log is.
"""

from __future__ import annotations

import json
import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloader.functions.datetimes import iso_timestamp, parse_bookmark
from lakeloader.operators.incremental import BOOKMARKS, VERSIONED, WINDOW, empty_state, window_at
from lakeloader.plans.catalog import Stream
from lakeloader.plans.log import CommitLog
from lakeloader.plans.read import ERROR, NOTES
from lakeloader.session import local_frame

_RUNS = "stream string, folder string"
#: Commits between two that write the window and the row folders whole.
MERGE_EVERY = 16


class Sink:
    """A folder that holds what was loaded."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._log = CommitLog(spark, posixpath.join(self.folder, "state", "log"))
        # The commit this writer builds on.
        self._base: dict | None = None

    def _table(self, parts: list[str], schema: str) -> DataFrame:
        if not parts:
            return local_frame(self.spark, [], schema)
        return self.spark.read.schema(schema).parquet(*[posixpath.join(self.folder, part) for part in parts])

    def _state(self, entry: dict | None) -> tuple[DataFrame, DataFrame]:
        if entry is None:
            return empty_state(self.spark)
        marks = self._table([entry["bookmarks"]], BOOKMARKS)
        return marks, window_at(self._table(entry["window"], VERSIONED), marks)

    def load_state(self) -> tuple[DataFrame, DataFrame]:
        """The committed `(bookmarks, window)`. The next commit of this sink builds on it."""
        self._base = self._log.latest()
        return self._state(self._base)

    def bookmarks(self) -> DataFrame:
        """The bookmarks of the state that was loaded, or committed since."""
        return empty_state(self.spark)[0] if self._base is None else self._state(self._base)[0]

    def new_run(self, stream: str) -> str:
        """A folder for a stream's rows that nothing uses yet."""
        return posixpath.join(self.folder, "data", stream, f"run-{uuid.uuid4().hex}")

    def commit(self, bookmarks: DataFrame, changes: DataFrame, runs: list[tuple[str, str]]) -> int:
        """Commit the next state, as changes to the loaded window, and the rows that belong to it.

        Raises `CommitConflict`, and commits nothing, if the loaded state is no longer the newest.
        """
        return self._commit(bookmarks, changes, runs, [] if self._base is None else self._base["window"])

    def replace_state(self, bookmarks: DataFrame, window: DataFrame) -> int:
        """Commit a state that replaces the committed one; the rows stay."""
        self._base = self._log.latest()
        return self._commit(bookmarks, window.withColumn("gone", F.lit(False)), [], [])

    def _commit(self, bookmarks: DataFrame, changes: DataFrame, runs: list[tuple[str, str]], window: list[str]) -> int:
        base = self._base or {"version": 0, "runs": []}
        version = base["version"] + 1
        part = posixpath.join("state", "commits", f"{version:012d}-{uuid.uuid4().hex}")
        path = posixpath.join(self.folder, part)
        entry = {"version": version, "bookmarks": f"{part}/bookmarks"}
        bookmarks.coalesce(1).write.parquet(f"{path}/bookmarks")
        changes = changes.withColumn("version", F.lit(version).cast("long"))
        if len(window) >= MERGE_EVERY:
            marks = self._table([entry["bookmarks"]], BOOKMARKS)
            whole = window_at(self._table(window, VERSIONED).unionByName(changes), marks)
            changes = whole.withColumns({"gone": F.lit(False), "version": F.lit(version).cast("long")})
            window = []
        changes.write.parquet(f"{path}/window")
        entry["window"] = [*window, f"{part}/window"]
        entry["runs"] = base["runs"]
        if runs:
            added = local_frame(self.spark, runs, _RUNS).coalesce(1)
            if len(base["runs"]) >= MERGE_EVERY:
                added = self._table(base["runs"], _RUNS).unionByName(added)
            added.write.parquet(f"{path}/runs")
            before = base["runs"] if len(base["runs"]) < MERGE_EVERY else []
            entry["runs"] = [*before, f"{part}/runs"]
        self._log.claim(version, entry)
        self._base = entry
        return version

    def runs(self) -> DataFrame:
        """Every committed `(stream, folder)`."""
        entry = self._log.latest()
        return self._table([] if entry is None else entry["runs"], _RUNS)

    def read(self, stream: Stream) -> DataFrame:
        """A stream's committed rows. Without any, an empty table with its schema."""
        return self._rows(stream, stream.schema())

    def _rows(self, stream: Stream, schema: str | T.StructType) -> DataFrame:
        folders = [row.folder for row in self.runs().where(F.col("stream") == stream.name).collect()]
        if not folders:
            return local_frame(self.spark, [], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def notes(self, stream: Stream) -> DataFrame:
        """What was renamed or dropped in a stream's committed rows: `note, rows`, all of it."""
        rows = self._rows(stream, f"{NOTES} array<string>")
        return rows.select(F.explode(NOTES).alias("note")).groupBy("note").agg(F.count("*").alias("rows"))

    def errors(self, folder: str) -> DataFrame:
        """The rows of a run that could not be read or converted."""
        return self.spark.read.parquet(folder).where(F.col(ERROR).isNotNull())


def state_to_json(bookmarks: DataFrame, window: DataFrame) -> str:
    """The state as one JSON document, for other tools. It holds one entry per window object."""
    marks = bookmarks.withColumn("bookmark", iso_timestamp(F.col("bookmark")))
    windows: dict[str, dict[str, str]] = {}
    for row in window.collect():
        windows.setdefault(row.stream, {})[row.key] = row.etag
    document: dict = {}
    for row in marks.collect():
        entry = document[row.stream] = {}
        if row.replication_key is not None:
            entry["replication_key"] = row.replication_key
        if row.bookmark is not None:
            entry["replication_key_value"] = row.bookmark
        if row.has_window:
            entry["window"] = windows.get(row.stream, {})
    return json.dumps({"bookmarks": document})


def state_from_json(spark: SparkSession, text: str) -> tuple[DataFrame, DataFrame]:
    """Read a JSON state, also one saved elsewhere."""
    marks, entries = [], []
    for stream, entry in (json.loads(text).get("bookmarks") or {}).items():
        window = entry.get("window")
        marks.append(
            (stream, entry.get("replication_key"), entry.get("replication_key_value") or None,
             isinstance(window, dict))
        )
        entries += [(stream, key, tag, None) for key, tag in (window or {}).items()]
    bookmarks = local_frame(spark, 
        marks, "stream string, replication_key string, text string, has_window boolean"
    ).select("stream", "replication_key", parse_bookmark(F.col("text")).alias("bookmark"), "has_window")
    return bookmarks, local_frame(spark, entries, WINDOW)
