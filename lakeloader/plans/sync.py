"""The sync job: from a listing, a catalog and a state to rows and the next state.

Objects are taken in read order, in batches with a bounded number of objects
and bytes. Each batch is read once for all streams of its group, written, and
committed with its state. So a run that fails keeps the batches before, and a
driver never holds more than one batch's object list.
"""

from __future__ import annotations

import datetime
import re
import time
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloader.model import JSONL, KEY, LAST_MODIFIED, LIMITED_MAX_OBJECTS, MAX_REPORTED_KEYS, LoadError, ObjectChanged
from lakeloader.operators import incremental as inc
from lakeloader.plans.catalog import Catalog, Group, Stream
from lakeloader.plans.read import ERROR, NOTES, OBJ, POS, ROW, Batch, GroupRows, location_of, read_order, schema_notes
from lakeloader.plans.state import Sink
from lakeloader.session import local_frame, prepare, written
from lakeloader.sources.jsonl import physical_line
from lakeloader.sources.layout import build_layout
from lakeloader.sources.layout import read_order as ranked


@dataclass(frozen=True)
class Settings:
    """What a sync can be told."""

    prefix: str | None = None
    exclude: str | None = None
    incremental: bool = True
    lookback_minutes: int | None = None
    start_date: datetime.datetime | str | None = None
    limits: dict[str, int] = field(default_factory=dict)
    checkpoint_objects: int = 10_000
    checkpoint_bytes: int = 1 << 40
    # A batch that ends so long after the last commit is committed at once.
    checkpoint_seconds: float = 300
    # False when a listing holds only some of the objects, such as new ones.
    whole_listing: bool = True

    def __post_init__(self):
        if not isinstance(self.incremental, bool):
            raise ValueError("incremental must be true or false")
        check_limits(self.limits)

    @property
    def first_date(self) -> datetime.datetime | None:
        value = self.start_date
        if isinstance(value, str):
            value = datetime.datetime.fromisoformat(value.strip().replace("Z", "+00:00").replace("z", "+00:00"))
        if value is not None and value.tzinfo is None:
            value = value.replace(tzinfo=datetime.timezone.utc)
        return value


def check_limits(limits) -> None:
    """A record limit is a whole number of at least 1, by stream name."""
    if not isinstance(limits, dict):
        raise ValueError("record limits must map stream names to numbers")
    for name, limit in limits.items():
        if isinstance(limit, bool) or not isinstance(limit, int) or limit < 1:
            raise ValueError(f"the record limit of '{name}' must be a whole number of at least 1")


@dataclass
class SyncResult:
    """What a sync did."""

    sink: Sink
    catalog: Catalog
    skipped: dict[str, str] = field(default_factory=dict)
    renamed: dict[str, set[str]] = field(default_factory=dict)
    dropped: dict[str, set[str]] = field(default_factory=dict)
    # Streams with more of them than are reported here; `sink.notes` gives all.
    more_notes: set[str] = field(default_factory=set)
    objects_read: int = 0
    commits: int = 0

    def rows(self, stream: str) -> DataFrame:
        """Every committed row of a stream."""
        return self.sink.read(self.catalog.streams[stream])


def members_of(
    spark: SparkSession, groups: list[Group], settings: Settings, complete: bool = False
) -> DataFrame:
    """The streams that read each file stream's objects."""
    rows = [
        (group.root, stream.name, settings.incremental and not stream.full_table, complete)
        for group in groups
        for stream in group.active().values()
    ]
    return local_frame(spark, rows, inc.MEMBERS)


def limit_rows(rows: DataFrame, stream: Stream, limit: int | None) -> DataFrame:
    """The first rows of a stream in read order.

    Rows that can't be read count too: one within the limit is an error, one
    past it is never seen.
    """
    if limit is None:
        return rows
    if stream.parent is None:
        # A file stream's first N rows lie among the first N rows of each object.
        rows = rows.where(F.col(ROW) <= limit)
    if limit >= 1 << 31:
        # More than Spark's own limits take.
        if rows.count() <= limit:
            return rows
        raise ValueError(f"the stream '{stream.name}' has more than its record limit of {limit} rows")
    return rows.orderBy(*read_order()).limit(limit)


def sync(
    listing: DataFrame,
    catalog: Catalog,
    folder: str,
    settings: Settings = Settings(),
    listed_at: datetime.datetime | None = None,
    state: tuple[DataFrame, DataFrame] | None = None,
) -> SyncResult:
    """Read what is new into the sink at `folder`.

    `state` replaces the sink's own state, as when moving from another tool.
    """
    spark = prepare(listing.sparkSession)
    listed_at = listed_at or datetime.datetime.now(datetime.timezone.utc)
    sink = Sink(spark, folder)
    layout = build_layout(listing, settings.prefix, settings.exclude)
    # Every step below reads the listing; list once.
    manifest = written(layout.manifest.drop("raw_name"))
    present = [row.stream for row in manifest.select("stream").distinct().collect()]
    groups, skipped = catalog.link(present)
    result = SyncResult(sink, catalog, skipped)
    if state is not None:
        sink.replace_state(*state)
    start = F.lit(inc.window_start(listed_at, settings.lookback_minutes))
    _Run(manifest, [group for group in groups if group.active()], settings, start, result).run()
    return result


@dataclass(frozen=True)
class _Failure:
    """The first object of a batch that could not be read."""

    obj: int
    key: str
    time: datetime.datetime
    message: str
    changed: bool = False

    def error(self) -> LoadError:
        return (ObjectChanged if self.changed else LoadError)(self.message)


class _Run:
    """One sync: all groups, in order, with commits in between."""

    def __init__(self, manifest: DataFrame, groups: list[Group], settings: Settings, start: Column, result: SyncResult):
        self.spark, self.sink = result.sink.spark, result.sink
        self.manifest, self.groups, self.settings, self.start = manifest, groups, settings, start
        self.result = result
        self.readable = inc.objects_to_read(manifest, settings.first_date)
        self.given = {name: 0 for name in settings.limits}
        # What waits for the next commit: rows, batches as (root, batch), and the
        # groups that have nothing left to read.
        self.runs: list[tuple[str, str]] = []
        self.batches: list[tuple[str, int]] = []
        self.complete: set[str] = set()
        self.waiting = self.waiting_bytes = 0
        self.committed_at = time.monotonic()
        self.times: list[tuple[datetime.datetime, datetime.datetime]] = []
        # Entries of the window whose times the listing changes; the first commit stores them.
        self.window_times: DataFrame | None = None
        self.first = True

    def run(self) -> None:
        if not self.groups:
            return
        bookmarks, window = self.sink.load_state()
        members = members_of(self.spark, self.groups, self.settings)
        wanted = inc.targets(self.readable, members, bookmarks, window, self.start)
        settings = self.settings
        # The plan of the whole run, a row per object to read.
        self.plan = written(
            ranked(inc.objects_with_readers(wanted)).withColumn(
                "batch",
                F.floor((F.col("rank") - 1) / settings.checkpoint_objects)
                + F.floor(F.col("bytes_before") / settings.checkpoint_bytes),
            )
        )
        self.window_times = written(
            inc.window_times(window, self.manifest, members, settings.whole_listing), "window"
        )
        sizes: dict[str, list[tuple]] = {}
        times = [F.sum("size"), F.min("last_modified"), F.max("last_modified")]
        for stream, *batch in self.plan.groupBy("stream", "batch").agg(F.count("*"), *times).collect():
            sizes.setdefault(stream, []).append(tuple(batch))
        for group in self.groups:
            if self._limited(group) == {stream.name for stream in group.active().values()}:
                self._sample(group)
                continue
            for number, count, size, first, last in sorted(sizes.get(group.root, ())):
                self.times.append((first, last))
                part = self.plan.where((F.col("stream") == group.root) & (F.col("batch") == number))
                runs, failure = self._load(group, part)
                self.runs += runs
                if failure is not None:
                    before = inc.before_failure(part, F.lit(failure.time), F.lit(failure.key))
                    self._commit(before, group)
                    raise failure.error()
                self.batches.append((group.root, number))
                self.waiting += count
                self.waiting_bytes += size
                full = self.waiting >= settings.checkpoint_objects or self.waiting_bytes >= settings.checkpoint_bytes
                if full or time.monotonic() - self.committed_at >= settings.checkpoint_seconds:
                    self._commit()
            self.complete.add(group.root)
        self._commit()

    def _limited(self, group: Group) -> set[str]:
        return {s.name for s in group.active().values() if s.name in self.settings.limits}

    def _commit(self, more: DataFrame | None = None, failed: Group | None = None) -> None:
        """Write the state after the waiting batches, with the rows that belong to it."""
        touched = {root for root, _ in self.batches} | self.complete
        if failed is not None:
            touched.add(failed.root)
        rows = [
            (group.root, stream.name, True, group.root in self.complete)
            for group in self.groups
            if group.root in touched
            for stream in group.active().values()
            # A limit can drop rows, so a limited stream never moves.
            if stream.name not in self.settings.limits
        ]
        bookmarks = self.sink.bookmarks()
        changes = local_frame(self.spark, [], inc.CHANGES)
        if rows:
            tracked = local_frame(self.spark, rows, inc.MEMBERS)
            waiting = local_frame(self.spark, self.batches, "stream string, batch bigint")
            # One row per batch of the run.
            done = self.plan.join(F.broadcast(waiting), ["stream", "batch"], "left_semi")
            if more is not None:
                done = done.unionByName(more)
            finished = inc.finished_by(done).join(F.broadcast(tracked.select("stream")), "stream", "left_semi")
            ends = [F.lit(pick(pair)) for pick, pair in ((min, [a for a, _ in self.times]), (max, [b for _, b in self.times])) if pair]
            marks = written(
                inc.next_bookmarks(
                    self.readable, tracked, finished, bookmarks, self.start, tuple(ends) or None
                )
            )
            changes = inc.window_changes(tracked, finished, marks, self.window_times, self.first)
            bookmarks = inc.others(bookmarks, tracked).unionByName(marks)
            self.first = False
        if rows or self.runs:
            self.sink.commit(bookmarks, changes, self.runs)
            self.result.commits += 1
        self.runs, self.batches, self.complete, self.times = [], [], set(), []
        self.waiting = self.waiting_bytes = 0
        self.committed_at = time.monotonic()

    def _sample(self, group: Group) -> None:
        """A sample read: at most 20 objects, and no more than the limits need.

        The state stays as it is, because a limit can drop rows. An object that
        fails counts only if the ones before it leave a limit open.
        """
        objects = self.plan.where(F.col("stream") == group.root)
        first = objects.orderBy("last_modified", "key").limit(LIMITED_MAX_OBJECTS)
        rows = sorted(first.collect(), key=lambda row: (row.last_modified, row.key))
        names = [stream.name for stream in group.active().values()]
        taken = 0

        def full() -> bool:
            return all(self.given[name] >= self.settings.limits[name] for name in names)

        for size in (1, 4, LIMITED_MAX_OBJECTS):
            if full() or taken >= len(rows):
                return
            some = local_frame(self.spark, rows[taken : taken + size], first.schema)
            taken += size
            runs, failure = self._load(group, some)
            self.runs += runs
            if failure is not None and not full():
                self._commit()
                raise failure.error()

    def _load(self, group: Group, part: DataFrame) -> tuple[list[tuple[str, str]], _Failure | None]:
        """Write the rows of a batch. Gives its run folders, and the first failure.

        After a failure the rows of the objects before it are kept, and nothing
        of the others.
        """
        batch = Batch.collect(part, skip_changed=True)
        failure: _Failure | None = None
        for key, message in batch.changed.items():
            failure = self._changed_before(part, key, message)
            batch = batch.subset({x.obj for x in batch.objects if (batch.modified[x.obj], x.key) < (failure.time, key)})
            break
        self.result.objects_read += len(batch.objects)
        while batch.objects:
            given = dict(self.given)
            try:
                runs, worse = self._write(batch, group)
            except (PySparkException, Py4JJavaError) as err:
                runs, worse = [], _unreadable(batch, err)
            if worse is None:
                overwritten = batch.overwritten()
                if not overwritten:
                    return runs, failure
                first = overwritten[0]
                message = f"{first.key} changed during the sync"
                worse = _Failure(first.obj, first.key, batch.modified[first.obj], message, changed=True)
                self.given = given
            # Look again at the objects before it: one of them may fail, too.
            failure = worse
            batch = batch.subset(set(range(worse.obj)))
        return [], failure

    def _changed_before(self, part: DataFrame, key: str, message: str) -> _Failure:
        """The failure of an object that had changed before its batch was read."""
        row = part.where(F.col("key") == key).select("last_modified").first()
        return _Failure(-1, key, row.last_modified, message, changed=True)

    def _write(self, batch: Batch, group: Group) -> tuple[list[tuple[str, str]], _Failure | None]:
        active = group.active()
        rows = GroupRows(batch, group, active, stage=True)
        for stream, note in schema_notes(batch, group):
            self._note(stream, note)
        numbers = {item.key: item.obj for item in batch.objects}
        runs, failures, counts = [], [], {}
        for lineage, stream in active.items():
            limit = self.settings.limits.get(stream.name)
            if limit is not None:
                limit -= self.given[stream.name]
                if limit <= 0:
                    continue
            folder = self.sink.new_run(stream.name)
            found = rows.rows(lineage)
            mine = [item.obj for item in batch.objects if stream.name in batch.readers[item.obj]]
            if len(mine) < len(batch.objects):
                # Another stream of the group wants objects this one has read already.
                wanted = local_frame(self.spark, [(number,) for number in mine], f"{OBJ} int")
                found = found.join(F.broadcast(wanted), OBJ, "left_semi")
            limit_rows(found, stream, limit).drop(OBJ, POS).write.parquet(folder)
            # Two columns of what was just written; statistics skip files without any.
            written = self.spark.read.parquet(folder)
            first = written.where(F.col(ERROR).isNotNull()).orderBy(LAST_MODIFIED, KEY, ROW).first()
            if first is not None:
                failures.append(self._failure(batch, numbers[first[KEY]], stream, first))
            kind = Window.partitionBy(F.split_part("note", F.lit(":"), F.lit(1))).orderBy("note")
            notes = written.select(F.explode(NOTES).alias("note")).distinct()
            # One more than is shown tells that there are more.
            notes = notes.withColumn("place", F.row_number().over(kind)).where(F.col("place") <= MAX_REPORTED_KEYS + 1)
            for row in notes.collect():
                self._note(stream.name, row.note)
            if limit is not None:
                counts[stream.name] = written.count()
            runs.append((stream.name, folder))
        if failures:
            return [], min(failures, key=lambda failure: failure.obj)
        for name, count in counts.items():
            self.given[name] += count
        return runs, None

    def _failure(self, batch: Batch, obj: int, stream: Stream, row) -> _Failure:
        item = next(item for item in batch.objects if item.obj == obj)
        place = f"row {row[ROW]}"
        if item.kind == JSONL and not row[ERROR].startswith("column "):
            place += f" (line {physical_line(self.spark, item, row[ROW])})"
        message = f"could not read {item.key}, stream '{stream.name}' {place}: {row[ERROR]}"
        return _Failure(obj, item.key, batch.modified[obj], message)

    def _note(self, stream: str, note: str) -> None:
        kind, _, text = note.partition(":")
        notes = self.result.renamed if kind == "rename" else self.result.dropped
        shown = notes.setdefault(stream, set())
        if text in shown:
            return
        if len(shown) < MAX_REPORTED_KEYS:
            shown.add(text)
        else:
            self.result.more_notes.add(stream)


# Fixed text: how Spark names the file of a failed read.
_FAILED_FILE = re.compile(r"while reading file (.+?)\.\s+(?:SQLSTATE|Details)", re.S)


def _unreadable(batch: Batch, err: Exception) -> _Failure:
    """The object a failed read is about, if the error names one of the batch."""
    text = str(err)
    named = {location_of(path) for path in _FAILED_FILE.findall(text)}
    for item in batch.objects:
        read = batch.unpacked.get(item.obj, item)
        if named & {location_of(path) for path in (read.file, unquote(read.file), read.path)}:
            reason = re.findall(r"Caused by: (.+)", text) or re.findall(r"Details: (.+)", text)
            message = f"could not read {item.key}: {reason[-1] if reason else text.splitlines()[0]}"
            return _Failure(item.obj, item.key, batch.modified[item.obj], message)
    raise err
