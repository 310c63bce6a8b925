"""Incremental reads as joins and aggregates over a listing and a state.

A stream's state is a bookmark and a window. The bookmark says that every
object up to it is done; it stays a lookback behind the listing. The window
holds the keys and tags of objects done after it, so that late or rewritten
objects are found. Both are tables:

- `bookmarks(stream, replication_key, bookmark, has_window)`, a row per stream
- `window(stream, key, etag, last_modified)`, a row per object

A window is stored as changes, `(stream, key, etag, last_modified, gone, version)`. The
newest row of a key counts, and what the bookmark has passed counts as gone without a
row of its own. So a step writes as much as it has read, however large the window is.

`members(root, stream, incremental, complete)` names the streams that read the
objects of a file stream: itself and its children. `complete` matters for the
step after a read: it says that nothing is left to read. Nothing here depends on the order
of a loop, and no step sorts or collects a stream in one place.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloader.model import LAST_MODIFIED, LOOKBACK_MINUTES
from lakeloader.session import local_frame

BOOKMARKS = "stream string, replication_key string, bookmark timestamp, has_window boolean"
WINDOW = "stream string, key string, etag string, last_modified timestamp"
CHANGES = WINDOW + ", gone boolean"
VERSIONED = CHANGES + ", version long"
MEMBERS = "root string, stream string, incremental boolean, complete boolean"


def window_start(listed_at: datetime.datetime, lookback_minutes: int | None = None) -> datetime.datetime:
    """The highest bookmark a run may write. `listed_at` is taken before listing."""
    minutes = LOOKBACK_MINUTES if lookback_minutes is None else max(int(lookback_minutes), 0)
    return listed_at - datetime.timedelta(minutes=minutes)


def empty_state(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """A state in which nothing was read."""
    return local_frame(spark, [], BOOKMARKS), local_frame(spark, [], WINDOW)


def effective_bookmarks(bookmarks: DataFrame, start: Column) -> DataFrame:
    """The bookmarks a run goes by.

    One kept for another replication key doesn't count. One written before
    windows existed may be past late objects: it is lowered to the window start.
    """
    own = F.when(
        F.col("replication_key").isNull() | (F.col("replication_key") == LAST_MODIFIED), F.col("bookmark")
    )
    # `least` skips nulls, and a missing bookmark must stay missing.
    lowered = F.when(~F.col("has_window") & own.isNotNull(), F.least(own, start)).otherwise(own)
    return bookmarks.select("stream", lowered.alias("bookmark"))


def objects_to_read(manifest: DataFrame, start_date: datetime.datetime | None = None) -> DataFrame:
    """The objects on or after the start date."""
    return manifest if start_date is None else manifest.where(F.col("last_modified") >= F.lit(start_date))


def candidates(manifest: DataFrame, members: DataFrame) -> DataFrame:
    """Every object with every stream that could read it, as `root, stream, key, …`."""
    objects = manifest.withColumnRenamed("stream", "root")
    # One row per stream of the catalog.
    return objects.join(F.broadcast(members), "root")


def targets(
    manifest: DataFrame, members: DataFrame, bookmarks: DataFrame, window: DataFrame, start: Column
) -> DataFrame:
    """The objects each stream must read.

    A full read takes all. Otherwise an object counts as read when it is not
    newer than the bookmark, or when the window holds its key with this tag.
    """
    known = effective_bookmarks(bookmarks, start)
    wanted = candidates(manifest, members).join(F.broadcast(known), "stream", "left")
    newer = F.col("bookmark").isNull() | (F.col("last_modified") > F.col("bookmark"))
    incremental = (
        wanted.where(F.col("incremental") & newer)
        # Spread by key, so a stream with most objects is no hot spot.
        .join(window.select("stream", "key", "etag"), ["stream", "key", "etag"], "left_anti")
    )
    return incremental.unionByName(wanted.where(~F.col("incremental"))).drop(
        "bookmark", "incremental", "complete"
    )


def next_bookmarks(
    manifest: DataFrame, members: DataFrame, finished: DataFrame, bookmarks: DataFrame,
    start: Column, times: tuple[Column, Column] | None = None,
) -> DataFrame:
    """The bookmarks after `finished(stream, key, etag)` were read.

    Objects can share a time, so a bookmark moves to a time only when the last
    object by key at that time is done. It never passes the window start and
    never moves back. A member that is `complete`, with nothing left to read,
    gets the window start. `times` may give the first and last time among the
    finished objects, so that a step of a long run looks at those times only.
    """
    if times is not None:
        manifest = manifest.where(F.col("last_modified").between(*times))
    every = candidates(manifest, members).select("stream", "key", "last_modified")
    done = finished.select("stream", "key", F.lit(True).alias("done"))
    reached = (
        every.join(done, ["stream", "key"], "left")
        .groupBy("stream", "last_modified")
        .agg(F.max_by(F.coalesce("done", F.lit(False)), "key").alias("last_done"))
        .where("last_done")
        .groupBy("stream")
        .agg(F.least(F.max("last_modified"), start).alias("reached"))
    )
    known = effective_bookmarks(bookmarks, start)
    # `greatest` skips nulls, as wanted here.
    end = F.when(F.col("complete"), start)
    moved = (
        members.select("stream", "complete")
        .join(known, "stream", "left")
        .join(reached, "stream", "left")
        .select("stream", F.greatest("bookmark", "reached", end).alias("bookmark"))
    )
    old = bookmarks.select("stream", F.col("replication_key").alias("old_key"), F.col("bookmark").alias("old"))
    return moved.join(old, "stream", "left").select(
        "stream",
        F.when(F.col("bookmark").isNotNull(), F.lit(LAST_MODIFIED)).otherwise(F.col("old_key")).alias("replication_key"),
        F.coalesce("bookmark", "old").alias("bookmark"),
        F.lit(True).alias("has_window"),
    )


def refresh_window(
    window: DataFrame, manifest: DataFrame, members: DataFrame, whole_listing: bool = True
) -> DataFrame:
    """Give the window's objects the times they are listed with, once per run.

    One that is no longer listed loses its time. A listing of only some objects
    says nothing about the others, so those keep theirs.
    """
    listed = candidates(manifest, members).select("stream", "key", F.col("last_modified").alias("listed"))
    time = F.col("listed") if whole_listing else F.coalesce("listed", "last_modified")
    return (
        window.join(F.broadcast(members.select("stream")), "stream", "left_semi")
        .join(listed, ["stream", "key"], "left")
        .select("stream", "key", "etag", time.alias("last_modified"))
        .unionByName(others(window, members))
    )


def next_window(
    members: DataFrame, finished: DataFrame, bookmarks: DataFrame, window: DataFrame
) -> DataFrame:
    """The window after `finished(stream, key, etag, last_modified)`.

    `bookmarks` are the ones after the step, and `window` is a refreshed one.
    Finished objects are added or replaced. Then objects without a time, or not
    newer than the bookmark, leave the window.
    """
    kept = (
        window.join(F.broadcast(members.select("stream")), "stream", "left_semi")
        .join(finished.select("stream", "key"), ["stream", "key"], "left_anti")
        .unionByName(finished.select("stream", "key", "etag", "last_modified"))
    )
    marks = bookmarks.select(
        "stream", F.when(F.col("replication_key") == LAST_MODIFIED, F.col("bookmark")).alias("bookmark")
    )
    return (
        kept.join(F.broadcast(marks), "stream", "left")
        .where(F.col("bookmark").isNull() | (F.col("last_modified") > F.col("bookmark")))
        .select("stream", "key", "etag", "last_modified")
    )


def window_times(
    window: DataFrame, manifest: DataFrame, members: DataFrame, whole_listing: bool = True
) -> DataFrame:
    """The window's entries whose time is not the listed one, with the time to use.

    It is null for an object that is no longer listed. Most runs find none.
    """
    listed = candidates(manifest, members).select("stream", "key", F.col("last_modified").alias("listed"))
    time = F.col("listed") if whole_listing else F.coalesce("listed", "last_modified")
    return (
        window.join(F.broadcast(members.select("stream")), "stream", "left_semi")
        .join(listed, ["stream", "key"], "left")
        .where(time.isNull() | ~time.eqNullSafe(F.col("last_modified")))
        .select("stream", "key", "etag", time.alias("last_modified"))
    )


def window_changes(
    members: DataFrame, finished: DataFrame, bookmarks: DataFrame, times: DataFrame, first: bool = True
) -> DataFrame:
    """What a step changes in the stored window.

    Finished objects are added or replaced. `times` are the `window_times` of the
    run, which its first step stores; entries without a time leave the window with
    a step of their stream that has a bookmark.
    """
    marked = bookmarks.where((F.col("replication_key") == LAST_MODIFIED) & F.col("bookmark").isNotNull())
    tracked = members.select("stream").join(marked.select("stream"), "stream", "left_semi")
    stay, leave = F.lit(False).alias("gone"), F.lit(True).alias("gone")
    changes = finished.select("stream", "key", "etag", "last_modified", stay).unionByName(
        times.where(F.col("last_modified").isNull())
        .join(F.broadcast(tracked), "stream", "left_semi")
        .select("*", leave)
    )
    if not first:
        return changes
    moved = times.where(F.col("last_modified").isNotNull())
    return changes.unionByName(
        moved.join(finished.select("stream", "key"), ["stream", "key"], "left_anti").select("*", stay)
    )


def window_at(changes: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """The window that stored changes amount to."""
    entry = F.struct("etag", "last_modified", "gone")
    marks = bookmarks.select(
        "stream", F.when(F.col("replication_key") == LAST_MODIFIED, F.col("bookmark")).alias("bookmark")
    )
    return (
        changes.groupBy("stream", "key")
        .agg(F.max_by(entry, "version").alias("entry"))
        .select("stream", "key", "entry.*")
        .where(~F.col("gone"))
        .join(F.broadcast(marks), "stream", "left")
        # An entry of an old state may not have its time yet.
        .where(F.col("bookmark").isNull() | F.col("last_modified").isNull() | (F.col("last_modified") > F.col("bookmark")))
        .select("stream", "key", "etag", "last_modified")
    )


def others(state: DataFrame, members: DataFrame) -> DataFrame:
    """The part of a state that a step doesn't touch."""
    return state.join(F.broadcast(members.select("stream")), "stream", "left_anti")


def objects_with_readers(wanted: DataFrame) -> DataFrame:
    """The objects to read, each once, with the `readers` that want it."""
    facts = [name for name in wanted.columns if name not in ("root", "stream", "key")]
    return (
        wanted.groupBy("root", "key")
        # As many entries as the file stream has child streams in the catalog.
        .agg(F.collect_set("stream").alias("readers"), *[F.first(name).alias(name) for name in facts])
        .withColumnRenamed("root", "stream")
    )


def finished_by(objects: DataFrame) -> DataFrame:
    """What objects count as for each of their readers once they are read."""
    return objects.select(
        F.explode("readers").alias("stream"), "key", "etag", "last_modified"
    )


def before_failure(objects: DataFrame, last_modified: Column, key: Column) -> DataFrame:
    """The objects before a failing one in read order."""
    return objects.where(
        (F.col("last_modified") < last_modified)
        | ((F.col("last_modified") == last_modified) & (F.col("key") < key))
    )
