"""Follow a stream of listings: every micro-batch of objects is one sync.

Spark's own file stream never reads a rewritten object again and forgets late
ones. Here a stream of *listing rows* (bucket inventories, change events) says
that objects exist; which of them to read follows from the state, as in a
batch sync, so a replayed micro-batch reads nothing twice.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeloader.plans.catalog import Catalog
from lakeloader.plans.sync import Settings, SyncResult, sync


def latest_versions(listing: DataFrame) -> DataFrame:
    """The newest version of each object; events may name an object more than once."""
    version = F.struct("last_modified", "etag", "size", "path")
    return (
        listing.groupBy("key")
        .agg(F.max(version).alias("latest"))
        .select("key", "latest.path", "latest.last_modified", "latest.size", "latest.etag")
    )


def follow(
    listings: DataFrame,
    catalog: Catalog,
    folder: str,
    checkpoint: str,
    settings: Settings = Settings(),
    trigger: dict | None = None,
    clock: Callable[[], datetime.datetime] | None = None,
    done: Callable[[int, SyncResult], None] | None = None,
) -> StreamingQuery:
    """Sync every micro-batch of a streaming listing into the sink at `folder`."""
    partial = replace(settings, whole_listing=False)

    def load(rows: DataFrame, epoch: int) -> None:
        if rows.isEmpty():
            return
        listed_at = clock() if clock is not None else None
        result = sync(latest_versions(rows), catalog, folder, partial, listed_at)
        if done is not None:
            done(epoch, result)

    return (
        listings.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
