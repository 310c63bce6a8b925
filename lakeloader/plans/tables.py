"""Streams as plain DataFrames, without a sink: read once, query, register as views."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloader.model import KEY
from lakeloader.plans.catalog import Catalog
from lakeloader.plans.read import ERROR, INTERNAL, ROW, Batch, GroupRows
from lakeloader.plans.sync import limit_rows
from lakeloader.session import prepare


@dataclass
class Tables:
    """The rows of every selected stream of some objects."""

    raw: dict[str, DataFrame]

    def rows(self, stream: str) -> DataFrame:
        """A stream's rows. Running it fails at the first row that can't be read."""
        raw = self.raw[stream]
        message = F.concat(F.col(KEY), F.lit(" row "), F.col(ROW).cast("string"), F.lit(": "), F.col(ERROR))
        good = F.when(F.col(ERROR).isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True)
        return raw.where(good).drop(*INTERNAL)

    def good_rows(self, stream: str) -> DataFrame:
        """A stream's rows without the ones that can't be read."""
        return self.raw[stream].where(F.col(ERROR).isNull()).drop(*INTERNAL)

    def errors(self, stream: str) -> DataFrame:
        """The rows that can't be read or converted, and why."""
        return self.raw[stream].where(F.col(ERROR).isNotNull()).select(
            KEY, F.col(ROW).alias("row"), F.col(ERROR).alias("error")
        )

    def register(self) -> None:
        """Make every stream a temporary view."""
        for name in self.raw:
            self.rows(name).createOrReplaceTempView(name)


def read_tables(
    manifest: DataFrame, catalog: Catalog, limits: dict[str, int] | None = None, stage: bool = False
) -> Tables:
    """The streams of a manifest's objects, as one batch.

    For more objects than a driver should list at once, use `sync`.
    """
    prepare(manifest.sparkSession)
    present = [row.stream for row in manifest.select("stream").distinct().collect()]
    groups, _ = catalog.link(present)
    raw: dict[str, DataFrame] = {}
    for group in groups:
        active = group.active()
        if not active:
            continue
        batch = Batch.collect(manifest.where(F.col("stream") == group.root))
        rows = GroupRows(batch, group, active, stage)
        for lineage, stream in active.items():
            raw[stream.name] = limit_rows(rows.rows(lineage), stream, (limits or {}).get(stream.name))
    return Tables(raw)
