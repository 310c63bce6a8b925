"""Layout: from a listing to streams (tables), with DataFrame expressions only.

An object inside a folder belongs to the stream named after its top-level
folder. An object at the prefix root belongs to the stream named after its
file stem without trailing date, time and number tokens.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloader.model import KIND_BY_EXTENSION, MAX_REPORTED_KEYS
from lakeloader.session import written
from lakeloader.sources.listing import normalize_prefix

# What counts as a trailing token of a file stem.
_TRAILING_TOKEN = (
    r"(?iU)(?:[-_. ]+(?:"
    r"\d{4}-?\d{2}-?\d{2}"
    r"(?:[T_ -]?\d{2}(?:[:.-]?\d{2}){1,2}(?:\.\d+)?)?"
    r"(?:Z|[+-]\d{2}:?\d{2})?"
    r"|\d+)|\s*\(\d+\))\z"
)
_LETTER = r"[\p{L}\p{Nl}\p{No}]"
_FILE_NAME = rf"(?is)^(.+)\.({'|'.join(KIND_BY_EXTENSION)})(\.gz)?\z"


def is_hidden(relative: Column) -> Column:
    """Any path segment starts with `.` or `_`."""
    return relative.rlike(r"(?:^|/)[._]")


def file_stem(name: Column) -> Column:
    """The file name without extension, or an empty string when unsupported."""
    return F.regexp_extract(name, _FILE_NAME, 1)


def file_extension(name: Column) -> Column:
    """The lower-case extension, or an empty string when unsupported."""
    return F.lower(F.regexp_extract(name, _FILE_NAME, 2))


def strip_trailing_tokens(stem: Column) -> Column:
    """Remove trailing tokens one by one, while a letter is left.

    A token has at least two characters, so half the length of the stem is
    always enough steps.
    """

    def step(text: Column, _: Column) -> Column:
        shorter = F.regexp_replace(text, _TRAILING_TOKEN, "")
        return F.when(shorter.rlike(_LETTER), shorter).otherwise(text)

    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.length(stem) / 2).cast("int")))
    return F.when(
        stem.rlike(_TRAILING_TOKEN) & stem.rlike(_LETTER), F.aggregate(steps, stem, step)
    ).otherwise(stem)


def sanitize_name(name: Column) -> Column:
    """Replace runs outside `[A-Za-z0-9_]` with `_` and trim `_`."""
    return F.btrim(F.regexp_replace(name, "[^A-Za-z0-9_]+", "_"), F.lit("_"))


def raw_stream_name(relative: Column, stem: Column) -> Column:
    """The top-level folder, or the stem without trailing tokens."""
    return F.when(
        F.contains(relative, F.lit("/")), F.substring_index(relative, "/", 1)
    ).otherwise(strip_trailing_tokens(stem))


@dataclass(frozen=True)
class Layout:
    """The objects of every stream, and the keys no stream can use."""

    manifest: DataFrame
    rejected: DataFrame

    def merged_names(self) -> DataFrame:
        """Streams that merge differently named folders or files."""
        # Distinct names first: a stream with many objects shuffles few rows.
        return (
            self.manifest.select("stream", "raw_name")
            .distinct()
            .groupBy("stream")
            .agg(F.sort_array(F.collect_list("raw_name")).alias("raw_names"))
            .where(F.size("raw_names") > 1)
        )

    def rejected_report(self) -> tuple[list[str], int]:
        """The first rejected keys, and how many more there are."""
        shown = [row.key for row in self.rejected.orderBy("key").limit(MAX_REPORTED_KEYS).collect()]
        return shown, self.rejected.count() - len(shown)


def build_layout(listing: DataFrame, prefix: str | None = None, exclude: str | None = None) -> Layout:
    """Sort a listing's objects into streams.

    `exclude` is a regular expression searched in the key below the prefix.
    """
    if exclude:
        check_exclude(listing, exclude)
    folder = normalize_prefix(prefix)
    relative = F.substring("key", len(folder) + 1, 1 << 30)
    named = (
        listing.where(F.startswith("key", F.lit(folder)) & (F.coalesce("size", F.lit(0)) > 0))
        .withColumn("relative", relative)
        .where((F.col("relative") != "") & ~F.endswith("relative", F.lit("/")))
        .where(~is_hidden(F.col("relative")))
    )
    if exclude:
        named = named.where(~F.col("relative").rlike(exclude))
    file_name = F.substring_index("relative", "/", -1)
    named = named.withColumn("extension", file_extension(file_name)).withColumn(
        "raw_name",
        F.when(
            F.col("extension") != "", raw_stream_name(F.col("relative"), file_stem(file_name))
        ).otherwise(""),
    )
    named = named.withColumn("stream", sanitize_name(F.col("raw_name")))
    usable = (F.col("extension") != "") & (F.col("stream") != "")
    kinds = F.create_map(*[F.lit(x) for pair in KIND_BY_EXTENSION.items() for x in pair])
    manifest = named.where(usable).select(
        "stream",
        "raw_name",
        "key",
        "path",
        "last_modified",
        "size",
        F.coalesce("etag", F.lit("")).alias("etag"),
        F.element_at(kinds, F.col("extension")).alias("kind"),
        "extension",
        F.endswith(F.lower("key"), F.lit(".gz")).alias("compressed"),
        *(["stored_at"] if "stored_at" in listing.columns else []),
    )
    rejected = named.where(~usable).select(
        "key",
        F.when(F.col("extension") == "", "unsupported type").otherwise("unusable name").alias("reason"),
    )
    return Layout(manifest, rejected)


def excluded_count(listing: DataFrame, prefix: str | None, exclude: str) -> int:
    """How many objects a pattern leaves out."""
    kept = build_layout(listing, prefix, exclude)
    every = build_layout(listing, prefix)
    return (
        every.manifest.count() + every.rejected.count()
        - kept.manifest.count() - kept.rejected.count()
    )


def check_exclude(listing: DataFrame, pattern: str) -> None:
    """Fail on a bad pattern before any object is read."""
    try:
        re.compile(pattern)
        listing.sparkSession.range(1).select(F.lit("").rlike(pattern)).collect()
    except Exception as err:
        raise ValueError(f"the exclude pattern is not a valid regex: {pattern!r}") from err


def read_order(manifest: DataFrame) -> DataFrame:
    """Add `rank`, the object's place in its stream by (last_modified, key), and
    `bytes_before`, the bytes of the objects before it.

    A stream may hold most objects, so no stream is sorted in one task: the
    objects are range-partitioned, counted per partition and stream, and
    numbered inside each partition from the counts of the earlier ones.
    """
    order = ["stream", "last_modified", "key"]
    # The range bounds come from a sample, so both passes must see the same split.
    ranged = written(
        manifest.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    )
    counts = ranged.groupBy("stream", "_part").agg(
        F.count("*").alias("_n"), F.sum("size").alias("_bytes")
    )
    before = Window.partitionBy("stream").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per stream and partition.
    offsets = counts.select(
        "stream",
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
    )
    inside = Window.partitionBy("stream", "_part").orderBy("last_modified", "key")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn("_local", F.row_number().over(inside))
        .withColumn("_local_bytes", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        .join(offsets, ["stream", "_part"])
        .withColumn("rank", F.col("_first") + F.col("_local"))
        .withColumn("bytes_before", F.col("_bytes_before") + F.col("_local_bytes"))
        .drop("_part", "_first", "_bytes_before", "_local", "_local_bytes")
    )


def newest(manifest: DataFrame, count: int) -> DataFrame:
    """The newest `count` objects of every stream, with `newest_rank` from 1.

    Spark cuts each stream to `count` rows before the shuffle, so a stream
    with most of the objects costs no more than a small one.
    """
    latest = Window.partitionBy("stream").orderBy(F.desc("last_modified"), F.desc("key"))
    return manifest.withColumn("newest_rank", F.row_number().over(latest)).where(
        F.col("newest_rank") <= count
    )
