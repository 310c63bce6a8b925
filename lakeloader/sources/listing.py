"""Listings: one row per object, as `key, path, last_modified, size, etag`."""

from __future__ import annotations

import contextlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def normalize_prefix(prefix: str | None) -> str:
    """Read a prefix as a folder: no leading slash, one trailing slash."""
    trimmed = (prefix or "").strip().lstrip("/")
    return trimmed if not trimmed or trimmed.endswith("/") else trimmed + "/"


# A path's scheme and host, to compare `file:/x` with `/x`.
_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(?://[^/]*)?(?=/)"


_IGNORE_LOCALITY = "spark.sql.sources.ignoreDataLocality"


@contextlib.contextmanager
def _places_left_out(spark: SparkSession) -> Iterator[None]:
    """List without the hosts of blocks, which would reach the driver for every object."""
    before = spark.conf.get(_IGNORE_LOCALITY)
    spark.conf.set(_IGNORE_LOCALITY, "true")
    try:
        yield
    finally:
        spark.conf.set(_IGNORE_LOCALITY, before)


def file_facts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files below paths, as `binaryFile` gives them. Listed now; each run looks at the files anew.

    A file that is gone by then is left out.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
    with _places_left_out(spark):
        return reader.load(paths)


def list_objects(
    spark: SparkSession, root: str, prefix: str | None = None, content_hash: bool = False
) -> DataFrame:
    """List every object below `root`, recursively, with keys relative to it.

    The tag is the modification time and the length, which any file system
    gives. `content_hash` reads the bytes and uses their MD5 instead. The time in
    `stored_at` lets a read notice objects that were overwritten since.
    """
    folder = normalize_prefix(prefix)
    base = root.rstrip("/")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    with _places_left_out(spark):
        files = reader.load(_escape_glob(f"{base}/{folder}".rstrip("/")))
    depth = len(re.sub(_SCHEME, "", base + "/"))
    tag = (
        F.md5("content")
        if content_hash
        else F.md5(F.concat_ws("-", F.unix_micros("modificationTime"), "length"))
    )
    return files.select(
        F.substring(F.regexp_replace("path", _SCHEME, ""), depth + 1, 1 << 30).alias("key"),
        "path",
        F.col("modificationTime").alias("last_modified"),
        F.col("length").alias("size"),
        tag.alias("etag"),
        F.col("modificationTime").alias("stored_at"),
    )


def _escape_glob(path: str) -> str:
    """Paths given to a reader are globs. Take every character as it is."""
    return "".join("\\" + char if char in "{}[]*?\\" else char for char in path)


def escape_paths(paths: list[str]) -> list[str]:
    """Escape a list of paths for a reader."""
    return [_escape_glob(path) for path in paths]
