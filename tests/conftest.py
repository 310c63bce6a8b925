"""A local session, and a bucket that is a folder with set modification times."""

import datetime
import gzip
import os
import pathlib
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).parent.parent))

from cases import minutes  # noqa: E402
from lakeloader import Settings, Sink, discover, list_objects, prepare, sync  # noqa: E402

@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


class Bucket:
    """Objects in a folder, a catalog, a sink, and a clock."""

    def __init__(self, spark, folder):
        self.spark = spark
        self.root = folder / "objects"
        self.root.mkdir()
        self.sink_folder = str(folder / "sink")
        self.now = minutes(24 * 60)
        self.catalog = None

    def put(self, key, data, modified=None):
        path = self.root / key
        path.parent.mkdir(parents=True, exist_ok=True)
        data = data.encode() if isinstance(data, str) else data
        path.write_bytes(gzip.compress(data) if key.endswith(".gz") and data[:2] != b"\x1f\x8b" else data)
        stamp = (modified or minutes(0)).timestamp()
        os.utime(path, (stamp, stamp))

    def put_raw(self, key, data, modified=None):
        path = self.root / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
        stamp = (modified or minutes(0)).timestamp()
        os.utime(path, (stamp, stamp))

    def remove(self, key):
        (self.root / key).unlink()

    def listing(self):
        return list_objects(self.spark, str(self.root), content_hash=True)

    def discover(self, **options):
        found = discover(self.listing(), **options)
        self.catalog = found.catalog
        return found

    def sync(self, catalog=None, state=None, **settings):
        if catalog is None:
            catalog = self.catalog or self.discover().catalog
        return sync(
            self.listing(), catalog, self.sink_folder, Settings(**settings), self.now, state
        )

    def rows(self, stream, *columns):
        """A stream's committed rows in read order."""
        entry = self.catalog.streams[stream]
        frame = Sink(self.spark, self.sink_folder).read(entry)
        order = [c for c in ("_s3_last_modified", "_s3_key", "_row_number", "_row_key") if c in frame.columns]
        frame = frame.orderBy(*order)
        if columns:
            frame = frame.select(*[F.col("`" + c.replace("`", "``") + "`") for c in columns])
        return [row.asDict() for row in frame.collect()]

    def data(self, stream):
        """A stream's rows without metadata columns."""
        names = [column.name for column in self.catalog.streams[stream].columns]
        return self.rows(stream, *names)

    def kinds(self, stream):
        return {column.name: column.kind for column in self.catalog.streams[stream].columns}

    def bookmark(self, stream):
        marks, _ = Sink(self.spark, self.sink_folder).load_state()
        row = marks.where(F.col("stream") == stream).first()
        return None if row is None or row.bookmark is None else row.bookmark.replace(tzinfo=datetime.timezone.utc)

    def window(self, stream):
        _, window = Sink(self.spark, self.sink_folder).load_state()
        return sorted(row.key for row in window.where(F.col("stream") == stream).collect())


@pytest.fixture
def bucket(spark, tmp_path):
    return Bucket(spark, tmp_path)
