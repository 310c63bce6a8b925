"""Tasks follow bytes and cores, not the number of objects, splits or row groups; what tasks are told doesn't grow with them."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from cases import minutes
from pyspark import cloudpickle

from lakeloader import read_tables
from lakeloader.model import DELIMITED, JSON, JSONL, PARQUET
from lakeloader.operators.pieces import Record, Target, parts, piece_batches
from lakeloader.plans.read import Batch
from lakeloader.session import Shipped, prepare, spread_tasks
from lakeloader.sources.layout import build_layout
from lakeloader.sources.parquet import RowGroups
from lakeloader.sources.textscan import text_scan

MANY = 120


@pytest.fixture
def tiny_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "600")
    spark.conf.set(names[1], "10")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def batch_of(bucket):
    return Batch.collect(build_layout(bucket.listing()).manifest)


def test_listing_takes_no_task_per_path(spark):
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        assert int(prepare(spark).conf.get(name)) == spread_tasks(spark)
        spark.conf.set(name, "3")
        assert prepare(spark).conf.get(name) == "3"
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("end, kind, separator", [("csv", DELIMITED, "\n"), ("jsonl", JSONL, None), ("json", JSON, "}")])
def test_a_scan_of_many_splits_has_few_tasks(bucket, tiny_splits, end, kind, separator):
    rows = [f'{{"id": {n}, "v": "{"x" * 40}"}}' for n in range(4000)]
    body = {"csv": "id\n" + "\n".join(map(str, range(20_000))), "jsonl": "\n".join(rows), "json": f"[{','.join(rows)}]"}[end]
    bucket.put(f"t.{end}", body, minutes(1))
    objects = batch_of(bucket).of(kind)
    scan = text_scan(bucket.spark, objects, separator)
    assert scan.select("file", "block").distinct().count() > 2 * spread_tasks(bucket.spark)
    assert scan.rdd.getNumPartitions() <= spread_tasks(bucket.spark)
    bucket.discover()
    bucket.sync()
    assert [int(row["id"]) for row in bucket.rows("t")] == [row["_row_number"] - 1 for row in bucket.rows("t")]


class Numbers(Shipped):
    def __init__(self, count):
        self.numbers, self.own = {n: str(n) for n in range(count)}, None

    def look(self, batches):
        self.own = len(self.numbers)
        for batch in batches:
            yield pa.record_batch([pa.repeat(pa.scalar(self.own), batch.num_rows)], ["n"])

    def state(self):
        return {**vars(self), "own": "none yet"}


def test_what_tasks_are_told_comes_as_a_broadcast(spark):
    small, large = (len(cloudpickle.dumps(Numbers(count).look)) for count in (10, 100_000))
    assert large < small + 1000
    # By value, as workers can't import this module.
    cloudpickle.register_pickle_by_value(__import__(__name__))
    lane = Numbers(1000)
    found = spark.range(0, 50, 1, 20).mapInArrow(lambda batches: lane.look(batches), "n long")
    assert {row.n for row in found.collect()} == {1000}
    assert lane.own is None


def test_small_row_groups_share_tasks(bucket, spark):
    at = pa.array(range(MANY), pa.timestamp("ns"))
    sink = pa.BufferOutputStream()
    pq.write_table(pa.table({"id": list(range(MANY)), "at": at}), sink, row_group_size=1)
    bucket.put("t.parquet", sink.getvalue().to_pybytes(), minutes(1))
    batch = batch_of(bucket)
    batch.read_heads()
    (item,) = batch.of(PARQUET)
    head = batch.heads[item.obj]
    groups = RowGroups(spark, pa.ipc.read_schema(pa.py_buffer(bytes(head["schema"]))), [item], {item.obj: head["row_groups"]})
    assert len(groups.units) == MANY > spread_tasks(spark)
    rows = groups.rows(["id"], frozenset())
    assert rows.rdd.getNumPartitions() <= spread_tasks(spark)
    assert sorted(tuple(row) for row in rows.select("row", "rec.id").collect()) == [(n + 1, n) for n in range(MANY)]


def test_files_are_looked_at_anew_without_a_listing(bucket):
    for number in range(3):
        bucket.put(f"t{number}.csv", f"id\n{number}", minutes(number))
    batch = batch_of(bucket)
    assert batch.overwritten() == []
    bucket.put("t1.csv", "id\n1\n2", minutes(1))
    bucket.remove("t2.csv")
    assert [item.key for item in batch.overwritten()] == ["t1.csv", "t2.csv"]
    assert [item.key for item in batch.subset({0, 1}).overwritten()] == ["t1.csv"]


def test_only_lists_on_the_way_to_a_wanted_stream_are_opened():
    record = {"id": 1, "a": [{"x": 1, "b": [{"y": 1}]}], "c": [{"z": 1}, {"z": 2}]}
    a, b, c = (("a",),), (("a",), ("b",)), (("c",),)
    assert [part.lineage for part in parts(record, 1)] == [(), a, b, c, c]
    assert [part.lineage for part in parts(record, 1, frozenset({(), a}))] == [(), a]
    target = Target(2, (("z", "integer"), ("_parent__id", "integer")))
    (made,) = piece_batches(iter([Record(7, 1, record), Record(7, 2, None, "bad")]), {c: target})
    assert made.column("stream").to_pylist() == [2, 2, -1]
    assert [row and row["v0"] for row in made.column("s2").to_pylist()] == [1, 2, None]


def test_streams_without_a_stage_make_their_own_pieces_only(bucket):
    bucket.put("t.json", '{"n": 1, "rows": [{"id": 1, "l": [{"w": 1}, {"w": 2}]}, {"id": 2, "l": []}]}', minutes(1))
    found = bucket.discover()
    tables = read_tables(found.layout.manifest, found.catalog)
    assert sorted(row.id for row in tables.rows("t").collect()) == [1, 2]
    rows = tables.rows("t__l")
    assert sorted((row["_parent__id"], row["_index"], row.w) for row in rows.collect()) == [(1, 0, 1), (1, 1, 2)]
    assert "s0#" not in rows._jdf.queryExecution().executedPlan().toString()
