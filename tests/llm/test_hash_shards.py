"""Extendible-hash shards against their SQL and their rules."""

import duckdb
import pytest

from lakeloader.llm import hash_shards as H
from llm_cases import awkward, rows_of


@pytest.mark.parametrize("limit", [1 << 24, 20_000, 3000, 1])
def test_same_as_sql(spark, small_tables, limit):
    found = rows_of(H.assign(spark.read.parquet(f"{small_tables}/documents.parquet"), limit))
    known = duckdb.connect().sql(H.oracle(limit, f"'{small_tables}/documents.parquet'")).fetchall()
    assert found == sorted(known, key=repr)


@pytest.mark.parametrize("limit", [1 << 24, 5000, 100])
def test_awkward_rows(documents, limit, monkeypatch):
    """Equal keys, too, end in shards that fit, unless a row alone is too large."""
    made = H.assign(documents, limit).collect()
    assert sorted((r.doc_id, r.bytes) for r in made if r.doc_id is not None) == sorted(
        (x[0], len((x[1] or "").encode())) for x in awkward() if x[0] is not None
    )
    assert len(made) == len(awkward())
    sums, names = {}, {r.shard for r in made}
    for r in made:
        held = sums.setdefault((r.shard, r.depth, r.shard_bytes, r.shard_docs), [0, 0])
        held[0] += r.bytes
        held[1] += 1
    for (shard, depth, total, docs), held in sums.items():
        assert [total, docs] == held and depth == len(shard)
        assert total <= limit or docs == 1
        # Only buckets that don't fit are split: no shard lies within another one.
        assert not any(other != shard and other.startswith(shard) for other in names)


def test_a_bucket_splits_only_if_it_must(spark):
    rows = [(i, "x" * 10) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    shards = {r.shard: r.shard_bytes for r in H.directory(H.assign(frame, 100)).collect()}
    for shard in shards:
        sibling = shard[:-1] + "10"[int(shard[-1])]
        within = sum(n for other, n in shards.items() if other.startswith(sibling))
        assert shards[shard] + within > 100


def test_empty_table_and_writing(spark, no_documents, tmp_path):
    assert H.assign(no_documents).count() == 0
    frame = spark.createDataFrame([(i, "x" * 50) for i in range(40)], "doc_id long, text string")
    H.write_shards(frame, H.assign(frame, 400), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert rows_of(back, "doc_id", "text") == rows_of(frame)
    assert len(list((tmp_path / "shards").glob("shard=s*"))) >= 5


@pytest.mark.parametrize("limit", [1 << 24, 5000, 100])
def test_every_row_is_written_once(documents, no_documents, limit, tmp_path):
    """Repeated rows and null ids, too; what is read back are the rows of the assignment."""
    back = H.shard_documents(documents, str(tmp_path / "shards"), limit)
    assert back.columns[:-1] == documents.columns
    names = [f"c{i}" for i in range(len(documents.columns))]
    assert rows_of(back.toDF(*names, "last"), *names) == rows_of(documents.toDF(*names))
    read = H.read_assignment(back).collect()
    assert sorted(repr((r.doc_id, r.bytes)) for r in read) == sorted(repr((x[0], len((x[1] or "").encode()))) for x in awkward())
    assert all(r.shard_bytes <= limit or r.shard_docs == 1 for r in read)
    assert H.read_assignment(H.shard_documents(no_documents, str(tmp_path / "none"), limit)).count() == 0


def test_assignments_by_id_refuse_repeated_ids(documents, tmp_path):
    with pytest.raises(ValueError, match="share an id"):
        H.write_shards(documents, H.assign(documents), str(tmp_path / "shards"))


def test_query_reads_written_shards(spark, small_tables, tmp_path):
    back = H.shard_documents(spark.read.parquet(f"{small_tables}/documents.parquet"), str(tmp_path / "shards"), 20_000)
    known = duckdb.connect().sql(H.oracle(20_000, f"'{small_tables}/documents.parquet'")).fetchall()
    assert rows_of(H.read_assignment(back)) == sorted(known, key=repr)


def test_writing_tasks_grow_with_the_bytes(spark, documents):
    """Not with the session's partitions; small tables still use every core."""
    cores = spark.sparkContext.defaultParallelism
    assert H._tasks(documents, 0) == 4 * cores
    assert H._tasks(documents, 30 << 30) == max(240, 4 * cores)
    assert H._tasks(documents, (100 << 40) + 1) == 819_201
