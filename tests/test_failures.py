"""A bad or changed object costs only itself and what comes after it."""

import gzip
import json
import random

import pytest
from cases import minutes

from lakeloader import LoadError, ObjectChanged
from lakeloader.plans.read import Batch

ROWS = 12_000


def lines(first, count=ROWS):
    draw = random.Random(first)
    return "".join(json.dumps({"id": first + n, "v": draw.random()}) + "\n" for n in range(count))


def table(first, count=ROWS):
    draw = random.Random(first)
    return "id,v\n" + "".join(f"{first + n},{draw.random()}\n" for n in range(count))


def truncated(text):
    packed = gzip.compress(text.encode())
    return packed[: len(packed) - 4000]


@pytest.mark.parametrize("kind, made", [("jsonl", lines), ("csv", table)])
def test_a_truncated_object_keeps_the_ones_before_it(bucket, kind, made):
    for number in range(4):
        bucket.put(f"t/2026-01-0{number + 1}.{kind}.gz", made(number * 100_000, 50), minutes(number))
    bucket.discover()
    # Its name begins with the name of a good one.
    bucket.put_raw(f"t/2026-01-03.{kind}.gz", truncated(made(200_000)), minutes(2))
    bucket.put(f"t/2026-01-03.{kind}", made(500_000, 50), minutes(1))
    with pytest.raises(LoadError, match="2026-01-03"):
        bucket.sync()
    assert sorted({int(row["id"]) // 100_000 for row in bucket.rows("t")}) == [0, 1, 5]
    assert bucket.bookmark("t") == minutes(1)
    bucket.put(f"t/2026-01-03.{kind}.gz", made(200_000, 50), minutes(2))
    bucket.sync()
    assert sorted(row["id"] for row in bucket.rows("t")) == sorted(set(row["id"] for row in bucket.rows("t")))
    assert len(bucket.rows("t")) == 250


@pytest.mark.parametrize("moment", ["before", "while"])
def test_a_changed_object_keeps_the_ones_before_it(bucket, monkeypatch, moment):
    for number in range(5):
        bucket.put(f"t/2026-01-0{number + 1}.jsonl", lines(number * 100, 10), minutes(number))
    bucket.discover()
    collect, changed = Batch.collect, []

    def overwrite():
        if not changed:
            changed.append(1)
            bucket.put("t/2026-01-04.jsonl", lines(900, 11), minutes(50))

    def collected(*args, **options):
        if moment == "before":
            overwrite()
        batch = collect(*args, **options)
        if moment == "while":
            overwrite()
        return batch

    monkeypatch.setattr(Batch, "collect", staticmethod(collected))
    with pytest.raises(ObjectChanged, match="2026-01-04"):
        bucket.sync()
    assert sorted({row["id"] // 100 for row in bucket.rows("t")}) == [0, 1, 2]
    assert bucket.bookmark("t") == minutes(2)
    bucket.sync()
    assert sorted({row["id"] // 100 for row in bucket.rows("t")}) == [0, 1, 2, 4, 9]


def test_a_limit_that_is_full_stops_before_a_bad_object(bucket):
    for number in range(2):
        bucket.put(f"t/2026-01-0{number + 1}.jsonl.gz", lines(number * 100_000, 3), minutes(number))
    bucket.discover()
    bucket.put_raw("t/2026-01-03.jsonl.gz", truncated(lines(200_000)), minutes(2))
    bucket.sync(limits={"t": 5})
    assert [row["id"] for row in bucket.rows("t")] == [0, 1, 2, 100_000, 100_001]


def test_a_bad_object_within_the_limit_is_an_error(bucket):
    bucket.put("t/2026-01-01.jsonl.gz", lines(0, 3), minutes(0))
    bucket.discover()
    bucket.put_raw("t/2026-01-02.jsonl.gz", truncated(lines(200_000)), minutes(1))
    with pytest.raises(LoadError, match="2026-01-02"):
        bucket.sync(limits={"t": 5})
    assert [row["id"] for row in bucket.rows("t")] == [0, 1, 2]


@pytest.mark.parametrize("setting", [{"checkpoint_bytes": 1}, {"checkpoint_objects": 1, "checkpoint_seconds": 0}])
def test_batches_are_committed_by_size_and_time(bucket, setting):
    for number in range(3):
        bucket.put(f"t/2026-01-0{number + 1}.jsonl", lines(number * 100, 5), minutes(number))
    bucket.discover()
    assert bucket.sync(**setting).commits >= 3
