"""The commit log: claims, changes to the window, and how much a reader opens."""

import json

import pytest
from lakeloader import CommitConflict, Sink
from lakeloader.operators import incremental as inc
from lakeloader.plans import state as state_module
from lakeloader.plans.log import CommitLog
from lakeloader.session import local_frame

from cases import minutes


def marks_of(spark, **bookmarks):
    return local_frame(spark, [(s, "_s3_last_modified", b, True) for s, b in bookmarks.items()], inc.BOOKMARKS)


def changed(spark, *rows):
    return local_frame(spark, list(rows), inc.CHANGES)


def window_of(sink):
    return sorted((row.stream, row.key, row.etag) for row in sink.load_state()[1].collect())


def test_two_writers_cannot_both_commit(spark, tmp_path):
    first, second = Sink(spark, str(tmp_path)), Sink(spark, str(tmp_path))
    for sink in (first, second):
        sink.load_state()
    assert first.commit(marks_of(spark, a=minutes(1)), changed(spark), [("a", "x")]) == 1
    with pytest.raises(CommitConflict):
        second.commit(marks_of(spark, a=minutes(2)), changed(spark), [("a", "y")])
    assert [tuple(row) for row in second.runs().collect()] == [("a", "x")]
    second.load_state()
    assert second.commit(marks_of(spark, a=minutes(2)), changed(spark), [("a", "y")]) == 2
    assert sorted(row.folder for row in first.runs().collect()) == ["x", "y"]


@pytest.mark.parametrize("link", [True, False])
def test_a_claim_never_replaces_another(spark, tmp_path, link, monkeypatch):
    log = CommitLog(spark, str(tmp_path / "log"))
    if not link:
        # The way of all file systems but the local one.
        monkeypatch.setattr(log, "_moved", lambda source, target: log._renamed(log._path(source), log._path(target)))
    assert log.latest() is None
    log.claim(1, {"version": 1, "by": "first"})
    with pytest.raises(CommitConflict):
        log.claim(1, {"version": 1, "by": "second"})
    assert log.latest()["by"] == "first"
    assert not list((tmp_path / "log").glob("_claim*"))


@pytest.mark.parametrize("hint", ["2", "", "torn", "99", None])
def test_a_stale_hint_costs_nothing_but_time(spark, tmp_path, hint):
    log = CommitLog(spark, str(tmp_path))
    for version in range(1, 6):
        log.claim(version, {"version": version})
    (tmp_path / ".last.crc").unlink(missing_ok=True)
    (tmp_path / "last").unlink()
    if hint is not None:
        (tmp_path / "last").write_text(hint)
    assert log.latest()["version"] == 5


def test_ten_thousand_commits_are_not_listed(spark, tmp_path, monkeypatch):
    for version in range(1, 10_001):
        (tmp_path / f"{version:020d}.json").write_text(json.dumps({"version": version}))
    (tmp_path / "last").write_text("9998")
    log = CommitLog(spark, str(tmp_path))
    monkeypatch.setattr(log, "_listed", lambda: pytest.fail("listed the log"))
    assert log.latest()["version"] == 10_000


def test_windows_and_folders_are_merged_now_and_then(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state_module, "MERGE_EVERY", 3)
    sink, held, bookmark = Sink(spark, str(tmp_path)), {}, None
    sink.load_state()
    for step in range(8):
        rows = [("a", f"k{n}", f"e{step}", minutes(10 * n + step), False) for n in range(step % 3, step + 2, 2)]
        if step == 5:
            rows = [("a", "k4", "e0", None, True)]
        for _, key, etag, time, gone in rows:
            held[key] = (etag, time, gone)
        bookmark = minutes(8 * step)
        sink.commit(marks_of(spark, a=bookmark), changed(spark, *rows), [("a", f"run{step}")])
        wanted = sorted(("a", k, e) for k, (e, time, gone) in held.items() if not gone and time > bookmark)
        # What the bookmark has passed is gone for good, as bookmarks never move back.
        held = {key: entry for key, entry in held.items() if not entry[2] and entry[1] > bookmark}
        fresh = Sink(spark, str(tmp_path))
        assert window_of(fresh) == wanted
        assert sorted(row.folder for row in fresh.runs().collect()) == [f"run{n}" for n in range(step + 1)]
        entry = fresh._log.latest()
        assert len(entry["window"]) <= 4 and len(entry["runs"]) <= 4


def test_a_commit_writes_what_it_read(bucket):
    for number in range(6):
        bucket.put(f"orders/{number}.csv", f"id\n{number}\n", minutes(24 * 60 - 10 + number))
    bucket.discover()
    bucket.sync()
    assert len(bucket.window("orders")) == 6
    bucket.put("orders/new.csv", "id\n7\n", minutes(24 * 60 - 1))
    bucket.sync()
    entry = Sink(bucket.spark, bucket.sink_folder)._log.latest()
    last = bucket.spark.read.parquet(f"{bucket.sink_folder}/{entry['window'][-1]}")
    assert [row.key for row in last.collect()] == ["orders/new.csv"]
    assert len(bucket.window("orders")) == 7
    # Time moves on: the window empties without a row written for its entries.
    bucket.now = minutes(24 * 60 + 90)
    bucket.sync()
    assert bucket.window("orders") == [] and bucket.sync().objects_read == 0


def test_an_object_that_comes_back_is_read_again(bucket):
    bucket.put("orders/a.csv", "id\n1\n", minutes(24 * 60 - 5))
    bucket.put("orders/b.csv", "id\n2\n", minutes(24 * 60 - 4))
    bucket.discover()
    bucket.sync()
    bucket.remove("orders/b.csv")
    assert bucket.sync().objects_read == 0
    assert bucket.window("orders") == ["orders/a.csv"]
    bucket.put("orders/b.csv", "id\n2\n", minutes(24 * 60 - 4))
    assert bucket.sync().objects_read == 1


def test_reports_are_bounded_and_the_rest_can_be_asked_for(bucket):
    bucket.put("a.jsonl", '{"id": 1}\n', minutes(1))
    bucket.discover()
    keys = [f"k{n:03d}" for n in range(250)]
    bucket.put("a.jsonl", "".join(json.dumps({"id": n, key: n}) + "\n" for n, key in enumerate(keys)), minutes(2))
    result = bucket.sync()
    assert result.dropped["a"] == set(keys[:100]) and result.more_notes == {"a"}
    notes = result.sink.notes(bucket.catalog.streams["a"])
    assert sorted(row.note.partition(":")[2] for row in notes.collect()) == keys
