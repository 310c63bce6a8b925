"""The state step as joins, against a loop over objects, on random cases."""

import datetime
import random

from lakeloader.operators import incremental as inc
from pyspark.sql import functions as F

BASE = datetime.datetime(2026, 9, 1, 12)


def at(minute):
    return BASE + datetime.timedelta(minutes=minute)


def loop(objects, bookmark, window, has_window, replication_key, start, full, first_date, failing):
    """What a reader does that takes the objects one by one."""
    if replication_key not in (None, "_s3_last_modified"):
        bookmark = None
    if not has_window:
        window = {}
        if bookmark is not None and bookmark > start:
            bookmark = start
    window = dict(window)
    listed = sorted((when, key, tag) for key, (when, tag) in objects.items())
    todo = [item for item in listed if first_date is None or item[0] >= first_date]
    read, failed = [], False
    for place, (when, key, tag) in enumerate(todo):
        if not full and ((bookmark is not None and when <= bookmark) or window.get(key) == tag):
            continue
        if key == failing:
            failed = True
            break
        read.append(key)
        window[key] = tag
        if place + 1 == len(todo) or todo[place + 1][0] != when:
            reached = min(when, start)
            bookmark = reached if bookmark is None else max(bookmark, reached)
    if not failed:
        bookmark = start if bookmark is None else max(bookmark, start)
    if bookmark is not None:
        window = {k: t for k, t in window.items() if k in objects and objects[k][0] > bookmark}
    return read, bookmark, window


def test_the_step_agrees_with_a_loop(spark):
    rng = random.Random(11)
    cases, listing, marks, windows, members, failing = {}, [], [], [], [], []
    start, first = at(10), {}
    for number in range(300):
        name = f"s{number}"
        keys = [f"k{n}" for n in range(rng.randint(0, 7))]
        objects = {key: (at(rng.randint(0, 14)), rng.choice("ab")) for key in keys}
        bookmark = rng.choice([None, at(rng.randint(0, 14))])
        has_window = rng.random() < 0.8
        window = {k: rng.choice("ab") for k in [*keys, "gone"] if rng.random() < 0.4} if has_window else {}
        key = rng.choice([None, "_s3_last_modified", "updated_at"]) if bookmark is not None else None
        full, fails = rng.random() < 0.2, rng.choice([None, *keys])
        cases[name] = (objects, bookmark, window, has_window, key, full, fails)
        listing += [(name, k, when, tag) for k, (when, tag) in objects.items()]
        if bookmark is not None or has_window:
            marks.append((name, key, bookmark, has_window))
        else:
            cases[name] = (objects, bookmark, window, True, key, full, fails)
        windows += [(name, k, tag, None) for k, tag in window.items()]
        members.append((name, name, not full))
        failing.append((name, fails))
    manifest = spark.createDataFrame(listing, "stream string, key string, last_modified timestamp, etag string")
    bookmarks = spark.createDataFrame(marks, inc.BOOKMARKS)
    window = spark.createDataFrame(windows, inc.WINDOW)
    begin = F.lit(start)
    for first_date in (None, at(5)):
        readable = inc.objects_to_read(manifest, first_date)
        expected, rows = {}, []
        for name, (objects, bookmark, held, has_window, key, full, fails) in cases.items():
            expected[name] = loop(objects, bookmark, held, has_window, key, start, full, first_date, fails)
        wanted = inc.targets(
            readable, spark.createDataFrame([(*m, False) for m in members], inc.MEMBERS), bookmarks, window, begin
        ).collect()
        by_stream = {}
        for row in wanted:
            by_stream.setdefault(row.stream, []).append((row.last_modified, row.key, row.etag))
        complete = {}
        for name, (*_, fails) in cases.items():
            mine = sorted(by_stream.get(name, []))
            stop = next((n for n, item in enumerate(mine) if item[1] == fails), None)
            complete[name] = stop is None
            done = mine[:stop] if stop is not None else mine
            assert [key for _, key, _ in done] == expected[name][0]
            rows += [(name, key, tag, when) for when, key, tag in done]
        finished = spark.createDataFrame(rows, inc.WINDOW)
        after = spark.createDataFrame([(*m, complete[m[1]]) for m in members], inc.MEMBERS)
        moved = inc.next_bookmarks(readable, after, finished, bookmarks, begin)
        kept = inc.next_window(after, finished, moved, inc.refresh_window(window, manifest, after))
        found = {name: {} for name in cases}
        for row in kept.collect():
            found[row.stream][row.key] = row.etag
        # The same, stored as changes.
        changes = inc.window_changes(after, finished, moved, inc.window_times(window, manifest, after))
        stored = window.select("*", F.lit(False).alias("gone"), F.lit(0).alias("version"))
        again = inc.window_at(stored.unionByName(changes.withColumn("version", F.lit(1))), moved)
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, kept.collect()))
        for row in moved.collect():
            own = row.bookmark if row.replication_key == "_s3_last_modified" else None
            assert own == expected[row.stream][1], row.stream
        for name in cases:
            assert found[name] == expected[name][2], name
