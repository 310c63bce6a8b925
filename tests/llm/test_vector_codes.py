"""Vector codes against plain rounds that compare every part with every entry."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloader.llm import vector_codes as V

from llm_cases import rows_of

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, parts=4, entries=256, rounds=4):
    whole = lambda row: [math.floor(1024 * float(np.float32(x))) for x in row[1]]
    finite = [row for row in rows if row[1] and all(x is not None and math.isfinite(np.float32(x)) for x in row[1])]
    finite.sort(key=lambda row: (row[0] is None, row[0] or 0, [float(np.float32(x)) for x in row[1]]))
    length = len(finite[0][1]) if finite else 0
    kept = [row for row in finite if len(row[1]) == length and length % parts == 0]
    width = length // parts
    data = [[whole(row)[i * width : (i + 1) * width] for i in range(parts)] for row in kept]
    books = [[list(vector[i]) for vector in data[:entries]] for i in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda part, book: min((apart(part, entry), i) for i, entry in enumerate(book))
    for _ in range(rounds):
        for i, book in enumerate(books):
            chosen = [nearest(vector[i], book)[1] for vector in data]
            for entry in set(chosen):
                of = [vector[i] for vector, x in zip(data, chosen) if x == entry]
                book[entry] = [sum(column) // len(of) for column in zip(*of)]
    found = [[nearest(vector[i], books[i]) for i in range(parts)] for vector in data]
    errors = [sum(distance for distance, _ in row) for row in found]
    labels = {}
    for row, error in zip(kept, errors):
        labels[row[2]] = labels.get(row[2], 0) + error
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    made = [
        (row[0], "".join(f"{entry:02x}" for _, entry in codes), error, labels[row[2]], digest)
        for row, codes, error in zip(kept, found, errors)
    ]
    return sorted(made, key=repr)


COLUMNS = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


def vectors(count, length=8, seed=3):
    draw = random.Random(seed)
    centers = [[draw.uniform(-1, 1) for _ in range(length)] for _ in range(9)]
    return [(i, [x + draw.gauss(0, 0.02) for x in draw.choice(centers)], draw.choice([1, 2, None])) for i in range(count)]


def awkward():
    rows = vectors(60)
    rows += [rows[3], rows[3], (7, rows[9][1], 5), (None, rows[2][1], None), (None, rows[5][1], 1)]
    rows += [(100, None, 1), (101, [], 1), (102, [0.1] * 7 + [None], 1), (103, [float("nan")] + [0.0] * 7, 1)]
    rows += [(104, [float("inf")] * 8, 1), (105, [float("-inf")] + [0.0] * 7, 2), (106, [0.5] * 4, 1), (107, [0.5] * 9, 1)]
    return rows + [(200 + i, [0.25] * 8, 3) for i in range(30)] + [(300, [-0.0004882812] * 8, 3), (301, [0.0] * 8, None)]


def frame_of(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    for name in ("id", "vector", "codes", "error", "`a.b`", "part"):
        frame = frame.withColumn(name.strip("`"), F.lit("x"))
    return frame


@pytest.mark.parametrize("entries", [1, 2, 16, 256])
def test_awkward_rows(spark, entries):
    made = V.summary(frame_of(spark, awkward()), entries=entries)
    assert rows_of(made, *COLUMNS) == expected(awkward(), entries=entries)


def test_many_small_trees(spark, monkeypatch):
    monkeypatch.setattr(V, "TREE_ROWS", 7)
    monkeypatch.setattr(V, "LEAF_ROWS", 2)
    rows = vectors(120, seed=8)
    assert rows_of(V.summary(frame_of(spark, rows), entries=12), *COLUMNS) == expected(rows, entries=12)


def test_no_rows(spark):
    for rows in ([], [(1, None, 1)], [(1, [0.5] * 6, 1)]):
        assert V.summary(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_components_beyond_exact_distances_are_an_error(spark):
    rows = [(1, [1e9] * 8, 1), (2, [0.0] * 8, 1)]
    with pytest.raises(Exception, match="too large"):
        V.summary(spark.createDataFrame(rows, SCHEMA)).collect()


def test_large_components_are_exact(spark):
    draw = random.Random(4)
    rows = [(i, [draw.uniform(-1e5, 1e5) for _ in range(4)], 1) for i in range(40)]
    assert rows_of(V.summary(frame_of(spark, rows), entries=5), *COLUMNS) == expected(rows, entries=5)


@pytest.mark.parametrize("seed", range(4))
def test_trees_cover_and_give_whole_subtrees(seed):
    points = np.floor(np.array([x for _, x, _ in vectors(300, 4, seed)]) * 1024).astype(np.int64)
    order, nodes = V.cover_tree(points, 0)
    assert sorted(order.tolist()) == list(range(300))
    sorted_points = points[order]
    for i, node in enumerate(nodes):
        own = sorted_points[node["low"] : node["high"]]
        far = np.sqrt(((own - own[0]) ** 2).sum(1).max())
        assert node["radius"] == pytest.approx(far)
        children = nodes[nodes["parent"] == i]
        if len(children):
            assert sum(children["high"] - children["low"]) == len(own)
            tops = sorted_points[children["low"]]
            away = np.sqrt(V.distances(tops, tops))
            assert (away[~np.eye(len(tops), dtype=bool)] > node["radius"] / 2).all()
    book = points[:20]
    given = np.full(300, -1)
    whole = 0
    for low, high, entry in V._assigned(sorted_points, nodes, book):
        for a, b, x in zip(low, high, entry):
            assert (given[a:b] == -1).all()
            given[a:b] = x
            whole += b - a > 1
    assert (given == V.distances(sorted_points, book).argmin(axis=1)).all()
    assert whole > 0
