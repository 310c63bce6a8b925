"""Vector code compression: Lloyd's rounds over partition-local cover trees.

Vectors become whole numbers and are cut into equal parts; every part has a codebook.
Each task builds cover trees over blocks of its vectors once, one tree per part. A node
is a vector that covers its subtree within a radius, its children lie further apart than
half of it, and a subtree is a run of the tree's order, so that its sum is a difference
of cumulative sums. In a round a node whose nearest entry is nearer than the second one
by more than two radii gives its whole subtree to that entry, by the triangle inequality.
Other nodes hand on to their children, and leaves compare their vectors with all entries.

Only sums per entry leave the tasks, and codebooks, whose size is fixed by parameters,
go through the driver. Squared distances are exact: products of whole numbers in double
precision while they stay below 2^53, else in 64-bit numbers; components too large for
those (by the number of components in a part, about 2^28) are an error.

Defined results: rows whose vector is null, empty or holds nulls or numbers that are not
finite are dropped, and so are vectors of another length than that of the kept row with
the smallest id, or of a length that the parts don't divide; null ids come last, rows
that share an id are ordered by their vectors; fewer rows than entries make smaller
codebooks; an entry no part is nearest to stays; no rows give no rows; other columns of
the input play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloader.llm.base import Steps, column, in_tasks, slices

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Vectors of one tree, and of a leaf at most.
TREE_ROWS, LEAF_ROWS = 1024, 8
NODE = np.dtype([("part", "<i4"), ("parent", "<i4"), ("low", "<i4"), ("high", "<i4"), ("radius", "<f8"), ("leaf", "?")])
TREES = "ids array<long>, labels array<string>, data binary, orders binary, nodes binary"


def whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of each component."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    if scaled.size and np.abs(scaled).max() >= 2.0**30:
        raise ValueError("a component is too large for exact distances")
    return scaled.astype(np.int64)


def distances(vectors: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all vectors to all entries, as whole numbers."""
    most = int(max(np.abs(vectors).max(initial=0), np.abs(entries).max(initial=0)))
    width = vectors.shape[1]
    if 4 * width * most * most < 1 << 53:
        a, b = vectors.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    if 4 * width * most * most >= 1 << 63:
        raise ValueError("a component is too large for exact distances")
    made = np.zeros((len(vectors), len(entries)), np.int64)
    for at in range(width):
        apart = vectors[:, at][:, None] - entries[:, at][None, :]
        made += apart * apart
    return made


def cover_tree(points: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the points and the nodes; parents come before their children."""
    order = np.arange(len(points))
    nodes: list[tuple] = []
    # A node's points stand from `low` to `high`, its center first.
    waiting = [(-1, 0, len(points))] if len(points) else []
    while waiting:
        parent, low, high = waiting.pop()
        own = order[low:high]
        far = distances(points[own], points[own[:1]])[:, 0]
        radius, number = int(far.max()), len(nodes)
        leaf = radius > 0 and high - low <= LEAF_ROWS
        nodes.append((part, parent, low, high, np.sqrt(float(radius)), leaf))
        if leaf or radius == 0:
            continue
        groups, rest, away = [], own, far
        while True:
            near = 4 * away <= radius
            groups.append(rest[near])
            rest = rest[~near]
            if not len(rest):
                break
            away = distances(points[rest], points[rest[:1]])[:, 0]
        at = low
        for group in groups:
            order[at : at + len(group)] = group
            waiting.append((number, at, at + len(group)))
            at += len(group)
    return order, np.array(nodes, NODE)


def _assigned(points: np.ndarray, nodes: np.ndarray, codebook: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of a tree's order as `low, high, entry`: subtrees as a whole, then vectors one by one."""
    alive = np.flatnonzero(nodes["parent"] < 0)
    kids = np.argsort(nodes["parent"], kind="stable")
    first = np.searchsorted(nodes["parent"][kids], np.arange(len(nodes) + 1))
    while len(alive):
        here = nodes[alive]
        away = distances(points[here["low"]], codebook)
        entry = away.argmin(axis=1)
        if away.shape[1] > 1:
            two = np.sqrt(np.partition(away, 1, axis=1)[:, :2].astype(np.float64))
            # Equal distances go on; a little more than two radii covers rounding.
            clear = two[:, 1] - two[:, 0] > 2 * here["radius"] * (1 + 1e-9) + 1e-6
        else:
            clear = np.ones(len(here), bool)
        clear |= here["radius"] == 0
        yield here["low"][clear], here["high"][clear], entry[clear]
        leaves = here[~clear & here["leaf"]]
        if len(leaves):
            rows = np.concatenate([np.arange(a, b) for a, b in zip(leaves["low"], leaves["high"])])
            yield rows, rows + 1, distances(points[rows], codebook).argmin(axis=1)
        going = alive[~clear & ~here["leaf"]]
        alive = np.concatenate([kids[first[i] : first[i + 1]] for i in going]) if len(going) else going


def build_trees(rows: DataFrame, length: int, parts: int = PARTS) -> DataFrame:
    """`id, label, vector` rows as blocks of vectors with a cover tree per part."""

    def block(ids: list, labels: list, data: np.ndarray) -> pa.RecordBatch:
        made = [cover_tree(part, i) for i, part in enumerate(np.split(data, parts, axis=1))]
        cells = [ids, labels, data.astype("<i4").tobytes(), np.concatenate([x for x, _ in made]).astype("<i4").tobytes(),
                 np.concatenate([x for _, x in made]).tobytes()]
        kinds = (pa.list_(pa.int64()), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary())
        names = [field.split()[0] for field in TREES.split(", ")]
        return pa.record_batch([pa.array([x], kind) for x, kind in zip(cells, kinds)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        labels: list = []
        data = np.zeros((0, length), np.int64)
        for batch in slices(batches, TREE_ROWS):
            ids += batch.column("id").to_pylist()
            labels += batch.column("label").to_pylist()
            vectors = batch.column("vector")
            data = np.concatenate((data, whole(vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, length))))
            while len(ids) >= TREE_ROWS:
                yield block(ids[:TREE_ROWS], labels[:TREE_ROWS], data[:TREE_ROWS])
                ids, labels, data = ids[TREE_ROWS:], labels[TREE_ROWS:], data[TREE_ROWS:]
        if ids:
            yield block(ids, labels, data)

    return in_tasks(rows, work, TREES)


def _blocks(batches: Iterator[pa.RecordBatch], length: int, parts: int):
    """Of each block its row and, per part, the order, the vectors in that order and the nodes."""
    for batch in batches:
        for row in range(batch.num_rows):
            held = {name: batch.column(name)[row] for name in batch.schema.names}
            data = np.frombuffer(held["data"].as_py(), "<i4").reshape(-1, length).astype(np.int64)
            orders = np.frombuffer(held["orders"].as_py(), "<i4").reshape(parts, -1)
            nodes = np.frombuffer(held["nodes"].as_py(), NODE)
            split = np.split(data, parts, axis=1)
            yield held, [(orders[i], split[i][orders[i]], nodes[nodes["part"] == i]) for i in range(parts)]


def next_codebooks(trees: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """One of Lloyd's rounds over `codebooks[part, entry, position]`."""
    parts, entries, width = codebooks.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(codebooks.shape, np.int64), np.zeros((parts, entries), np.int64)
        for _, trees_of in _blocks(batches, parts * width, parts):
            for part, (_, points, nodes) in enumerate(trees_of):
                total = np.concatenate((np.zeros((1, width), np.int64), np.cumsum(points, axis=0)))
                for low, high, entry in _assigned(points, nodes, codebooks[part]):
                    np.add.at(sums[part], entry, total[high] - total[low])
                    np.add.at(counts[part], entry, high - low)
        part, entry = np.nonzero(counts)
        given = np.concatenate((sums, counts[:, :, None]), axis=2)[part, entry]
        cells = (np.repeat(part, width + 1), np.repeat(entry, width + 1), np.tile(np.arange(width + 1), len(part)), given.ravel())
        yield pa.record_batch([pa.array(x.astype(np.int64)) for x in cells], ["part", "entry", "at", "total"])

    partial = in_tasks(trees.select("data", "orders", "nodes"), work, "part long, entry long, at long, total long")
    # At most one row per number of the codebooks.
    found = partial.groupBy("part", "entry", "at").agg(F.sum("total").alias("total")).collect()
    totals = np.zeros((parts, entries, width + 1), np.int64)
    for row in found:
        totals[row.part, row.entry, row.at] = row.total
    counts = totals[:, :, width:]
    # Whole-number division rounds down.
    return np.where(counts > 0, totals[:, :, :width] // np.maximum(counts, 1), codebooks)


def encode(trees: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """`vec_id, label, codes, error` of every vector, codes as an entry number per part."""
    parts, _, width = codebooks.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, trees_of in _blocks(batches, parts * width, parts):
            count = len(trees_of[0][0])
            codes, error = np.zeros((count, parts), np.int32), np.zeros(count, np.int64)
            for part, (order, points, nodes) in enumerate(trees_of):
                chosen = np.zeros(count, np.int64)
                for low, high, entry in _assigned(points, nodes, codebooks[part]):
                    rows = np.repeat(low - np.cumsum(high - low) + (high - low), high - low) + np.arange((high - low).sum())
                    chosen[rows] = np.repeat(entry, high - low)
                codes[order, part] = chosen
                apart = points - codebooks[part][chosen]
                error[order] += (apart * apart).sum(axis=1)
            listed = pa.ListArray.from_arrays(np.arange(0, codes.size + 1, parts, dtype=np.int32), pa.array(codes.ravel()))
            yield pa.record_batch(
                [held["ids"].values, held["labels"].values, listed, pa.array(error)], ["vec_id", "label", "codes", "error"]
            )

    return in_tasks(trees, work, "vec_id long, label string, codes array<int>, error long")


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_column: str = "vec_id",
    vector_column: str = "embedding", label_column: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """Codes and errors of all kept vectors, and the final codebooks by part, entry and position."""
    steps = Steps(vectors.sparkSession)
    rows = vectors.select(
        column(id_column).cast("long").alias("id"), column(label_column).cast("string").alias("label"),
        column(vector_column).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where((F.size("vector") > 0) & F.coalesce(finite, F.lit(False)))
    order = [F.asc_nulls_last("id"), F.asc("vector")]
    # Which length counts is settled by one row, the first entries by as many as there are entries.
    first = rows.orderBy(*order).select("vector").first()
    length = len(first.vector) if first else parts
    if length % parts:
        return vectors.sparkSession.createDataFrame([], "vec_id long, label string, codes array<int>, error long"), np.zeros((parts, 0, 0), np.int64)
    rows = rows.where(F.size("vector") == length)
    start = [row.vector for row in rows.orderBy(*order).select("vector").limit(entries).collect()]
    data = whole(np.array(start, np.float64).reshape(len(start), length))
    codebooks = np.stack(np.split(data, parts, axis=1))
    trees = steps.write(build_trees(rows, length, parts), "cover-trees")
    if len(start):
        for _ in range(rounds):
            codebooks = next_codebooks(trees, codebooks)
    coded = steps.write(encode(trees, codebooks), "vector-codes")
    steps.delete("cover-trees")
    return coded, codebooks


def summary(vectors: DataFrame, **options) -> DataFrame:
    """`vec_id, code, error, label_error, codebooks_sha256`: codes in hexadecimal, errors summed by label."""
    coded, codebooks = compress(vectors, **options)
    steps = Steps(vectors.sparkSession)
    labels = steps.write(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    digest = hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
    code = F.array_join(F.transform("codes", lambda x: F.lower(F.lpad(F.hex(x), 2, "0"))), "")
    # One row per label. Spark broadcasts it if it is small, and splits a hot label's rows if not.
    joined = coded.alias("c").join(labels.alias("l"), F.col("c.label").eqNullSafe(F.col("l.label")))
    return joined.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle(embeddings: str = "embeddings") -> str:
    """The same as SQL for DuckDB, every part against every entry."""
    steps = [
        f"""k AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row,
  list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS v, len(embedding) // {PARTS} AS width FROM {embeddings}
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT row, pos // width AS part, pos % width AS pos, v FROM (SELECT row, width, unnest(v) AS v, unnest(range(len(v))) AS pos FROM k)),
b0 AS MATERIALIZED (SELECT part, row - 1 AS entry, pos, v FROM x WHERE row <= {ENTRIES})"""
    ]
    for i in range(ROUNDS + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (SELECT row, part, dist, entry FROM (
  SELECT x.row, x.part, b.entry, sum((x.v - b.v) * (x.v - b.v)) AS dist FROM x JOIN b{i} b ON x.part = b.part AND x.pos = b.pos GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY row, part ORDER BY dist, entry) = 1)"""
        )
        if i < ROUNDS:
            steps.append(
                f"""b{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, coalesce(m.v, b.v) AS v FROM b{i} b LEFT JOIN (
  SELECT x.part, entry, pos, floor(sum(v)::DOUBLE / count(*))::BIGINT AS v FROM x JOIN a{i} USING (row, part) GROUP BY ALL) m
  ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos)"""
            )
    return f"""WITH {", ".join(steps)},
h AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{ROUNDS}),
e AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error FROM a{ROUNDS} GROUP BY 1)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM k JOIN e USING (row), h"""
