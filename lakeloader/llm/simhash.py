"""SimHash near-dedup over a grid of segment bit counts.

A fingerprint of 64 bits falls into 32 segments of two bits, and its embedding are
the segments' bit counts. The Manhattan distance of two embeddings never exceeds
the bit distance of the fingerprints. The segments form groups, at least `limit + 1`:
embeddings within the limit agree on all counts of all groups but `limit`, so with a
grid for every choice of the other groups they meet in a cell of one. There the
Manhattan distance is the first test and the bit distance the last. More groups make
more grids of smaller cells; there are so many that a fingerprint is compared with
about `COMPARED` unrelated ones at most, however many there are.

Only distinct fingerprints take part. A cell with very many of them is compared in
blocks, each pair of blocks in a group of its own, and every group returns a
spanning forest of its links, not the links. Components come from alternating
large-star and small-star steps on written tables.

Defined results: null text counts as empty; no words give the fingerprint zero; the
component id is the smallest non-null id, null if there is none; repeated rows are
in one component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloader.llm.base import column, in_tasks, one_row_each
from lakeloader.session import written

SEED = 42
SHINGLE_WORDS = 4
LIMIT = 4
SEGMENTS = 32
#: Distinct fingerprints compared at once; more in a cell are cut into blocks.
BLOCK = 8192
#: Small cells of about so many fingerprints together make one group of work.
BUNDLE = 30_000
#: Unrelated fingerprints that share a cell with one, on average.
COMPARED = 4000
#: How often unrelated segments have equal counts: 1/16 + 1/4 + 1/16.
ALIKE = 0.375
_AT_ONCE = 1 << 16
_LOW = np.uint64(0x5555555555555555)


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """The majority of each bit over the hashes of all shingles, as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return hashed(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-width] + 1))
    count = len(starts)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, _AT_ONCE):
        spans = zip(starts[at : at + _AT_ONCE].tolist(), ends[at + width - 1 : at + width - 1 + _AT_ONCE].tolist())
        hashes = np.array([hashed(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(ones * 2 > count, bitorder="little").tobytes(), "little")


def fingerprints(
    docs: DataFrame, width: int = SHINGLE_WORDS, id_column: str = "doc_id", text_column: str = "text", more: dict[str, Column] | None = None
) -> DataFrame:
    """`doc_id, bits`: the fingerprint as a signed 64-bit number; `more` names other columns of numbers."""
    names = list(more or {})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(x.as_py() or b"", width) for x in batch.column("text")], np.uint64)
            cells = [batch.column("doc_id"), pa.array(made.view(np.int64)), *[batch.column(name) for name in names]]
            yield pa.record_batch(cells, ["doc_id", "bits", *names])

    frame = docs.select(
        column(id_column).cast("long").alias("doc_id"), column(text_column).cast("binary").alias("text"),
        *[made.alias(name) for name, made in (more or {}).items()],
    )
    return in_tasks(frame, work, ", ".join(f"{name} long" for name in ("doc_id", "bits", *names)))


def embed(bits: np.ndarray) -> np.ndarray:
    """Segment bit counts in unary: two bits 00, 01 or 11 per segment.

    The bit distance of two embeddings is the Manhattan distance of the counts.
    """
    low, high = bits & _LOW, (bits >> np.uint64(1)) & _LOW
    return (low | high) | ((low & high) << np.uint64(1))


def group_count(nodes: int, limit: int) -> int:
    """The fewest groups of segments with which unrelated fingerprints seldom meet."""
    for groups in range(limit + 1, SEGMENTS):
        if nodes * comb(groups, limit) * ALIKE ** (SEGMENTS * (groups - limit) / groups) <= COMPARED:
            return groups
    return SEGMENTS


def grids(limit: int, groups: int) -> np.ndarray:
    """The bits of the embedding each grid looks at: one grid for every choice of `limit` groups to leave out."""
    edges = [2 * (SEGMENTS * i // groups) for i in range(groups + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return np.array([sum(chosen) for chosen in combinations(masks, groups - limit)], np.uint64)


def link(bits: np.ndarray, block: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links: each fingerprint that has a smaller one in its component, and the smallest.

    With two blocks only pairs across them are compared.
    """
    order = np.argsort(bits)
    bits, block = bits[order], block[order]
    count, places = embed(bits.view(np.uint64)), bits.view(np.uint64)
    root = np.arange(len(bits))
    across = block.min() != block.max()
    rows = np.flatnonzero(block == block.min()) if across else root
    against = np.flatnonzero(block == block.max()) if across else root
    step = max(1, (1 << 22) // max(len(against), 1))
    for at in range(0, len(rows), step):
        own = rows[at : at + step]
        near = np.bitwise_count(count[own][:, None] ^ count[against][None, :]) <= limit
        i, j = np.nonzero(near)
        i, j = own[i], against[j]
        near = (i != j) & (np.bitwise_count(places[i] ^ places[j]) <= limit)
        i, j = i[near], j[near]
        while len(i):
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(root[root], root):
                root = root[root]
    child = np.flatnonzero(root != np.arange(len(bits)))
    return bits[child], bits[root[child]]


def links(nodes: DataFrame, limit: int = LIMIT, block: int = BLOCK, groups: int | None = None) -> DataFrame:
    """Edges `u > v` between distinct fingerprints whose components are those of all links."""
    count = nodes.count()
    masks = grids(limit, groups or group_count(count, limit))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("bits").to_numpy()
            counts = embed(bits.view(np.uint64))
            for grid, mask in enumerate(masks):
                cell = (counts & mask).view(np.int64)
                yield pa.record_batch([pa.repeat(pa.scalar(grid, pa.int32()), len(bits)), pa.array(cell), pa.array(bits)], ["grid", "cell", "bits"])

    placed = in_tasks(nodes.select("bits"), cells, "grid int, cell long, bits long")
    full = placed.groupBy("grid", "cell").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > block)
    # One row per crowded cell. Spark broadcasts them if they are few.
    full = written(full.select("grid", "cell", F.ceil(F.col("size") / block).alias("blocks")), "crowded-cells")
    bundles = max(1, -(-count * len(masks) // BUNDLE))
    placed = placed.join(full, ["grid", "cell"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    dealt = placed.withColumn("block", F.pmod(F.xxhash64("bits"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    large = F.col("blocks") > 1
    keys = [
        F.when(large, F.col("grid")).otherwise(-1).alias("grid"),
        F.when(large, F.col("cell")).otherwise(F.pmod(F.xxhash64("grid", "cell"), F.lit(bundles))).alias("work"),
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    ]

    def compare(rows: pa.Table) -> pa.Table:
        grid, cell, bits, block = (rows[name].to_numpy() for name in ("of", "cell", "bits", "block"))
        order = np.lexsort((cell, grid))
        edges = np.flatnonzero((np.diff(cell[order]) != 0) | (np.diff(grid[order]) != 0)) + 1
        made = [link(bits[part], block[part], limit) for part in np.split(order, edges) if len(part) > 1]
        made = [pair for pair in made if len(pair[0])] or [(np.zeros(0, np.int64),) * 2]
        return pa.table({"u": np.concatenate([u for u, _ in made]), "v": np.concatenate([v for _, v in made])})

    work = dealt.select(*keys, F.col("grid").alias("of"), "cell", "bits", "block")
    return work.groupBy("grid", "work", "low", "high").applyInArrow(compare, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """`u, v`: every node that is not the smallest of its component, and the smallest."""
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "edges")
    before = None
    while True:
        seen = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("sum")).first()
        if seen.n == 0 or seen == before:
            return edges
        before = seen
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # A written side lets Spark split the edges of a node with very many.
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "edges")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "edges")


def _with_roots(rows: DataFrame, limit: int) -> DataFrame:
    """The rows with `root`, the smallest fingerprint of their component, and `component_id`."""
    nodes = written(rows.groupBy("bits").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    found = components(links(nodes, limit))
    rooted = nodes.join(found.select(F.col("u").alias("bits"), F.col("v").alias("root")), "bits", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "bits"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(rooted.join(smallest, "root").select("bits", "root", "component_id"), "bits")


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE_WORDS, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: `doc_id, fingerprint, component_id`."""
    rows = written(fingerprints(docs, width, id_column, text_column), "fingerprints")
    shown = F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint")
    return _with_roots(rows, limit).select("doc_id", shown, "component_id")


def keep_one(
    docs: DataFrame, width: int = SHINGLE_WORDS, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row of every component, that with the smallest id, with all columns as they are.

    Of rows that share the id, or have none, one stays.
    """
    text = F.coalesce(column(text_column).cast("string"), F.lit(""))
    # The id and 128 bits of hash stand for a document's row.
    keys = {"doc_id": column(id_column).cast("long"), "one": F.xxhash64(text), "two": F.xxhash64(F.lit(1), text)}
    rows = written(fingerprints(docs, width, id_column, text_column, {"one": keys["one"], "two": keys["two"]}), "fingerprints")
    same = _with_roots(rows, limit).groupBy("root", "doc_id", "one", "two").agg(F.count(F.lit(1)).alias("rows"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "one", "two", "rows")).alias("kept")
    return one_row_each(docs, same.groupBy("root").agg(least).select("kept.*"), keys)
