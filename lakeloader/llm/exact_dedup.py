"""Exact dedup against a minimal perfect hash over the digests of earlier documents.

History is an index: its distinct digests are dealt to shards, and each shard holds
a minimal perfect hash whose slots keep the whole digest and the winner's id. A
document of a later batch is looked up in one slot and compared byte by byte: a
member repeats a document of the history, the others are grouped among themselves.

Defined results:

- null text counts as empty, so null and empty texts are equal;
- of equal texts the largest id stays; a null id loses against any other, and a
  group without ids has a null `keep_id`;
- rows that share id and text are all marked as kept or not, and each counts in
  `group_size`; `drop_repeats` keeps one of them;
- an empty table gives no rows; other columns of the input play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloader.llm.base import ascii_lower, column, in_tasks, mix, one_row_each
from lakeloader.session import written

#: Distinct digests of one shard: about 2 MB of slots.
SHARD_KEYS = 50_000
#: Bits of a level for each key that reaches it.
GAMMA = 2
LEVELS = 64
SLOTS = "shard long, levels array<binary>, digests binary, winners array<long>, sizes array<long>"
GROUPS = "digest binary, keep_id long, group_size long, historical boolean"
_STEP = 0x9E3779B97F4A7C15


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`doc_id, digest`: SHA-256 of the text in UTF-8 with A-Z lower-cased."""
    frame = docs.select(column(id_column).cast("long").alias("doc_id"), column(text_column).cast("binary").alias("text"))
    return in_tasks(frame, _digest_rows, "doc_id long, digest binary")


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # bytes.lower() touches ASCII letters only.
        made = [hashlib.sha256((x.as_py() or b"").lower()).digest() for x in batch.column("text")]
        yield pa.record_batch([batch.column("doc_id"), pa.array(made, pa.binary())], ["doc_id", "digest"])


class PerfectHash:
    """A minimal perfect hash over distinct 32-byte digests.

    Level by level every remaining key claims one bit of an array; keys alone on
    their bit stay there, the others go on to the next level. A key's slot is the
    number of bits set before its own.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = []
        total = 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.before.append(total + np.cumsum(ones) - ones)
            total += int(ones.sum())

    @staticmethod
    def _place(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
        lane = keys[:, level % 4] + np.uint64(_STEP * (level + 1) & (2**64 - 1))
        return (mix(lane) % np.uint64(bits)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            if len(levels) == LEVELS:
                raise ValueError("the digests are not distinct")
            bits = -(-GAMMA * len(keys) // 64) * 64
            place = cls._place(keys, len(levels), bits)
            alone = np.bincount(place, minlength=bits) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            keys = keys[~alone[place]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot; any slot or -1 for keys that weren't built in."""
        slots = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        for level, words in enumerate(self.levels):
            place = self._place(keys[rest], level, len(words) * 64)
            word, bit = words[place >> 6], (place & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            slots[rest[hit]] = (self.before[level][place >> 6] + below)[hit]
            rest = rest[~hit]
        return slots


def _keys(digest_column) -> np.ndarray:
    """Digests as rows of four unsigned 64-bit lanes."""
    joined = b"".join(digest_column.to_pylist())
    return np.frombuffer(joined, "<u8").reshape(-1, 4)


def grouped(digest_rows: DataFrame, shards: int) -> DataFrame:
    """One row per distinct digest, pre-aggregated before the shuffle."""
    return (
        digest_rows.groupBy("digest")
        .agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("size"))
        .withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))
    )


def build_index(history: DataFrame) -> DataFrame:
    """One row of slots per shard, for the rows of `grouped`."""
    return history.groupBy("shard").applyInArrow(_build_shard, SLOTS)


def _build_shard(rows: pa.Table) -> pa.Table:
    keys = _keys(rows["digest"])
    hashed = PerfectHash.build(keys)
    order = np.argsort(hashed.slots(keys))
    winners, sizes = rows["winner"].take(pa.array(order)), rows["size"].take(pa.array(order))
    return pa.table(
        {
            "shard": rows["shard"].slice(0, 1).combine_chunks(),
            "levels": pa.array([[words.tobytes() for words in hashed.levels]], pa.list_(pa.binary())),
            "digests": pa.array([keys[order].tobytes()], pa.binary()),
            "winners": pa.array([winners.to_pylist()], pa.list_(pa.int64())),
            "sizes": pa.array([sizes.to_pylist()], pa.list_(pa.int64())),
        }
    )


def look_up(batch: DataFrame, index: DataFrame) -> DataFrame:
    """Groups of history and batch together: members join their slot's group, the rest form new ones."""
    return batch.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_look_up_shard, GROUPS)


def _look_up_shard(batch: pa.Table, index: pa.Table) -> pa.Table:
    digests, winners, sizes = [], [], []
    known = 0
    member = np.zeros(batch.num_rows, bool)
    if index.num_rows:
        slots = index["digests"][0].as_py()
        held = np.frombuffer(slots, "<u8").reshape(-1, 4)
        known = len(held)
        counts = np.array(index["sizes"][0].as_py(), np.int64)
        if batch.num_rows:
            hashed = PerfectHash([np.frombuffer(x, "<u8") for x in index["levels"][0].as_py()])
            keys = _keys(batch["digest"])
            at = hashed.slots(keys)
            member = (at >= 0) & (held[at] == keys).all(axis=1)
            np.add.at(counts, at[member], np.array(batch["size"].to_pylist(), np.int64)[member])
        digests += [slots[i : i + 32] for i in range(0, len(slots), 32)]
        winners += index["winners"][0].as_py()
        sizes += counts.tolist()
        # The history's ids need not be the larger ones.
        ids = batch["winner"].to_pylist()
        for row in np.flatnonzero(member):
            if ids[row] is not None and (winners[at[row]] is None or ids[row] > winners[at[row]]):
                winners[at[row]] = ids[row]
    if batch.num_rows:
        rest = batch.filter(pa.array(~member))
        digests += rest["digest"].to_pylist()
        winners += rest["winner"].to_pylist()
        sizes += rest["size"].to_pylist()
    return pa.table(
        {
            "digest": pa.array(digests, pa.binary()),
            "keep_id": pa.array(winners, pa.int64()),
            "group_size": pa.array(sizes, pa.int64()),
            "historical": pa.array([i < known for i in range(len(digests))], pa.bool_()),
        }
    )


def exact_dedup(docs: DataFrame, history: DataFrame | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document of `docs`: `doc_id, keep_id, group_size, kept, text_sha256, historical`.

    `history` is an earlier batch. Without one, the upper half of the id range goes
    in first as the history and the lower half is looked up in it. The hot side of
    the last join, the documents, is split by Spark where a digest is very common.
    """
    rows = written(digests(docs, id_column, text_column), "digests")
    if history is None:
        ends = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
        middle = ends.low + (ends.high - ends.low) // 2 if ends.low is not None else 0
        upper = F.coalesce(F.col("doc_id") > middle, F.lit(False))
        earlier, later = rows.where(upper), rows.where(~upper)
    else:
        earlier, later = digests(history, id_column, text_column), rows
    shards = max(1, -(-rows.count() // SHARD_KEYS))
    index = written(build_index(grouped(earlier, shards)), "perfect-hash")
    groups = look_up(grouped(later, shards), index)
    return rows.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "historical",
    )


def drop_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of `docs` for every text, that of the largest id; all columns stay as they are.

    Of rows that share the id, too, or have none, one stays.
    """
    found = exact_dedup(docs, None, id_column, text_column).where("kept")
    kept = found.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("rows"))
    text = F.coalesce(column(text_column).cast("string"), F.lit(""))
    keys = {"doc_id": column(id_column).cast("long"), "text_sha256": F.sha2(ascii_lower(text).cast("binary"), 256)}
    return one_row_each(docs, kept, keys)
