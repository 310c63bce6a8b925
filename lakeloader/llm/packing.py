"""Best-fit packing of documents into training sequences, by hierarchical residual packing.

Each task packs its own items best fit (largest first) and emits the bins that are
full or nearly so. The bins left with room become items themselves: they are dealt
to fewer tasks, which pack them again, until one task holds them all or a round
joins hardly any. A task never holds more than about `NODE_ITEMS` items.

Defined results: null text counts as empty and gives one piece, the closing id; only
documents of more than `capacity` ids are cut; rows that share an id are packed as
documents of their own; an empty table gives no rows. `cut` gives each piece's ids, and
`pack` keeps all columns of the pieces, so that its rows are the training sequences.
Ids are little-endian unsigned 32-bit numbers.
"""

from __future__ import annotations

import functools
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloader.llm.base import ENTRY_BYTES, LONGEST_KEPT, TABLE_BYTES, column, in_tasks, slices, unused
from lakeloader.session import written

CAPACITY = 4096
#: A bin with no more room than this is emitted at once.
NEARLY_FULL = 16
NODE_ITEMS = 100_000
#: Tasks that merge into one per round.
FAN_IN = 8
#: A round that removes less than this share of the bins is the last.
LEAST_GAIN = 0.01
#: How tokenizers of the kind that has the short way split a text.
SPLITS = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split", "behavior": "Removed", "invert": True,
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
_PLAIN = re.compile("[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
#: A word of letters and what follows them: two parts.
_COMMON = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:;=-@[-`{-~]*)")
_PART = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
#: Writers of so many numbers, little-endian.
_NUMBERS = [struct.Struct(f"<{n}I").pack for n in range(16)]
MEMBER = np.dtype([("row", "<i8"), ("length", "<i4")])
PIECES = "doc_id long, piece int, start long, length long, ids binary"
BINS = "size int, members binary, done boolean"


class WordTokenizer(dict):
    """Ids of whole texts; each distinct word between blanks is tokenized once while the table lasts.

    For tokenizers that drop white space, so that no token spans it. A word of Latin
    letters, digits and punctuation falls apart in the same way for every tokenizer
    of the kind `SPLITS`; its parts go to the tokenizer's model without the general
    way's bookkeeping. All other words go the general way.
    """

    def __init__(self, file: str):
        self.general, self.plain, self.common = _loaded(file)
        self.model = self.general.model
        # Parts of words, apart from runs of letters, which are words themselves.
        self.parts: dict[str, bytes] = {}
        self.held = 0

    def __missing__(self, word: str) -> bytes:
        common = self.common(word)
        if common:
            letters, rest = common.groups()
            letters = letters.lower()
            ids = self.get(letters) or self._part(letters, self)
            if letters == word:
                return ids
            if rest:
                ids += self.parts.get(rest) or self._part(rest, self.parts)
        elif self.plain(word) and "<|" not in word:
            parts = self.parts
            ids = b"".join([parts.get(part) or self._part(part, parts) for part in _PART.findall(word.lower())])
        else:
            ids = np.array(self.general.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        self._keep(self, word, ids)
        return ids

    def _part(self, part: str, table: dict[str, bytes]) -> bytes:
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(_SHOWN)
        found = [token.id for token in self.model.tokenize(shown)]
        ids = _NUMBERS[len(found)](*found) if len(found) < len(_NUMBERS) else np.array(found, "<u4").tobytes()
        self._keep(table, part, ids)
        return ids

    def _keep(self, table: dict[str, bytes], word: str, ids: bytes) -> None:
        """Bounded by bytes: a full table is emptied, a very long word passes by."""
        size = len(word)
        if size > LONGEST_KEPT:
            return
        if self.held > TABLE_BYTES:
            self.clear()
            self.parts.clear()
            self.held = 0
        table[word] = ids
        self.held += ENTRY_BYTES + size + len(ids)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@functools.lru_cache(maxsize=1)
def _loaded(file: str) -> tuple:
    """The tokenizer, and what matches plain and common words if it has the short way. A worker loads it once."""
    from tokenizers import Tokenizer

    general = Tokenizer.from_file(file)
    settings = json.loads(general.to_str())
    short = all(settings[name] == kind for name, kind in SPLITS.items())
    return general, *((x if short else re.compile("(?!)")).fullmatch for x in (_PLAIN, _COMMON))


def _shown() -> dict[int, str]:
    """Byte-level models see bytes without a printable character as characters from 256 on."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


_SHOWN = _shown()


def cut(
    docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, closing: int = 1, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Tokenized documents as pieces of at most `capacity` ids."""
    end, width = np.array([closing], "<u4").tobytes(), 4 * capacity

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(tokenizer_file)
        for batch in slices(batches):
            rows: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = tokenizer.encode(text or "") + end
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    for held, value in zip(rows, (doc_id, piece, at // 4, len(part) // 4, part)):
                        held.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch(
                [pa.array(held, kind) for held, kind in zip(rows, kinds)], ["doc_id", "piece", "start", "length", "ids"]
            )

    frame = docs.select(column(id_column).cast("long").alias("doc_id"), column(text_column).cast("string").alias("text"))
    return in_tasks(frame, work, PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers: largest item first, each into the bin it fills best."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set while some bin has room r
    bins: list[list[int]] = []
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[chosen].append(item)
        else:
            room, chosen = capacity, len(bins)
            bins.append([item])
        room -= size
        by_room[room].append(chosen)
        rooms |= 1 << room
    return bins


def _as_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces as items of one member each."""
    for batch in batches:
        rows = np.zeros(batch.num_rows, MEMBER)
        for name in ("row", "length"):
            rows[name] = batch.column(name).to_numpy(zero_copy_only=False)
        data, width = rows.tobytes(), MEMBER.itemsize
        members = [data[i : i + width] for i in range(0, len(data), width)]
        sizes = pa.array(rows["length"].astype("i4"))
        yield pa.record_batch(
            [sizes, pa.array(members, pa.binary()), pa.array([False] * len(members))], ["size", "members", "done"]
        )


def _pack(batches: Iterator[pa.RecordBatch], capacity: int, nearly_full: int) -> Iterator[pa.RecordBatch]:
    sizes, members = [], []
    for batch in batches:
        sizes += batch.column("size").to_pylist()
        members += batch.column("members").to_pylist()
    bins = best_fit(np.array(sizes, np.int64), capacity)
    for at in range(0, len(bins), 10_000):
        part = bins[at : at + 10_000]
        filled = [sum(sizes[i] for i in items) for items in part]
        yield pa.record_batch(
            [
                pa.array(filled, pa.int32()),
                pa.array([b"".join([members[i] for i in items]) for items in part], pa.binary()),
                pa.array([capacity - size <= nearly_full for size in filled], pa.bool_()),
            ],
            ["size", "members", "done"],
        )


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each bin with their places in it."""
    for batch in slices(batches, 10_000):
        blobs = batch.column("members").to_pylist()
        rows = np.frombuffer(b"".join(blobs), MEMBER)
        counts = np.array([len(blob) // MEMBER.itemsize for blob in blobs], np.int64)
        before = np.cumsum(rows["length"].astype(np.int64)) - rows["length"]
        firsts = np.cumsum(counts) - counts
        offset = before - np.repeat(before[firsts], counts)
        sequence = np.repeat(batch.column("sequence_id").to_numpy(), counts)
        made = {"row": pa.array(rows["row"]), "sequence_id": pa.array(sequence), "offset": pa.array(offset)}
        yield pa.RecordBatch.from_pydict(made)


def pack(pieces: DataFrame, capacity: int = CAPACITY, nearly_full: int = NEARLY_FULL, node_items: int = NODE_ITEMS) -> DataFrame:
    """The pieces with `sequence_id` and `offset`; no sequence holds more than `capacity` ids."""
    (row,) = unused(pieces, "row")
    # Only rows' numbers and lengths are dealt; all else waits in the written table.
    pieces = written(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    light = pieces.select(F.col(row).alias("row"), "length")
    whole = in_tasks(light.where(F.col("length") >= capacity), _as_items, BINS)
    items = in_tasks(light.where(F.col("length") < capacity), _as_items, BINS)
    emitted, count = [whole], light.where(F.col("length") < capacity).count()
    nodes = max(1, -(-count // node_items))
    last = nodes == 1
    while True:
        room = capacity if last else nearly_full

        def work(batches: Iterator[pa.RecordBatch], room: int = room) -> Iterator[pa.RecordBatch]:
            return _pack(batches, capacity, room)

        # Dealt in turn: no value of a row decides where it goes.
        packed = written(in_tasks(items.repartition(nodes), work, BINS), "bins")
        emitted.append(packed.where("done"))
        if last:
            break
        items = packed.where("NOT done")
        left = items.count()
        made = packed.count()
        fewer = max(-(-nodes // FAN_IN), -(-left // node_items), 1)
        last = fewer == 1 or made > (1 - LEAST_GAIN) * count and fewer >= nodes
        nodes, count = fewer, left
    bins = emitted[0]
    for more in emitted[1:]:
        bins = bins.unionAll(more)
    bins = bins.select(F.monotonically_increasing_id().alias("sequence_id"), "members")
    # Numbered once: the join below may read the places more than once.
    places = written(in_tasks(bins, _places, "row long, sequence_id long, offset long"), "places")
    return pieces.join(places.withColumnRenamed("row", row), row).drop(row)
