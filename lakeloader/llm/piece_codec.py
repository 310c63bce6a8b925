"""SentencePiece encoding and decoding through a table of distinct chunks.

The pieces of the model must not run on across a whitespace marker: a marker only
stands at the start of a piece. Then a text falls apart before every run of markers,
each distinct chunk is segmented once, and a document's ids are the chunks' ids put
together by position. The table is a task's own: a table for the whole corpus would
need one shuffled row per word position. It is bounded by bytes: it is emptied when it
grows large, and very long chunks are not kept, which costs time, never a result.

Defined results: null counts as empty; an empty text has the begin and end ids only;
any length of text is encoded whole; repeated rows give repeated rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeloader.llm.base import ENTRY_BYTES, LONGEST_KEPT, TABLE_BYTES, column, in_tasks, slices

MARK = "▁"
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


class _Table(dict):
    """What was made of distinct chunks, bounded by bytes from one call to the next."""

    def __init__(self):
        super().__init__()
        self.held, self.long = 0, []

    def trim(self) -> None:
        for chunk in self.long:
            del self[chunk]
        self.long = []
        if self.held > TABLE_BYTES:
            self.clear()
            self.held = 0

    def keep(self, chunk, made: bytes) -> None:
        self[chunk] = made
        if len(chunk) > LONGEST_KEPT:
            self.long.append(chunk)
        else:
            self.held += ENTRY_BYTES + len(chunk) + len(made)


class PieceCodec:
    """Encode and decode whole texts exactly as the library does."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("a piece of this model crosses a whitespace marker")
        self.starts = np.array([piece.startswith(MARK) for piece in pieces])
        self.mark_id = self.model.piece_to_id(MARK)
        self.begin = np.array([self.model.bos_id()], "<u4").tobytes()
        self.end = np.array([self.model.eos_id()], "<u4").tobytes()
        self.ids, self.texts = _Table(), _Table()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, begin and end included, as unsigned 32-bit numbers."""
        chunked = [_CHUNK.findall(MARK + text.replace(" ", MARK)) if text else [] for text in texts]
        table = self.ids
        table.trim()
        new = list({chunk for chunks in chunked for chunk in chunks if chunk not in table})
        # The library puts the first marker there itself.
        for chunk, ids in zip(new, self.model.encode([chunk[1:] for chunk in new], num_threads=1)):
            table.keep(chunk, np.array(ids, "<u4").tobytes())
        table[MARK] = np.array([self.mark_id], "<u4").tobytes()
        return [self.begin + b"".join([table[chunk] for chunk in chunks]) + self.end for chunks in chunked]

    def decode(self, encoded: list[bytes]) -> list[bytes]:
        """The text of each id sequence, in UTF-8."""
        table = self.texts
        table.trim()
        split = []
        for ids in encoded:
            if ids.startswith(self.begin):
                ids = ids[4:]
            if ids.endswith(self.end):
                ids = ids[:-4]
            cuts = (np.flatnonzero(self.starts[np.frombuffer(ids, "<u4")]) * 4).tolist()
            if not cuts or cuts[0]:
                cuts.insert(0, 0)
            split.append([ids[a:b] for a, b in zip(cuts, [*cuts[1:], len(ids)])])
        new = list({chunk for chunks in split for chunk in chunks if chunk not in table})
        lists = [np.frombuffer(chunk, "<u4").tolist() for chunk in new]
        for chunk, ids, text in zip(new, lists, self.model.decode(lists) if lists else []):
            # At the start of a text the library takes one marker away.
            table.keep(chunk, (" " + text if ids and self.starts[ids[0]] else text).encode())
        texts = []
        for chunks in split:
            text = b"".join([table[chunk] for chunk in chunks])
            first = chunks[0][:4]
            texts.append(text[1:] if first and self.starts[int.from_bytes(first, "little")] else text)
        return texts


def encode_decode(docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text", keep: bool = True) -> DataFrame:
    """Per document `doc_id, n_tokens, ids_sha256, decoded_sha256`, with `keep` also `ids` and `decoded`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(model_file)
        for batch in slices(batches):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            encoded = codec.encode(texts)
            decoded = codec.decode(encoded)
            made = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array([len(ids) // 4 for ids in encoded], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(ids).hexdigest() for ids in encoded], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(text).hexdigest() for text in decoded], pa.string()),
            }
            if keep:
                made["ids"] = pa.array([np.frombuffer(ids, "<u4").astype("i4") for ids in encoded], pa.list_(pa.int32()))
                made["decoded"] = pa.array([text.decode() for text in decoded], pa.string())
            yield pa.RecordBatch.from_pydict(made)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if keep else ""
    frame = docs.select(column(id_column).cast("long").alias("doc_id"), column(text_column).cast("string").alias("text"))
    return in_tasks(frame, work, schema)
