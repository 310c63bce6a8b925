"""Document fingerprints: a Merkle tree over sections, paragraphs and leaves.

A paragraph is a line. Its leaves are runs of clauses; a run ends where a clause's
checksum says so, hence an edit moves no leaf but its own. A section is a
run of paragraphs that ends with an empty line or, in the same way, by content. Roots
are equal for equal texts only, and two trees are compared by going down into
branches that differ.

A fingerprint is text: the root, then the first eight hex digits of each leaf, with
`|` between paragraphs and `;` between sections. Likeness is twice the number of
leaves in common over the number of both trees' leaves, from 0 to 1.

Defined results: null text counts as empty, which has one empty leaf; documents are
ordered by descending id, null ids last, equal ids by their text; a lone document
is its own next one; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloader.llm.base import column, in_tasks, slices

#: On average so many clauses make a leaf and so many paragraphs a section.
LEAF_CLAUSES = 2
SECTION_PARAGRAPHS = 4
#: Documents of one sorted partition, on average.
PARTITION_ROWS = 8192
_CLAUSE = re.compile(r"[^.!?,;:]*[.!?,;:]+[^\S\n]*|[^.!?,;:]+")
COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _digest(kind: bytes, content: bytes) -> bytes:
    return hashlib.sha256(kind + content).digest()


@dataclass
class Tree:
    """Digests of each level: sections hold paragraphs, paragraphs hold leaves."""

    root: bytes
    #: One `(section, [(paragraph, [leaf, ...]), ...])` each.
    sections: list[tuple[bytes, list[tuple[bytes, list[bytes]]]]]

    @property
    def leaves(self) -> int:
        return sum(len(leaves) for _, paragraphs in self.sections for _, leaves in paragraphs)

    def text(self) -> str:
        sections = (
            "|".join("".join([leaf[:4].hex() for leaf in leaves]) for _, leaves in paragraphs) for _, paragraphs in self.sections
        )
        return f"{self.root.hex()}:{';'.join(sections)}"


def leaves_of(paragraph: str) -> list[str]:
    """The paragraph in pieces, cut after clauses picked by their own checksum."""
    made, run = [], ""
    for clause in _CLAUSE.findall(paragraph):
        run += clause
        if zlib.crc32(clause.encode()) % LEAF_CLAUSES == 0:
            made.append(run)
            run = ""
    if run or not made:
        made.append(run)
    return made


def tree(text: str) -> Tree:
    sections, paragraphs = [], []
    for line in text.split("\n"):
        leaves = [_digest(b"leaf", leaf.encode()) for leaf in leaves_of(line)]
        digest = _digest(b"paragraph", b"".join(leaves))
        paragraphs.append((digest, leaves))
        if not line.strip() or digest[0] % SECTION_PARAGRAPHS == 0:
            sections.append((_digest(b"section", b"".join(x for x, _ in paragraphs)), paragraphs))
            paragraphs = []
    if paragraphs:
        sections.append((_digest(b"section", b"".join(x for x, _ in paragraphs)), paragraphs))
    return Tree(_digest(b"text", b"".join(x for x, _ in sections)), sections)


def _unmatched(own: list[tuple[bytes, list]], other: list[tuple[bytes, list]]) -> tuple[list, list]:
    """The branches of each side that the other side lacks."""
    counts, others = Counter(x for x, _ in own), Counter(x for x, _ in other)
    spare, spare_other = counts - others, others - counts
    if not spare and not spare_other:
        return [], []

    def rest(branches, left):
        left = Counter(left)
        kept = []
        for digest, children in branches:
            if left[digest] > 0:
                left[digest] -= 1
                kept.append((digest, children))
        return kept

    return rest(own, spare), rest(other, spare_other)


def differing(a: Tree, b: Tree) -> tuple[list[bytes], list[bytes]]:
    """The leaves of each tree that the other lacks, found by going down differing branches."""
    if a.root == b.root:
        return [], []
    own, other = _unmatched(a.sections, b.sections)
    own, other = _unmatched([x for _, parts in own for x in parts], [x for _, parts in other for x in parts])
    ours, theirs = (Counter(leaf for _, leaves in side for leaf in leaves) for side in (own, other))
    return list((ours - theirs).elements()), list((theirs - ours).elements())


def likeness(a: Tree, b: Tree) -> float:
    total = a.leaves + b.leaves
    only_a, only_b = differing(a, b)
    return (total - len(only_a) - len(only_b)) / total


def edits(old: str, new: str) -> list[tuple[int, int]]:
    """Character ranges of `new` whose leaves `old` lacks, in order."""
    _, added = differing(tree(old), tree(new))
    wanted, at, found = Counter(added), 0, []
    for line in new.split("\n"):
        for leaf in leaves_of(line):
            digest = _digest(b"leaf", leaf.encode())
            if wanted[digest] > 0:
                wanted[digest] -= 1
                if found and found[-1][1] == at:
                    found[-1] = (found[-1][0], at + len(leaf))
                else:
                    found.append((at, at + len(leaf)))
            at += len(leaf)
        at += 1
    return found


def _bounds(ids: DataFrame) -> list[int]:
    """The largest id of each range of ids, descending; the ranges hold about as many rows each."""
    known = ids.where(F.col("doc_id").isNotNull())
    parts = -(-known.count() // PARTITION_ROWS)
    if parts <= 1:
        return []
    ranges = known.repartitionByRange(parts, F.col("doc_id").desc()).groupBy(F.spark_partition_id().alias("part"))
    return sorted((row.top for row in ranges.agg(F.max("doc_id").alias("top")).collect()), reverse=True)


def compare_with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document the fingerprints of its text and of its edited text, and the likeness to that and to the next document.

    Texts are shuffled once, to ranges of ids. The first document of each range goes
    to the range before it as well, the very first one to the last range.
    """
    frame = docs.select(
        column(id_column).cast("long").alias("doc_id"), F.coalesce(column(text_column).cast("string"), F.lit("")).alias("text")
    )
    tops = _bounds(frame.select("doc_id"))
    parts = max(1, len(tops))
    limits = -np.array(tops, np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            missing = np.array(ids.is_null())
            numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
            part = np.searchsorted(limits, -numbers, "right") - 1 if parts > 1 else np.zeros(len(ids), np.int64)
            part[missing] = parts - 1
            yield _dealt(batch, part, False)
            first = np.isin(numbers, np.array(tops, np.int64)) & ~missing if parts > 1 else np.zeros(len(ids), bool)
            if first.any():
                yield _dealt(batch.filter(pa.array(first)), (part[first] - 1) % parts, True)

    dealt = in_tasks(frame, deal, "part int, extra boolean, doc_id long, text string")
    order = ("part", "extra", F.col("doc_id").desc_nulls_last(), "text")
    ranged = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions(*order)
    return in_tasks(ranged, _in_order, COLUMNS)


def _dealt(batch: pa.RecordBatch, part: np.ndarray, extra: bool) -> pa.RecordBatch:
    columns = [pa.array(part.astype("i4")), pa.array(np.full(len(part), extra)), *batch.columns]
    return pa.record_batch(columns, ["part", "extra", "doc_id", "text"])


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = held = None
    extra_seen = False
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    names = [x.split()[0] for x in COLUMNS.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], names)

    for batch in slices(batches):
        rows = []
        for doc_id, text, extra in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "text", "extra"))):
            if extra_seen:
                continue  # rows that tie with the first one of the next range
            current = (doc_id, text, tree(text))
            if held:
                rows.append(_compared(held, current))
            first = first or current
            held, extra_seen = current, extra
        if rows:
            yield batch_of(rows)
    if held and not extra_seen:
        # Only a single range has no extra row: the last document's next is the first.
        yield batch_of([_compared(held, first)])


def _compared(own: tuple, following: tuple) -> tuple:
    doc_id, text, own_tree = own
    half = len(text) // 2
    edited = text[: len(text) - half] + following[1][:half]
    edited_tree = tree(edited)
    return (
        doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own_tree.text(), edited_tree.text(),
        likeness(own_tree, edited_tree), likeness(own_tree, following[2]),
    )
