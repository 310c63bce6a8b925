"""Substring dedup with an FM-index per shard.

A window is `WINDOW` consecutive words. A window whose words also start earlier (at
a smaller id, or earlier in the same document) is a repeat, and words under repeats
go. Documents are cut into segments: runs of windows with the same minimizer, the
smallest hash of `SHINGLE` words in the window. Equal windows have equal minimizers,
so a segment can only meet segments of its own minimizer's shard:

1. minimizers that occur once are dropped, as their windows can't repeat;
2. equal segments are grouped; all but the first of a group are repeats as a whole;
3. the first ones of minimizers with several different segments go to shards. Each
   shard builds an FM-index and searches its segments' windows backward in it; a
   window with an earlier occurrence is reported;
4. a minimizer whose different segments have more words than a shard would make its
   shard grow without bound. Its windows are dealt by their own hash instead, and all
   but the first of equal ones are repeats.

The reported intervals meet the texts once more, by document. Steps are written to
the shared folder and deleted after their last use.

Defined results: null text has no words; rows that share id and text count as one
document, rows that share only the id are ordered by a hash of their text; a null id
comes before all others; documents of fewer than `WINDOW` words keep all; an empty
table gives no rows. Segments of one minimizer are compared by 64 bits of hash,
windows outside the index by 128, and those within a shard as words.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloader.llm.base import column, in_tasks, mix, slices, unused
from lakeloader.llm.fm_index import FmIndex
from lakeloader.session import fresh_folder

WINDOW = 20
SHINGLE = 5
#: Words in one shard's index on average, and words of one minimizer at most.
SHARD_WORDS = 250_000
NO_ID = -(1 << 63)
#: Rows of a batch made in a task, and bytes of words in one, beyond which it ends.
BATCH_ROWS, BATCH_BYTES = 1 << 16, 4 << 20
#: Bytes of texts that are looked at together.
TOGETHER = 1 << 18
_FACTORS = (np.random.default_rng(20).integers(1, 1 << 62, WINDOW, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: What ends a word, as a table of bytes; masks of the first bytes of a 64-bit number.
_BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
SEGMENT = "id long, variant long, start int, windows int"


def word_codes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and the byte where it starts."""
    padded = text + b" " + bytes(15)
    blank = _BLANK[np.frombuffer(padded, np.uint8, len(text) + 1)]
    edges = np.flatnonzero(np.concatenate(([not blank[0]], blank[1:] != blank[:-1])))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    # Words of at most 16 bytes are two numbers and their size.
    eights = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    one, two = eights[starts] & _FIRST[np.minimum(sizes, 8)], eights[starts + 8] & _FIRST[np.clip(sizes - 8, 0, 8)]
    codes = mix(mix(mix(one + np.uint64(_BASE)) + two) + sizes.astype(np.uint64))
    for word in np.flatnonzero(sizes > 16).tolist():
        start = int(starts[word])
        codes[word] = xxhash.xxh64_intdigest(text[start : start + int(sizes[word])])
    return codes, starts


def _runs(codes: np.ndarray, width: int) -> np.ndarray:
    """The hash of every `width` codes in a row."""
    count = len(codes) - width + 1
    total = np.zeros(count, np.uint64)
    for i in range(width):
        total += codes[i : i + count] * _FACTORS[i]
    return mix(total)


def segments(codes: np.ndarray, sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimizer, first window and number of windows of each segment.

    The codes are those of several documents in a row, of so many words each, or of one.
    """
    if len(codes) < WINDOW:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = _runs(codes, SHINGLE)
    place, span, wanted = np.arange(len(least)), 1, WINDOW - SHINGLE + 1
    while span < wanted:
        step = min(span, wanted - span)
        left, right = slice(None, len(least) - step), slice(step, None)
        later = least[right] < least[left]
        least, place = np.where(later, least[right], least[left]), np.where(later, place[right], place[left])
        span += step
    fresh = np.concatenate(([True], place[1:] != place[:-1]))
    if sizes is None:
        inside = np.ones(len(place), bool)
    else:
        # Windows that reach into the next document are none. They part the documents' own.
        inside = (np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes)) >= WINDOW)[: len(place)]
        fresh[1:] |= inside[1:] != inside[:-1]
    first = np.flatnonzero(fresh)
    windows, own = np.diff(np.append(first, len(place))), inside[first]
    return least[first[own]], first[own], windows[own]


def _prefix(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and inverse powers that give the hash of any run of codes."""
    powers = np.cumprod(np.full(len(codes), _BASE, np.uint64))
    inverse = np.cumprod(np.full(len(codes), _INVERSE, np.uint64))
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(codes) * powers, dtype=np.uint64))), inverse


def contents(codes: np.ndarray, first: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The hash of `words` words from each place in `first`."""
    if not len(first):
        return np.zeros(0, np.uint64)
    sums, inverse = _prefix(codes)
    return mix((sums[first + words] - sums[first]) * inverse[first] + words.astype(np.uint64))


def _joined(made: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of up to `BATCH_ROWS` rows of the arrays, put together."""
    whole = [np.concatenate(parts) for parts in zip(*made)]
    for start in range(0, len(whole[0]), BATCH_ROWS):
        cut = [x[start : start + BATCH_ROWS] for x in whole]
        yield pa.record_batch([pa.array(x, kind) for x, kind in zip(cut, schema.types)], schema)


def _each(batches: Iterator[pa.RecordBatch], work, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of the arrays that `work` makes of each row."""
    for batch in slices(batches):
        made, held = [], 0
        # A row's values become Python objects when it is its turn.
        for i in range(batch.num_rows):
            for arrays in work(*(x[i].as_py() for x in batch.columns)):
                made.append(arrays)
                held += len(arrays[0])
            if held >= BATCH_ROWS:
                yield from _joined(made, schema)
                made, held = [], 0
        if made:
            yield from _joined(made, schema)


def _together(batches: Iterator[pa.RecordBatch], work, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of the arrays that `work` makes of some rows, with the codes of all their words and the words of each.

    Rows are taken until their texts have `TOGETHER` bytes.
    """
    for batch in slices(batches):
        texts = batch.column("text")
        begin, held, size = 0, [], 0
        for i in range(batch.num_rows):
            held.append(texts[i].as_py())
            size += len(held[-1]) + 1
            if size >= TOGETHER or i + 1 == batch.num_rows:
                codes, starts = word_codes(b" ".join(held))
                ends = np.searchsorted(starts, np.cumsum([len(text) + 1 for text in held]))
                arrays = work(batch.slice(begin, len(held)), codes, np.diff(ends, prepend=0))
                begin, held, size = i + 1, [], 0
                if len(arrays[0]):
                    yield from _joined([arrays], schema)


_LONGS = {"long": pa.int64(), "int": pa.int32()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _LONGS[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(column(text_column).cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(column(id_column).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("variant"),
        text.cast("binary").alias("text"),
    )


class _Steps:
    """Written steps of one run, which are deleted after their last use."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, {}

    def write(self, frame: DataFrame, label: str) -> DataFrame:
        folder = fresh_folder(self.spark, label)
        frame.write.parquet(folder)
        self.folders[label] = folder
        return self.spark.read.schema(frame.schema).parquet(folder)

    def delete(self, *labels: str) -> None:
        """Delete steps, and let shuffle files go now, not when the driver's memory fills."""
        for label in labels:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folders.pop(label))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        self.spark._jvm.System.gc()


def _owners(rows: pa.RecordBatch, sizes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The id and variant of the document that holds each place, and the place in it."""
    ends = np.cumsum(sizes)
    owner = np.searchsorted(ends, first, "right")
    id_, variant = (rows.column(x).to_numpy() for x in ("id", "variant"))
    return id_[owner], variant[owner], first - (ends - sizes)[owner]


def _minimizers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def work(rows, codes, sizes):
        least, first, _ = segments(codes, sizes)
        return _signed(least), *_owners(rows, sizes, first)

    return _together(batches, work, _schema("mini long, id long, variant long, start int"))


def _survivors(keyed: DataFrame, steps: _Steps) -> DataFrame:
    """The texts with the starts of segments whose minimizer occurs more than once."""
    found = steps.write(in_tasks(keyed, _minimizers, "mini long, id long, variant long, start int"), "minimizers")
    # A written side lets Spark split the other one where a minimizer is very common.
    often = steps.write(found.groupBy("mini").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mini"), "often")
    starts = found.join(often, "mini", "left_semi").groupBy("id", "variant").agg(F.collect_set("start").alias("starts"))
    starts = steps.write(starts, "starts")
    steps.delete("minimizers", "often")
    candidates = steps.write(keyed.join(starts, ["id", "variant"]), "candidates")
    steps.delete("starts")
    return candidates


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def work(rows, codes, sizes):
        starts = rows.column("starts")
        begins = np.repeat(np.cumsum(sizes) - sizes, starts.value_lengths().to_numpy())
        wanted = np.zeros(len(codes), bool)
        wanted[starts.flatten().to_numpy() + begins] = True
        least, first, windows = segments(codes, sizes)
        kept = wanted[first]
        least, first, windows = least[kept], first[kept], windows[kept]
        content = contents(codes, first, windows + WINDOW - 1)
        return _signed(least), _signed(content), *_owners(rows, sizes, first), windows

    return _together(batches, work, _schema("mini long, content long, " + SEGMENT))


def _position() -> F.Column:
    return F.struct("id", "variant", "start")


def _repeated_segments(candidates: DataFrame, steps: _Steps) -> tuple[DataFrame, DataFrame]:
    """Intervals of segments that are copies, and the first segments that must be searched."""
    rows = in_tasks(candidates.select("id", "variant", "text", "starts"), _segment_rows, "mini long, content long, " + SEGMENT)
    rows = steps.write(rows, "segments")
    groups = steps.write(
        rows.groupBy("mini", "content").agg(
            F.min(_position()).alias("first"), F.first("windows").alias("windows"), F.count(F.lit(1)).alias("n")
        ),
        "segment-groups",
    )
    copies = rows.join(groups.where("n > 1").select("mini", "content", "first"), ["mini", "content"])
    copies = copies.where(_position() > F.col("first")).select("id", "variant", "start", "windows").distinct()
    kinds = (
        groups.groupBy("mini").agg(F.count(F.lit(1)).alias("kinds"), F.sum(F.col("windows") + WINDOW - 1).alias("words"))
        .where("kinds > 1")
    )
    searched = groups.join(steps.write(kinds, "kinds"), "mini").select("mini", "first.*", "windows", (F.col("words") > SHARD_WORDS).alias("hot"))
    found = steps.write(copies, "copies"), steps.write(searched, "searched")
    steps.delete("segments", "segment-groups", "kinds")
    return found


def _with_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The searched segments of each document with their words."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())

    def joined(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(x, k) for x, k in zip(zip(*rows), kinds)]
        return pa.record_batch(columns, ["shard", "id", "variant", "start", "windows", "words"])

    for batch in slices(batches):
        rows, size = [], 0
        for i in range(batch.num_rows):
            id_, variant, text, listed = (x[i].as_py() for x in batch.columns)
            words = text.split()
            for found in listed:
                start, windows = found["start"], found["windows"]
                part = b" ".join(words[start : start + windows + WINDOW - 1])
                rows.append((found["shard"], id_, variant, start, windows, part))
                size += len(part)
                if size >= BATCH_BYTES:
                    yield joined(rows)
                    rows, size = [], 0
        if rows:
            yield joined(rows)


def search_shard(rows: pa.Table) -> pa.Table:
    """Runs of windows of a shard's segments that occur earlier in the shard."""
    id_, variant, start, windows = (rows[x].to_numpy() for x in ("id", "variant", "start", "windows"))
    order = np.lexsort((start, variant, id_))
    places = np.stack([x[order].astype(np.int64) for x in (id_, variant, start)])
    # Rows that share id and text come with the same segments.
    order = order[np.concatenate(([True], (places[:, 1:] != places[:, :-1]).any(axis=0)))]
    numbers: dict[bytes, int] = {}
    text, begins = [], []
    words = rows["words"]
    for row in order.tolist():
        begins.append(len(text))
        text += [numbers.setdefault(word, len(numbers) + 1) for word in words[row].as_py().split(b" ")]
        text.append(0)
    index = FmIndex(np.array(text, np.int32), WINDOW)
    counts = windows[order].astype(np.int64)
    # Places of windows in the text ascend as their positions in the corpus do.
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    places = np.repeat(np.array(begins, np.int64), counts) + within
    which, low, _ = index.matching(places, WINDOW)
    _, group = np.unique(low, return_inverse=True)
    earliest = np.full(group.max(initial=-1) + 1, len(text), np.int64)
    np.minimum.at(earliest, group, places[which])
    repeat = np.zeros(len(places), bool)
    repeat[which] = earliest[group] < places[which]
    segment = np.repeat(order, counts)
    at = np.flatnonzero(repeat)
    fresh = np.flatnonzero(np.concatenate(([True], (np.diff(at) > 1) | (np.diff(segment[at]) != 0)))) if len(at) else at
    sizes = np.diff(np.append(fresh, len(at)))
    head = at[fresh] if len(at) else at
    owner = segment[head]
    return pa.table(
        {
            "id": id_[owner], "variant": variant[owner], "start": (start[owner] + within[head]).astype(np.int32),
            "windows": sizes.astype(np.int32),
        }
    )


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the hot segments with two hashes of its words."""

    def work(id_, variant, text, listed):
        codes, _ = word_codes(text)
        starts = np.concatenate([np.arange(x["start"], x["start"] + x["windows"]) for x in listed])
        one, two = _runs(codes, WINDOW)[starts], contents(codes, starts, np.full(len(starts), WINDOW))
        yield _signed(one), _signed(two), np.full(len(starts), id_), np.full(len(starts), variant), starts, np.ones(len(starts))

    return _each(batches, work, _schema("one long, two long, " + SEGMENT))


def _searched_intervals(candidates: DataFrame, searched: DataFrame, steps: _Steps) -> DataFrame:
    total = searched.agg(F.sum(F.col("windows") + WINDOW).alias("words")).first().words or 0
    shards = max(1, -(-total // SHARD_WORDS))
    shard = F.when(F.col("hot"), F.lit(-1).cast("long")).otherwise(F.pmod(F.xxhash64("mini"), F.lit(shards)))
    listed = (
        searched.withColumn("shard", shard).groupBy("id", "variant")
        .agg(F.collect_list(F.struct("shard", "start", "windows")).alias("listed"))
    )
    texts = steps.write(candidates.select("id", "variant", "text").join(listed, ["id", "variant"]), "searched-texts")
    steps.delete("candidates", "searched")
    cold = texts.withColumn("listed", F.filter("listed", lambda x: x["shard"] >= 0)).where(F.size("listed") > 0)
    rows = in_tasks(cold, _with_words, "shard long, " + SEGMENT + ", words binary")
    found = rows.groupBy("shard").applyInArrow(search_shard, SEGMENT)
    hot = texts.withColumn("listed", F.filter("listed", lambda x: x["shard"] < 0)).where(F.size("listed") > 0)
    windows = in_tasks(hot, _window_rows, "one long, two long, " + SEGMENT)
    firsts = windows.groupBy("one", "two").agg(F.min(_position()).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = windows.join(firsts, ["one", "two"]).where(_position() > F.col("first"))
    found = steps.write(found.unionAll(later.select("id", "variant", "start", "windows")), "found")
    steps.delete("searched-texts")
    return found


def repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document (`id`, `variant`) with repeats: `spans`, runs of repeated windows as `start, windows`."""
    steps = _Steps(docs.sparkSession)
    candidates = _survivors(_keyed(docs, id_column, text_column), steps)
    copies, searched = _repeated_segments(candidates, steps)
    found = copies.unionAll(_searched_intervals(candidates, searched, steps))
    spans = found.groupBy("id", "variant").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    spans = steps.write(spans, "spans")
    steps.delete("copies", "found")
    return spans


def kept_words(words: list[bytes], spans: list[dict]) -> list[bytes]:
    """The words that lie under no repeated window."""
    steps = np.zeros(len(words) + 1, np.int64)
    for span in spans:
        steps[span["start"]] += 1
        steps[span["start"] + span["windows"] + WINDOW - 1] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document `doc_id, n_words, n_removed, kept_sha256`."""
    spans = repeats(docs, id_column, text_column)
    keyed = _keyed(docs, id_column, text_column).join(spans, ["id", "variant"], "left").select("id", "text", "spans")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = text.split()
                kept = kept_words(words, found) if found else words
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            words, removed, digests = zip(*rows)
            yield pa.record_batch(
                [batch.column("id"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                ["id", "n_words", "n_removed", "kept_sha256"],
            )

    made = in_tasks(keyed, work, "id long, n_words long, n_removed long, kept_sha256 string")
    return made.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def oracle(documents: str = "documents") -> str:
    """The same as SQL for DuckDB, for unique ids."""
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM {documents}),
w AS (SELECT doc_id, words, unnest(range(0, len(words) - {WINDOW - 1})) AS start FROM d WHERE len(words) >= {WINDOW}),
r AS (SELECT doc_id, start FROM w QUALIFY row_number() OVER (
  PARTITION BY array_to_string(words[start + 1:start + {WINDOW}], ' ') ORDER BY doc_id, start) > 1),
g AS (SELECT DISTINCT doc_id, start + unnest(range(0, {WINDOW})) AS at FROM r),
p AS (SELECT doc_id, unnest(words) AS word, unnest(range(0, len(words))) AS at FROM d),
k AS (SELECT p.doc_id, count(g.at) AS n_removed, string_agg(word, ' ' ORDER BY p.at) FILTER (g.at IS NULL) AS kept
  FROM p LEFT JOIN g ON p.doc_id = g.doc_id AND p.at = g.at GROUP BY 1)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


def clean(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` with repeated words taken out of the texts; a text that loses none stays as it is."""
    key, variant, spans = unused(docs, "key", "variant", "spans")
    found = repeats(docs, id_column, text_column).toDF(key, variant, spans)
    text = F.coalesce(column(text_column).cast("string"), F.lit(""))
    same = (F.coalesce(column(id_column).cast("long"), F.lit(NO_ID)) == F.col(key)) & (F.xxhash64(text) == F.col(variant))
    joined = docs.join(found, same, "left")
    columns = [column(name) for name in docs.columns]
    at = docs.columns.index(text_column)
    names = [f"c{i}" for i in range(len(columns))]
    # Other columns may have any names and types; they pass through as they are.
    plain = joined.select(*[x.alias(name) for x, name in zip(columns, names)], F.col(spans).alias("spans"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = []
            for value, found in zip(batch.column(names[at]).to_pylist(), batch.column("spans").to_pylist()):
                texts.append(b" ".join(kept_words(value.encode().split(), found)).decode() if found else value)
            made = batch.set_column(at, names[at], pa.array(texts, pa.string()))
            yield made.select(names)

    done = in_tasks(plain, work, plain.drop("spans").schema)
    return done.select(*[F.col(name).alias(old) for name, old in zip(names, docs.columns)])
