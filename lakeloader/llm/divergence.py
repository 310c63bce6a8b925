"""Source divergence audit with late string materialization.

For every source of a language: how far its use of the language's terms lies from
each other source's (part `pair`), and by which terms it stands out against the
language as a whole (part `term`). Both are chi-square sums of shares that are
scaled to whole numbers, so all arithmetic is exact.

Tasks count terms per language and source and write the counts by digests of 64 bits,
and each digest's term once. Only digests are shuffled with the counts. Once per digest
the smallest and the largest term are compared; where they differ, the digest stands for
several terms: these are counted once more, with their texts, and get numbers that tell
them apart. Terms are joined back to the rows that the result keeps.

The counts of a language are dealt to groups by digest, with the totals of its sources
beside them. A group adds up what its terms give to the pairs of sources; terms that a
source lacks cost nothing, as they all have the same share:

    sum over all terms of f(p, q)
        = sum over the first source's terms of f(p, q) - f(absent, q)
        + sum over the other source's terms of f(absent, q)
        + terms the other source lacks * f(absent, absent there)

Defined results: null text, language and source count as empty; every row is a document
of its own, repeated ones and those that share an id, too; a language without kept terms
has pairs of value 0 and no terms; an empty table gives no rows; other columns of the
input play no part. The sum of counts of a language may reach 9 * 10^15.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloader.llm.base import UPPER, Steps, column, in_tasks, slices

#: Documents of a language a term must be in.
LEAST_DOCUMENTS = 3
#: Terms listed per source.
TERMS_SHOWN = 200
SCALE = 1_000_000_000
DIGEST_BITS = 64
#: A task writes its counts after so many terms, or bytes of text.
TABLE_TERMS, TABLE_BYTES = 1_000_000, 128 << 20
#: Counts in a group of work on average, and sources whose pairs it adds up.
GROUP_ROWS, BLOCK_SOURCES = 20_000, 512
_PIECE = 1 << 20
_CELLS = 1 << 21
#: Bytes of terms: A-Z lower-cased, all other ASCII but letters a blank.
_FOLD = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
COUNTS = "lang string, source string, digest long, term binary, n long, docs long"
_COUNTS = [field.split()[0] for field in COUNTS.split(", ")]
FOUND = "lang string, source string, part string, item string, digest long, variant int, value long"


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + _PIECE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


class _Digests(dict):
    """The digest of each term, made once while the table lasts."""

    def __init__(self, bits: int):
        super().__init__()
        self.mask = (1 << bits) - 1

    def __missing__(self, term: bytes) -> int:
        digest = xxhash.xxh64_intdigest(term) & self.mask
        self[term] = digest = digest - ((digest & 1 << 63) << 1)
        return digest


def _runs(terms: list[bytes], size: int = 50_000) -> Iterator[list[bytes]]:
    return (terms[at : at + size] for at in range(0, len(terms), size))


def _count_terms(batches: Iterator[pa.RecordBatch], bits: int = DIGEST_BITS, spelled: bool = False) -> Iterator[pa.RecordBatch]:
    """Counts by digest, and rows that tell each digest's term; with `spelled` counts with their terms instead."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    entries = read = 0

    def numbers(table: dict, terms: list[bytes]) -> pa.Array:
        return pa.array(np.fromiter(map(table.__getitem__, terms), np.int64, len(terms)))

    def given() -> Iterator[pa.RecordBatch]:
        known = _Digests(bits)
        for (lang, source), (counts, docs) in held.items():
            for terms in _runs(list(counts)):
                size = len(terms)
                shown = pa.array(terms, pa.binary()) if spelled else pa.nulls(size, pa.binary())
                cells = [pa.repeat(lang, size), pa.repeat(source, size), numbers(known, terms), shown, numbers(counts, terms), numbers(docs, terms)]
                yield pa.record_batch(cells, _COUNTS)
        for terms in [] if spelled else _runs(list(known)):
            none, no_name = pa.nulls(len(terms), pa.int64()), pa.nulls(len(terms), pa.string())
            yield pa.record_batch([no_name, no_name, numbers(known, terms), pa.array(terms, pa.binary()), none, none], _COUNTS)

    for batch in slices(batches):
        for lang, source, text in zip(*(x.to_pylist() for x in batch.columns)):
            counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(counts), set()
            for terms in _terms(text):
                counts.update(terms)
                seen.update(terms)
            docs.update(seen)
            entries += len(counts) - before
            read += len(text)
            if entries > TABLE_TERMS or read > TABLE_BYTES:
                yield from given()
                held.clear()
                entries = read = 0
    yield from given()


def _numbered(frame: DataFrame, steps: Steps, bits: int) -> tuple[DataFrame, DataFrame]:
    """Counts by `digest, variant`, and the term of each."""
    rows = steps.write(in_tasks(frame, lambda batches: _count_terms(batches, bits), COUNTS), "term-counts")
    told = rows.where("lang IS NULL").groupBy("digest").agg(F.min("term").alias("least"), F.max("term").alias("most"))
    ends = steps.write(told, "digests")
    counts = rows.where("lang IS NOT NULL").select("lang", "source", "digest", F.lit(0).alias("variant"), "n", "docs")
    single = ends.where("least = most").select("digest", F.lit(0).alias("variant"), F.col("least").alias("term"))
    shared = ends.where("least != most").select("digest")
    if shared.isEmpty():
        return counts, single
    spelled = in_tasks(frame, lambda batches: _count_terms(batches, bits, True), COUNTS)
    apart = steps.write(spelled.join(shared, "digest", "left_semi"), "shared-counts")
    place = F.row_number().over(Window.partitionBy("digest").orderBy("term"))
    split = steps.write(apart.select("digest", "term").distinct().withColumn("variant", place), "shared-digests")
    alone = counts.join(shared, "digest", "left_anti")
    return alone.unionByName(apart.join(split, ["digest", "term"]).drop("term")), single.unionByName(split)


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), in three divisions that stay within 64 bits."""
    rest, made = np.asarray(count, np.int64) + 1, 0
    for _ in range(3):
        rest = rest * 1000
        made = made * 1000 + rest // total
        rest = rest % total
    return 1 + made


def _chi(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class _Totals:
    """The sources of one language, in order of their names."""

    def __init__(self, frame: pa.Table):
        rows = sorted(frame.to_pylist(), key=lambda row: row["source"])
        self.lang, self.names = rows[0]["lang"], [row["source"] for row in rows]
        self.number = {name: i for i, name in enumerate(self.names)}
        self.kept = rows[0]["kept"]
        self.whole = rows[0]["lang_total"] + self.kept
        self.total = np.array([row["total"] for row in rows], np.int64) + self.kept
        self.terms = np.array([row["terms"] for row in rows], np.int64)
        # Without kept terms no share is ever used.
        self.absent = share(np.zeros(len(rows), np.int64), np.maximum(self.total, 1))


def _pair_sums(totals: _Totals, own: range, source: np.ndarray, term: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """What the given terms add to the value of each own source against every source; rows in order of `term`."""
    sums = np.zeros((len(own), len(totals.names)), np.int64)
    absent = totals.absent
    step = max(1, _CELLS // len(totals.names))
    for first in range(0, int(term[-1]) + 1 if len(term) else 0, step):
        low, high = np.searchsorted(term, [first, first + step])
        at, of, p = term[low:high] - first, source[low:high], shares[low:high]
        everywhere = np.tile(absent, (int(at.max()) + 1, 1)) if len(at) else None
        order = np.argsort(of, kind="stable")
        edges = np.searchsorted(of[order], np.arange(len(totals.names) + 1))
        if everywhere is None:
            continue
        everywhere[at, of] = p
        for here in range(len(totals.names)):
            rows = order[edges[here] : edges[here + 1]]
            if not len(rows):
                continue
            if here in own:
                there = everywhere[at[rows]]
                sums[here - own.start] += (_chi(p[rows][:, None], there) - _chi(absent[here], there)).sum(axis=0)
            sums[:, here] += _chi(absent[own.start : own.stop][:, None], p[rows][None, :]).sum(axis=1)
    return sums


def _best(values: np.ndarray) -> np.ndarray:
    """The rows that may be among the first `TERMS_SHOWN`, all ties with the last of them included."""
    if len(values) <= TERMS_SHOWN:
        return np.arange(len(values))
    return np.flatnonzero(values >= -np.partition(-values, TERMS_SHOWN - 1)[TERMS_SHOWN - 1])


def audit_group(key: tuple, terms: pa.Table, frame: pa.Table) -> pa.Table:
    """Sums of pairs and the leading terms of one group of a language's terms, for one block of its sources."""
    _, salt, block = (x.as_py() for x in key)
    totals = _Totals(frame)
    own = range(block * BLOCK_SOURCES, min((block + 1) * BLOCK_SOURCES, len(totals.names)))
    digest, variant, n, lang_n = (terms[x].to_numpy() for x in ("digest", "variant", "n", "lang_n"))
    source = np.array([totals.number[x] for x in terms["source"].to_pylist()], np.int64)
    order = np.lexsort((variant, digest))
    fresh = (np.diff(digest[order]) != 0) | (np.diff(variant[order]) != 0)
    term = np.concatenate((np.zeros(min(len(order), 1), np.int64), np.cumsum(fresh)))
    shares = share(n, totals.total[source])
    made: list[pa.Table] = []

    def add(part: str, sources: list[str], values: np.ndarray, items=None, rows=None) -> None:
        missing = [None] * len(sources)
        picked = [missing] * 2 if rows is None else [digest[rows], variant[rows]]
        columns = [[totals.lang] * len(sources), sources, [part] * len(sources), items or missing, *picked, values]
        made.append(pa.table([pa.array(x, kind) for x, kind in zip(columns, _KINDS)], _NAMES))

    sums = _pair_sums(totals, own, source[order], term, shares[order])
    if salt == 0:
        rest = totals.kept - totals.terms
        sums += rest * _chi(totals.absent[own.start : own.stop][:, None], totals.absent[None, :])
    names = totals.names
    for here in own:
        others = [i for i in range(len(names)) if i != here]
        add("pair", [names[here]] * len(others), sums[here - own.start][others], [names[i] for i in others])
    usual = share(lang_n, np.int64(max(totals.whole, 1)))
    above = np.flatnonzero((shares > usual) & (source >= own.start) & (source < own.stop))
    values = _chi(shares[above], usual[above])
    for here in np.unique(source[above]).tolist():
        rows = above[(of := source[above] == here)]
        best = _best(values[of])
        add("term", [names[here]] * len(best), values[of][best], rows=rows[best])
    return pa.concat_tables(made) if made else pa.table([pa.array([], kind) for kind in _KINDS], _NAMES)


_TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
_NAMES = [field.split()[0] for field in FOUND.split(", ")]
_KINDS = [_TYPES[field.split()[1]] for field in FOUND.split(", ")]


def audit(
    docs: DataFrame, lang_column: str = "lang", source_column: str = "source", text_column: str = "text", digest_bits: int = DIGEST_BITS
) -> DataFrame:
    """`lang, source, part, item, value, rank`: the pairs and the leading terms of every source of every language."""
    steps = Steps(docs.sparkSession)

    def known(name: str):
        return F.coalesce(column(name).cast("string"), F.lit(""))

    frame = docs.select(known(lang_column).alias("lang"), known(source_column).alias("source"), known(text_column).cast("binary").alias("text"))
    counted, names = _numbered(frame, steps, digest_bits)
    counts = counted.groupBy("lang", "source", "digest", "variant").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # One row per source of a language that has the term.
    term = Window.partitionBy("lang", "digest", "variant")
    kept = (
        counts.withColumn("lang_docs", F.sum("docs").over(term)).withColumn("lang_n", F.sum("n").over(term))
        .withColumn("first", F.col("source") == F.min("source").over(term)).where(F.col("lang_docs") >= LEAST_DOCUMENTS)
    )
    kept = steps.write(kept.drop("docs", "lang_docs"), "kept-terms")
    steps.delete("term-counts")
    sums = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"), F.sum(F.col("first").cast("long")).alias("firsts")
    )
    language = Window.partitionBy("lang")
    sources = frame.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").na.fill(0)
    sources = sources.select(
        "lang", "source", "total", "terms", F.sum("firsts").over(language).alias("kept"), F.sum("total").over(language).alias("lang_total")
    )
    sources = steps.write(sources, "sources")
    by_language = sources.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.sum("terms").alias("rows"))
    size = by_language.agg(F.max("sources").alias("sources"), F.sum("rows").alias("rows")).first()
    most, total = size.sources or 1, size.rows or 0
    blocks = -(-most // BLOCK_SOURCES)
    # What a group returns, a row per pair of sources, should not outgrow what it takes.
    salts = max(1, -(-total // max(GROUP_ROWS, most * min(most, BLOCK_SOURCES))))

    def every(name: str, count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)

    dealt = kept.select(
        "lang", F.pmod(F.xxhash64("digest", "variant"), F.lit(salts)).cast("int").alias("salt"), every("block", blocks),
        "source", "digest", "variant", "n", "lang_n",
    )
    beside = sources.select("*", every("salt", salts)).select("*", every("block", blocks))
    key = ("lang", "salt", "block")
    found = steps.write(dealt.groupBy(*key).cogroup(beside.groupBy(*key)).applyInArrow(audit_group, FOUND), "audit")
    steps.delete("kept-terms", "sources")

    group = Window.partitionBy("lang", "source")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranked = F.row_number().over(group.orderBy(F.desc("value"), "item"))
    pairs = pairs.select("lang", "source", "part", "item", "value", ranked.alias("rank"))
    # Spark cuts each group before it shuffles it.
    leading = found.where("part = 'term'").withColumn("place", F.rank().over(group.orderBy(F.desc("value"))))
    leading = leading.where(F.col("place") <= TERMS_SHOWN).join(names, ["digest", "variant"])
    ranked = F.row_number().over(group.orderBy(F.desc("value"), "term"))
    leading = leading.select("lang", "source", "part", F.col("term").cast("string").alias("item"), "value", ranked.alias("rank"))
    return pairs.unionByName(leading.where(F.col("rank") <= TERMS_SHOWN))


def oracle(documents: str = "documents") -> str:
    """The same as SQL for DuckDB, with every term of every source."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM {documents}),
w AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT row) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS lang_n FROM c GROUP BY ALL HAVING sum(docs) >= {LEAST_DOCUMENTS}),
v AS (SELECT lang, count(*) AS kept, sum(lang_n) AS lang_total FROM k GROUP BY 1),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, lang_n FROM g JOIN k USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT lang, source, sum(n) AS total FROM t GROUP BY ALL),
p AS (SELECT t.lang, t.source, term, n, 1 + ({SCALE}::HUGEINT * (n + 1)) // (total + kept) AS p,
  1 + ({SCALE}::HUGEINT * (lang_n + 1)) // (lang_total + kept) AS usual FROM t JOIN s USING (lang, source) JOIN v USING (lang)),
f AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
r AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value FROM g x
  JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source
  UNION ALL SELECT lang, source, 'term', term, (p - usual) * (p - usual) // usual FROM p WHERE n > 0 AND p > usual)
SELECT lang, source, part, item, value::BIGINT AS value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM r QUALIFY part = 'pair' OR rank <= {TERMS_SHOWN}
"""
