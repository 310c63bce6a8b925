"""Mixing sources to target weights by systematic sampling.

Every source has a weight, and the sources together shall give a share of all words.
A source gives at most `MOST_COPIES` times what it has; what it can't give, the others
give by their weights. Within a source every document has the same number of expected
copies, the target by the source's size. The documents stand in a row from the largest
to the smallest, their expected copies are summed up from the start, one random offset
is added, and a document is taken once for every whole number its part of the sum
passes. Neighbours in the row are of like size, so the words taken come near the target.

A source may hold most documents, so none is sorted in one task: rows are dealt to
ranges, numbered within each, and ranges are summed up by their counts. The level to
which all sources fill is found by sums over the sources, one for each time that more
of them reach their bound.

Defined results: null text has size 0; null is a source of its own, the last one; a
source of size 0 has target 0 and is not taken; ids order documents of equal size, a
null id comes last; rows that share source, id and size are documents of their own and
may change places; an empty table gives no rows; other columns of the input play no
part. A seed always gives the same mix.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloader.llm.base import Steps, column, unused

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in their order, over and over.
WEIGHTS = (3, 1, 2)
#: Words of the mix, in hundredths of all words.
PERCENT = 150
MOST_COPIES = 2
SEED = 12
#: Rows of one range; with more than so many ranges they grow, as ranges are sorted with spill.
RANGE_ROWS, RANGES = 20_000, 4096
_SOURCE = ("known", "name")


def numbered(frame: DataFrame, steps: Steps, group: list[str], order: list[Column], label: str) -> DataFrame:
    """Add `at`, the row's place from 0 in its group, without a task that sees a whole group."""
    parts = min(max(1, -(-frame.count() // RANGE_ROWS)), RANGES)
    ranged = frame.repartitionByRange(parts, *group, *order) if group else frame.repartitionByRange(parts, *order)
    # The bounds of the ranges come from a sample, so they are drawn once.
    ranged = steps.write(ranged.withColumn("range", F.spark_partition_id()), label)
    before = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per group and range.
    counts = ranged.groupBy(*group, "range").agg(F.count(F.lit(1)).alias("rows"))
    counts = counts.select(*group, "range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("earlier"))
    within = F.row_number().over(Window.partitionBy(*group, "range").orderBy(*order))
    placed = ranged.withColumn("within", within).join(counts, [*group, "range"])
    return placed.withColumn("at", F.col("earlier") + F.col("within") - 1).drop("range", "within", "earlier")


def _whole(number: int) -> Column:
    return F.lit(Decimal(number)).cast("decimal(38,0)")


def targets(sizes: DataFrame, steps: Steps, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT) -> DataFrame:
    """`known, name, source_size, target` of `known, name, source_size`; all sums are whole numbers."""
    order = [F.desc("known"), F.asc("name")]
    sources = numbered(sizes, steps, [], order, "source-ranges")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % len(weights) + 1).cast("int"))
    sources = steps.write(sources.select(*_SOURCE, "source_size", weight.cast("long").alias("weight")), "sources")
    total = sources.agg(F.sum(F.col("source_size").cast("decimal(38,0)")).alias("n"), F.sum("weight").alias("weight")).first()
    bound = F.col("source_size") * MOST_COPIES
    # The level is rest / (100 * shares) words per unit of weight.
    rest, shares, full = percent * int(total.n or 0), total.weight or 0, -1
    while True:
        over = F.lit(True)
        if shares:
            over = _whole(100 * shares) * bound < _whole(rest) * F.col("weight")
        found = sources.agg(
            F.count_if(over).alias("full"), F.sum(F.when(~over, F.col("weight"))).alias("shares"),
            F.sum(F.when(over, bound).cast("decimal(38,0)")).alias("given"),
        ).first()
        if found.full == full or not shares:
            break
        full, shares = found.full, found.shares or 0
        rest = percent * int(total.n or 0) - 100 * int(found.given or 0)
    filled = (_whole(rest) * F.col("weight")).cast("double") / F.lit(float(100 * shares)) if shares else bound.cast("double")
    return sources.select(*_SOURCE, "source_size", F.when(over, bound.cast("double")).otherwise(filled).alias("target"))


def offset(name: Column, seed: int) -> Column:
    """A number from 0 to 1 that depends on the source and the seed only."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)


def assign(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, seed: int = SEED, id_column: str = "doc_id",
    text_column: str = "text", source_column: str = "source", row_column: str | None = None,
) -> DataFrame:
    """`doc_id, source, size, source_size, target, copies` per document; `row_key` too if a column is named for it."""
    steps = Steps(docs.sparkSession)
    source = column(source_column).cast("string")
    keys = [] if row_column is None else [column(row_column).alias("row_key")]
    light = steps.write(
        docs.select(
            *keys, column(id_column).cast("long").alias("doc_id"), source.isNotNull().alias("known"), F.coalesce(source, F.lit("")).alias("name"),
            F.coalesce(F.regexp_count(column(text_column).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "document-sizes",
    )
    sizes = steps.write(light.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size")), "source-sizes")
    filled = steps.write(targets(sizes, steps, weights, percent), "targets")
    placed = numbered(light, steps, list(_SOURCE), [F.desc("size"), F.asc_nulls_last("doc_id")], "document-ranges")
    steps.delete("document-sizes", "source-sizes", "source-ranges", "sources")
    # One row per source. Spark broadcasts it if it is small, and splits a hot source's rows if not.
    joined = placed.join(filled, list(_SOURCE))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)

    def passed(at: Column) -> Column:
        return F.floor(at.cast("double") * expected + offset(F.col("name"), seed))

    copies = F.least(passed(F.col("at") + 1) - passed(F.col("at")), F.lit(MOST_COPIES))
    return joined.select(
        *([] if row_column is None else ["row_key"]), "doc_id", F.when(F.col("known"), F.col("name")).alias("source"), "size", "source_size",
        "target", copies.cast("int").alias("copies"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all columns as they are."""
    row, copies = unused(docs, "row", "copies")
    steps = Steps(docs.sparkSession)
    # A row's number must be the same wherever it is read.
    keyed = steps.write(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")
    taken = assign(keyed, row_column=row, **options).where("copies > 0").select(F.col("row_key").alias(row), F.col("copies").alias(copies))
    emitted = keyed.join(taken, row).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return emitted.select(*[column(name) for name in docs.columns])


def summary(assigned: DataFrame) -> DataFrame:
    """`doc_id, size, source_size, target, taken`."""
    return assigned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def oracle(documents: str = "documents") -> str:
    """The same as SQL for DuckDB; the level is where the first source in order of bound by weight is not full."""
    weights = ", ".join(map(str, WEIGHTS))
    return f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM {documents}),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [{weights}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}] AS weight
  FROM d GROUP BY 1),
o AS (SELECT *, source_size * {MOST_COPIES} AS bound, row_number() OVER w AS place,
  {PERCENT} * sum(source_size) OVER () - 100 * coalesce(sum(source_size * {MOST_COPIES}) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shares
  FROM s WINDOW w AS (ORDER BY source_size::DOUBLE / weight, source)),
l AS (SELECT place AS first, rest, shares FROM o WHERE 100 * shares * bound >= rest * weight ORDER BY place LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN place < coalesce(first, 1 << 62) THEN bound::DOUBLE
  ELSE (l.rest * weight)::DOUBLE / (100 * l.shares)::DOUBLE END AS target FROM o LEFT JOIN l ON true),
r AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS expected,
  (('0x' || substr(md5('{SEED}:' || coalesce(d.source, '')), 1, 8))::BIGINT)::DOUBLE / 4294967296 AS shift,
  row_number() OVER (PARTITION BY d.source ORDER BY size DESC, doc_id ASC NULLS LAST) AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  size * least(floor(pos::DOUBLE * expected + shift) - floor((pos - 1)::DOUBLE * expected + shift), {MOST_COPIES})::BIGINT AS taken
FROM r
"""
