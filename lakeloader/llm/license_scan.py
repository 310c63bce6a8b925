"""License scan with ordered signatures, in DataFrame expressions only.

A text's words decide by a keyword whether it is scanned at all. In a scanned text
every place whose word begins a signature shows that signature a window of words;
the longest match of a place is its detection. A detection that lies within another
one goes; of two neighbours that overlap in part the one with the smaller priority
stays. Base phrases are counted on their own, and their labels always stay.

No row leaves its partition: there is no shuffle, and a text of any length costs in
proportion to its words. Defined results: null counts as empty; without words all
counts are zero, places null, labels empty and the score 0; repeated rows give
repeated rows.
"""

from __future__ import annotations

import json
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloader.llm.base import ascii_lower, column
from lakeloader.llm.license_rules import Signature, signatures, window

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
DETECTION = "struct<start:int,end:int,label:string,priority:int,relevance:double>"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: list[Signature] | None = None) -> DataFrame:
    """`doc_id, n_words, base_hits, detections` per row.

    `base_hits` are the places of base phrases (`start`, `label`), `detections` the
    intervals of words that are left after suppression. Places count words from 0.
    """
    rules = signatures() if rules is None else rules
    # Base phrases must fit, too.
    width = max(window(rules), *(len(phrase.split()) for phrase in BASE))
    gates = sorted({gate for rule in rules for gate in rule.gates} | {"license", "cc"})
    firsts = sorted({rule.keyword for rule in rules} | {phrase.split()[0] for phrase in BASE})
    by_first: dict[str, list[dict]] = defaultdict(list)
    for rule in rules:
        by_first[rule.keyword].append(
            {"regex": rule.regex, "label": rule.label, "priority": rule.priority, "relevance": rule.relevance}
        )
    known = F.from_json(F.lit(json.dumps(by_first)), "map<string,array<struct<regex:string,label:string,priority:int,relevance:double>>>")

    def place(at: Column) -> Column:
        return F.struct(
            at.alias("start"),
            F.element_at("__words", at + 1).alias("first"),
            F.concat(F.array_join(F.slice("__words", at + 1, width), " "), F.lit(" ")).alias("window"),
        )

    def best(spot: Column) -> Column:
        matches = F.transform(
            F.coalesce(F.try_element_at(known, spot["first"]), F.array().cast("array<struct<regex:string,label:string,priority:int,relevance:double>>")),
            lambda rule: F.struct(
                F.regexp_count(F.regexp_substr(spot["window"], rule["regex"]), F.lit(" ")).alias("length"),
                (-rule["priority"]).alias("strength"), rule["relevance"].alias("relevance"), rule["label"].alias("label"),
            ),
        )
        longest = F.array_max(matches)
        return F.when(
            longest["length"] > 0,
            F.struct(
                spot["start"].alias("start"), (spot["start"] + longest["length"]).alias("end"), longest["label"].alias("label"),
                (-longest["strength"]).alias("priority"), longest["relevance"].alias("relevance"),
            ),
        )

    def base(spot: Column) -> Column:
        found = F.lit(None).cast("string")
        for phrase, label in BASE.items():
            found = F.when(F.startswith(spot["window"], F.lit(phrase + " ")), F.lit(label)).otherwise(found)
        return F.struct(spot["start"].alias("start"), found.alias("label"))

    def within_another(found: Column, at: Column) -> Column:
        # Detections begin at different words and are at most `width` words long.
        earlier = F.slice("__found", F.greatest(at + 2 - width, F.lit(1)), F.least(at, F.lit(width - 1)))
        return F.exists(earlier, lambda other: other["end"] >= found["end"])

    def outranked(found: Column, at: Column) -> Column:
        before, after = F.try_element_at("__whole", at), F.try_element_at("__whole", at + 2)
        by_before = (at > 0) & (before["end"] > found["start"]) & (before["priority"] <= found["priority"])
        by_after = after.isNotNull() & (after["start"] < found["end"]) & (after["priority"] < found["priority"])
        return F.coalesce(by_before, F.lit(False)) | F.coalesce(by_after, F.lit(False))

    text = F.coalesce(column(text_column).cast("string"), F.lit(""))
    steps = docs.select(column(id_column).cast("long").alias("doc_id"), text.alias("__text"))
    # Lower-casing by Unicode keeps every word's place and finds at least what
    # lower-casing A-Z finds; scanned texts are then lower-cased as they should be.
    steps = steps.withColumn("__all", words_of(F.lower("__text")))
    steps = steps.select(
        "doc_id", F.size("__all").cast("long").alias("n_words"),
        F.when(F.arrays_overlap("__all", F.array(*map(F.lit, gates))), F.col("__text")).alias("__text"),
    )
    steps = steps.withColumn("__words", words_of(ascii_lower(F.col("__text"))))
    spots = F.filter(F.sequence(F.lit(0), F.size("__words") - 1), lambda at: F.element_at("__words", at + 1).isin(firsts))
    steps = steps.withColumn("__spots", F.when(F.size("__words") > 0, F.transform(spots, place)))
    steps = steps.withColumn("base_hits", F.filter(F.transform("__spots", base), lambda hit: hit["label"].isNotNull()))
    steps = steps.withColumn("__found", F.filter(F.transform("__spots", best), lambda found: found.isNotNull()))
    steps = steps.withColumn("__whole", F.filter("__found", lambda found, at: ~within_another(found, at)))
    steps = steps.withColumn("__kept", F.filter("__whole", lambda found, at: ~outranked(found, at)))
    return steps.select(
        "doc_id", "n_words",
        F.coalesce("base_hits", F.array().cast("array<struct<start:int,label:string>>")).alias("base_hits"),
        F.coalesce("__kept", F.array().cast(f"array<{DETECTION}>")).alias("detections"),
    )


def summary(scanned: DataFrame) -> DataFrame:
    """Counts, places, labels and the score (the best relevance, at least 0.5 with a base phrase)."""
    base = F.array_sort(F.array_distinct(F.transform("base_hits", lambda hit: hit["label"])))
    labels = F.array_sort(F.array_distinct(F.concat(base, F.transform("detections", lambda found: found["label"]))))
    best = F.array_max(F.transform("detections", lambda found: found["relevance"]))
    return scanned.select(
        "doc_id", "n_words", F.size("base_hits").cast("long").alias("n_base"),
        F.try_element_at("base_hits", F.lit(1))["start"].cast("long").alias("first_word"),
        F.try_element_at("base_hits", F.lit(-1))["start"].cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce(best, F.lit(0.0)), F.when(F.size("base_hits") > 0, 0.5).otherwise(0.0)).alias("score"),
    )


def oracle(documents: str = "documents") -> str:
    """The same as SQL for DuckDB, from the same signatures."""
    quote = "'{}'".format
    rules = ",\n".join(
        f"({quote(r.keyword)}, {quote(r.regex)}, {quote(r.label)}, {r.priority}, {r.relevance}::DOUBLE)" for r in signatures()
    )
    phrases = ", ".join(f"('{phrase} ', '{label}')" for phrase, label in BASE.items())
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH rules(first, regex, label, priority, relevance) AS (VALUES {rules}),
phrases(phrase, label) AS (VALUES {phrases}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{WORD}') AS words
  FROM {documents}),
p AS (SELECT doc_id, words, unnest(range(0, len(words))) AS start FROM d),
s AS (SELECT doc_id, start, words[start + 1] AS first,
    array_to_string(words[start + 1:start + {window(signatures())}], ' ') || ' ' AS seen FROM p
  WHERE words[start + 1] IN (SELECT first FROM rules) OR words[start + 1] IN (SELECT split_part(phrase, ' ', 1) FROM phrases)),
b AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list(DISTINCT label) AS labels
  FROM s JOIN phrases ON starts_with(seen, phrase) GROUP BY 1),
m AS (SELECT doc_id, start, length(regexp_extract(seen, regex)) - length(replace(regexp_extract(seen, regex), ' ', '')) AS size,
    label, priority, relevance FROM s JOIN rules USING (first)),
f AS (SELECT * FROM m WHERE size > 0
  QUALIFY row_number() OVER (PARTITION BY doc_id, start ORDER BY size DESC, priority, relevance DESC, label DESC) = 1),
w AS (SELECT doc_id, start, start + size AS stop, label, priority, relevance FROM f QUALIFY start + size > coalesce(
  max(start + size) OVER (PARTITION BY doc_id ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1)),
k AS (SELECT * FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY start) QUALIFY NOT coalesce(lag(stop) OVER o > start AND lag(priority) OVER o <= priority, false)
  AND NOT coalesce(lead(start) OVER o < stop AND lead(priority) OVER o < priority, false)),
l AS (SELECT doc_id, list(DISTINCT label) AS labels, max(relevance) AS relevance FROM k GROUP BY 1)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(l.labels, [])))), ','), '') AS labels,
  greatest(coalesce(relevance, 0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0 END)::DOUBLE AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id)
"""
