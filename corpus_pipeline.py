"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes the session, the documents its predecessor kept, and the folder of
the given tables. All but the last return documents with the columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloader.llm import exact_dedup, language_id, packing, simhash, substring_dedup
from lakeloader.llm.base import table, tokenizer
from lakeloader.session import prepare, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model, fitted on these documents, doesn't reject."""
    return language_id.keep_known(docs)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest id."""
    return exact_dedup.drop_repeats(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return simhash.keep_one(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages that stand earlier, too; `n_chars` follows the text."""
    cleaned = substring_dedup.clean(docs)
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in training sequences."""
    return packing.pack(packing.cut(docs, tokenizer("word_bpe_49k.json")))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", distinct_texts),
    ("near_dedup", one_of_near_copies),
    ("substring_dedup", without_repeated_passages),
    ("packing", packed),
]

#: The language model can't be expressed in SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each one's result is written and read again."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
