"""One query per operator, over its whole table, with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloader.llm import divergence, hash_shards, license_scan, merkle, mixing, substring_dedup, vector_codes, warc
from lakeloader.llm.base import UPPER, table, tokenizer
from lakeloader.llm.exact_dedup import exact_dedup
from lakeloader.llm.language_id import identify
from lakeloader.llm.packing import cut, pack
from lakeloader.llm.piece_codec import encode_decode
from lakeloader.llm.simhash import near_duplicates
from lakeloader.session import fresh_folder

_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP1 = f"""
WITH d AS (SELECT doc_id, sha256({_LOWERED}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


def op2_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), keep=False)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.scan(table(spark, sf_dir, "documents")))


def op4_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_next(table(spark, sf_dir, "documents"))


def op5_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = hash_shards.shard_documents(table(spark, sf_dir, "documents"), fresh_folder(spark, "shards"))
    return hash_shards.read_assignment(sharded)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op9_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = cut(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids"))).drop("ids")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_archives(table(spark, sf_dir, "pages"))
    found = warc.undamaged(warc.read_archives(files))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.summary(mixing.assign(table(spark, sf_dir, "documents")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.summary(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


OP10 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_piece_codec": op2_piece_codec,
    "op3_license_scan": op3_license_scan,
    "op4_merkle": op4_merkle,
    "op5_hash_shards": op5_hash_shards,
    "op6_simhash": op6_simhash,
    "op7_language_id": op7_language_id,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_best_fit": op9_best_fit,
    "op10_warc": op10_warc,
    "op11_source_divergence": op11_source_divergence,
    "op12_source_mix": op12_source_mix,
    "op13_vector_codes": op13_vector_codes,
    "pipeline": pipeline,
}
ORACLES = {
    "op1_exact_dedup": OP1,
    "op3_license_scan": license_scan.oracle(),
    "op5_hash_shards": hash_shards.oracle(),
    "op8_substring_dedup": substring_dedup.oracle(),
    "op10_warc": OP10,
    "op11_source_divergence": divergence.oracle(),
    "op12_source_mix": mixing.oracle(),
    "op13_vector_codes": vector_codes.oracle(),
}
#: Queries SQL can't express; `tests/llm` holds them against plain models.
MODELLED = frozenset({"op2_piece_codec", "op4_merkle", "op6_simhash", "op7_language_id", "op9_best_fit", "pipeline"})
