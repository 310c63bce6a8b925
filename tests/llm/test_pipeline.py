"""The corpus pipeline stage by stage, and registered queries with SQL."""

import duckdb
import pytest

import corpus_pipeline
from lakeloader.llm import queries
from llm_cases import rows_of


def test_stages_over_awkward_rows(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, "")
        assert made.columns == docs.columns, name
        before = {row.doc_id for row in docs.select("doc_id").collect()}
        assert {row.doc_id for row in made.select("doc_id").collect()} <= before
        docs = made
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert {row.doc_id for row in packed.collect()} == {row.doc_id for row in docs.collect()}


def test_stages_over_no_rows(spark, no_documents):
    docs = no_documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def test_whole_run(spark, small_tables):
    made = corpus_pipeline.run(spark, small_tables).collect()
    docs = {row.doc_id for row in spark.read.parquet(f"{small_tables}/documents.parquet").collect()}
    assert {row.doc_id for row in made} <= docs
    assert len({row.doc_id for row in made}) > 0.8 * len(docs)
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_agree_with_sql(spark, small_tables, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{small_tables}/{table}.parquet'")
    known = connection.sql(queries.ORACLES[name])
    columns = sorted(known.columns)
    made = queries.QUERIES[name](spark, small_tables)
    assert sorted(made.columns) == columns
    assert rows_of(made, *columns) == sorted(known.project(", ".join(columns)).fetchall(), key=repr)
