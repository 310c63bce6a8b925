"""One query per area against its SQL. `check_queries.py` runs them all."""

import pytest
from check_queries import compare, connect, spark_entry

FOLDER = "/root/testdata/sf0.001"
NAMES = (
    "layout_streams", "layout_strip_tokens", "name_encoding", "scan_csv_ragged", "scan_json_wrapper",
    "explode_grandchild", "explode_child_jsonl", "convert_errors", "infer_kinds_events", "inc_targets",
    "inc_window_after_failure", "stream_sync", "discover_newest_unparsable", "infer_placeholders",
)


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, tables, name):
    assert compare(spark, tables, FOLDER, name) is None


@pytest.mark.parametrize("module", spark_entry._MODULES, ids=lambda module: module.__name__)
def test_every_query_has_sql_or_a_model(module):
    """A module names the queries that SQL can't express; its tests hold them against a plain model."""
    modelled = getattr(module, "MODELLED", frozenset())
    assert not modelled & set(module.ORACLES)
    assert set(module.ORACLES) | modelled == set(module.QUERIES)


def test_names_are_used_once():
    assert sum(len(module.QUERIES) for module in spark_entry._MODULES) == len(spark_entry.queries())
    assert sum(len(module.ORACLES) for module in spark_entry._MODULES) == len(spark_entry.oracle_sql())


def test_entry(spark):
    frame = spark_entry.entry(spark)
    assert frame.count() > 0 and "_row_key" in frame.columns
