"""Reversible names: fixed cases and a property over random paths."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloader.functions import names as N

ALPHABET = "_-x a5fé客#/0X"


@pytest.mark.parametrize(
    "key, encoded",
    [
        ("plain", "plain"), ("a_b", "a_b"), ("a__b", "a_x5f__b"), ("_a", "_x5f_a"), ("a_", "a_x5f_"),
        ("x y", "x_x20_y"), ("x-y", "x_x2d_y"), ("", "_x_"), ("a_xa_b", "a_x5f_xa_b"), ("a_xg", "a_xg"),
        ("a_x5f", "a_x5f_x5f"), ("_", "_x5f_"), ("客é", "客é"), ("a_x", "a_x5f_x"),
    ],
)
def test_encoded_keys(key, encoded):
    assert N.encode_key(key) == encoded
    assert N.decode_name(encoded) == (key,)


@settings(max_examples=3000, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=6), min_size=1, max_size=4))
def test_every_path_comes_back(path):
    assert N.decode_name(N.path_name(tuple(path))) == tuple(path)


def test_no_two_paths_share_a_name():
    rng = random.Random(7)
    seen = {}
    for _ in range(20000):
        path = tuple(
            "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 3))
        )
        for child in (False, True):
            name = N.column_name(path, child)
            assert seen.setdefault((child, name), path) == path


def test_short_keys_are_one_to_one_with_names():
    keys = [""] + [a + b for a in [""] + list(ALPHABET) for b in ALPHABET]
    assert len({N.encode_key(key) for key in keys}) == len(set(keys))


@pytest.mark.parametrize(
    "key, child, name",
    [
        ("_s3_key", False, "_x5f_s3_key"), ("_row_number", False, "_x5f_row_number"),
        ("_index", False, "_index"), ("_index", True, "_x5f_index"), ("_row_key", True, "_x5f_row_key"),
        ("_parent__id", True, "_x5f_parent_x5f__id"), ("_parent__id", False, "_x5f_parent_x5f__id"),
        ("a__b", False, "a_x5f__b"), ("a b", False, "a b"), ("_a", False, "_a"),
    ],
)
def test_top_level_names(key, child, name):
    assert N.top_level_name(key, child) == name


def test_header_names():
    assert N.name_delimited(["a", "a_2", "a", " "]) == ["a", "a_2", "a_3", "column_4"]
    assert N.name_delimited(["id", "name", "name", "", "name"]) == ["id", "name", "name_2", "column_4", "name_3"]


def test_columns_of_names(spark):
    keys = ["a_b", "a__b", "x y", "_s3_key", "a_x1", None, ""]
    rows = spark.createDataFrame([(key,) for key in keys], "key string").select(
        "key",
        N.encode_key_column(F.col("key")).alias("encoded"),
        N.top_level_name_column(F.col("key")).alias("top"),
        N.top_level_name_column(F.col("key"), True).alias("child"),
    )
    for row in rows.collect():
        if row.key is None:
            assert (row.encoded, row.top, row.child) == (None, None, None)
        else:
            assert row.encoded == N.encode_key(row.key)
            assert (row.top, row.child) == (N.top_level_name(row.key), N.top_level_name(row.key, True))
