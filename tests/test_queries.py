"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_file
from opinarium.oracles import ORACLES
from opinarium.registry import QUERIES
from tests.comparison import differences, duck

SF_DIR = os.environ.get("OPINARIUM_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_file.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


def test_entry(spark):
    df = entry_file.entry(spark)
    assert df.columns == ["product_id", "brand_name", "product_title", "aspect", "aspect_mentions",
                          "negative_mentions", "negative_rate_pct", "negative_weight_pct"]
    assert df.count() > 0
