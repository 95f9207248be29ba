"""A user's function over groups: parts, rounds, hot groups, null keys."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from opinarium.operators.grouped import grouped

STATE = "low long, high long, n long, widest long"


def _partial(rows):
    return pd.DataFrame({"low": [rows["v"].min()], "high": [rows["v"].max()], "n": [len(rows)], "widest": [len(rows)]})


def _merge(states):
    return pd.DataFrame({"low": [states["low"].min()], "high": [states["high"].max()], "n": [states["n"].sum()],
                         "widest": [states["widest"].max()]})


@pytest.mark.parametrize("fan_in", [2, 3, 64])
def test_a_hot_group_over_many_tasks(spark, fan_in):
    rows = spark.range(0, 60000, 1, 24).select(
        F.when(F.col("id") % 20 == 0, F.col("id") % 7).otherwise(F.lit(99)).alias("k"), F.col("id").alias("v"))
    found = {r["k"]: r for r in grouped(rows, ["k"], _partial, _merge, STATE, fan_in).collect()}
    want = {r["k"]: r for r in rows.groupBy("k").agg(F.min("v").alias("low"), F.max("v").alias("high"),
                                                     F.count("*").alias("n")).collect()}
    assert {k: (r["low"], r["high"], r["n"]) for k, r in found.items()} == \
        {k: (r["low"], r["high"], r["n"]) for k, r in want.items()}
    # No call saw more rows of the hot group than lie in one task.
    assert found[99]["widest"] <= 60000 // 24


def test_null_and_odd_keys_are_groups_of_their_own(spark):
    rows = spark.createDataFrame([(None, None, 1), (None, 1.0, 2), (None, None, 3), ("", float("nan"), 4), ("null", None, 5),
                                  ("a,b", 1.5, 6), ("a,b", 1.5, 6)], "k string, r double, v long")
    found = grouped(rows, ["k", "r"], _partial, _merge, STATE).select("k", F.col("r").cast("string").alias("r"), "low", "n")
    assert sorted(map(repr, found.collect())) == sorted(map(repr, spark.createDataFrame(
        [(None, None, 1, 2), (None, "1.0", 2, 1), ("", "NaN", 4, 1), ("null", None, 5, 1), ("a,b", "1.5", 6, 2)],
        "k string, r string, low long, n long").collect()))


def test_an_empty_table_has_no_groups(spark):
    rows = spark.createDataFrame([], "k string, v long")
    found = grouped(rows, ["k"], _partial, _merge, STATE)
    assert (found.columns, found.count()) == (["k", "low", "high", "n", "widest"], 0)
