"""Samples whose bounds are found through many levels of cells."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from opinarium.operators import sampling as s
from tests.test_sampling import SCHEMA, expected_ids, make_rows


@pytest.fixture(params=[0, 3])
def small_cells(request, monkeypatch):
    """Cells of one digit, cut until they hold a row or a few."""
    monkeypatch.setattr(s, "CELL_DIGITS", 1)
    monkeypatch.setattr(s, "CELL_ROWS", request.param)
    if not request.param:
        monkeypatch.setattr(s, "SMALL_SAMPLE", -1)


@pytest.mark.parametrize("count, strata, n, nulls, hot", [
    (300, 4, 60, 0.0, None), (400, 60, 235, 0.0, None), (300, 5, 40, 0.35, None), (600, 20, 100, 0.0, 0.8)])
def test_strata_at_any_depth(spark, small_cells, count, strata, n, nulls, hot):
    rows = make_rows(count, strata, count + n, nulls, hot)
    df = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    got = [r[0] for r in s.stratified_sample(df, n, key=["review_id"]).collect()]
    assert len(got) == len(set(got)) and set(got) == expected_ids(rows, n)


@pytest.mark.parametrize("n", [0, 1, 37, 250, 251])
def test_random_rows_and_copies_at_any_depth(spark, small_cells, n):
    df = spark.createDataFrame([(i % 9 if i < 200 else i,) for i in range(250)], "a int")
    whole, got = [r[0] for r in df.collect()], [r[0] for r in s.random_sample(df, n).collect()]
    assert len(got) == min(n, 250) and all(got.count(a) <= whole.count(a) for a in set(got))
    hashed = df.distinct().withColumn("h", s.order_hash(df, s.DEFAULT_SEED, None)).orderBy("h").collect()
    in_order = [r["a"] for r in hashed for _ in range(whole.count(r["a"]))]
    assert sorted(got) == sorted(in_order[:n])


def test_no_cell_above_the_bound_is_ordered(spark, monkeypatch):
    """One stratum of many rows: cells are cut until a task orders at most the bound."""
    monkeypatch.setattr(s, "CELL_ROWS", 16)
    ordered, within = [], s._within

    def watched(rows, plan, strata, digits):
        ordered.append(within(rows, plan, strata, digits).groupBy("_open").count().agg(F.max("count")).first()[0] or 0)
        return within(rows, plan, strata, digits)

    monkeypatch.setattr(s, "_within", watched)
    df = spark.range(400_000).select("id", F.lit("hot").alias("brand_name"))
    assert s.exact_sample(df, 100_000, ["brand_name"], key=["id"]).count() == 100_000
    assert len(ordered) > 1 and ordered[0] > 16 >= ordered[-1]
