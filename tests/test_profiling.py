from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from opinarium.operators import profiling as p


def check_describe(spark, columns, accuracy=10_000):
    frame = pd.DataFrame(columns, dtype=float)
    df = spark.createDataFrame(
        [tuple(None if pd.isna(v) else float(v) for v in row) for row in frame.itertuples(index=False)],
        ", ".join(f"{c} double" for c in frame.columns)).repartition(3)
    expected = frame.describe()
    for row in p.describe(df, accuracy=accuracy).collect():
        want = expected[row["column_name"]]
        assert row["count"] == want["count"]
        for mine, theirs in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                             ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            if pd.isna(want[theirs]):
                assert row[mine] is None
            else:
                assert row[mine] == pytest.approx(want[theirs], rel=1e-12)


def test_describe_equals_pandas(spark):
    rng = random.Random(5)
    check_describe(spark, {
        "spread": [rng.gauss(0, 1e6) for _ in range(999)],
        "few": [float(rng.randrange(1, 6)) for _ in range(999)],
        "tail": [rng.paretovariate(0.3) for _ in range(999)],
        "holes": [rng.random() if rng.random() < 0.4 else None for _ in range(999)],
        "same": [3.5] * 999,
        "none": [None] * 999,
    })


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 8])
def test_describe_small(spark, count):
    check_describe(spark, {"x": [float(i * i) for i in range(count)]})


def test_describe_with_a_coarse_sketch_is_still_exact(spark):
    rng = random.Random(9)
    check_describe(spark, {"x": [rng.random() for _ in range(5000)],
                           "hot": [7.0 if i % 3 else rng.random() for i in range(5000)]}, accuracy=20)


def test_describe_takes_numeric_columns(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (3, "b", float("nan"))], "n int, s string, d double")
    rows = {r["column_name"]: r["count"] for r in p.describe(df).collect()}
    assert rows == {"n": 2, "d": 1}


def test_histogram_equals_numpy(spark):
    rng = random.Random(1)
    values = [rng.gauss(50, 20) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double")
    counts, edges = np.histogram(values, bins=20)
    rows = p.histogram(df, "x").collect()
    assert [r["n"] for r in rows] == counts.tolist()
    assert [r["bin_start"] for r in rows] == pytest.approx(edges[:-1].tolist())
    assert [r["bin_end"] for r in rows] == pytest.approx(edges[1:].tolist())


def test_histogram_of_equal_values(spark):
    rows = p.histogram(spark.createDataFrame([(2.0,)] * 3, "x double"), "x", bins=4).collect()
    assert [r["n"] for r in rows] == [0, 0, 3, 0]
    assert (rows[0]["bin_start"], rows[-1]["bin_end"]) == (1.5, 2.5)


def test_value_counts_and_info(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("a", None)], "s string, n int")
    assert [tuple(r) for r in p.value_counts(df, ["s", "n"]).collect()] == [
        ("n", "1", 2), ("s", "a", 2), ("s", "b", 1)]
    assert [tuple(r) for r in p.value_counts(df, ["s", "n"], top=1).collect()] == [
        ("n", "1", 2), ("s", "a", 2)]
    assert [tuple(r) for r in p.column_info(df).collect()] == [
        (0, "s", "string", 3, 3, 2), (1, "n", "int", 2, 3, 2)]
    assert [tuple(r) for r in p.null_counts(df).collect()] == [("s", 0), ("n", 1)]


def test_describe_is_exact_where_the_guess_misses(spark):
    df = spark.range(100_000).select(F.col("id").cast("double").alias("x"))
    row = p.describe(df, ["x"]).first()
    assert (row["p25"], row["p50"], row["p75"]) == (24999.75, 49999.5, 74999.25)
    numbers = df.select(F.col("x").alias("c0"))
    assert p._at_ranks(numbers, {(0, 7): (500.0, 600.0), (0, 99_999): (0.0, 1.0)},
                       [(0.0, 99_999.0)]) == {(0, 7): 7.0, (0, 99_999): 99_999.0}


def test_ranks_among_extreme_values(spark):
    inf, tiny, huge = float("inf"), 5e-324, 1.7e308
    values = [-inf, -inf, -huge, -tiny, 0.0, tiny, 2 * tiny, 1.0, huge, inf]
    numbers = spark.createDataFrame([(v,) for v in values], "c0 double")
    found = p._at_ranks(numbers, {(0, i): (-inf, inf) for i in range(10)}, [(-inf, inf)])
    assert [found[0, i] for i in range(10)] == values


def test_top_values_are_limited_in_every_task(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 300).alias("k"), F.lit("x").alias("c"))
    top = p.value_counts(df, ["k", "c"], top=200)
    assert top.count() == 201
    top.explain()
    shown = capsys.readouterr().out
    assert "TakeOrderedAndProject" in shown and "Window" not in shown
