"""Sketches of fine groups, merged upwards, against exact counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinarium.operators import sketches


def test_merged_sketches_equal_sketches_of_all_rows_and_stay_within_the_error(spark):
    rows = spark.range(200_000).select((F.col("id") % 8).alias("brand"), (F.col("id") % 40_000).alias("product"),
                                       (F.col("id") % 5).alias("year"))
    fine = sketches.distinct_sketches(rows, ["brand", "year"], "product")
    found = sketches.distinct_estimates(sketches.merged_sketches(fine, ["brand"])).collect()
    assert len(found) == 8 and all(abs(r["distinct_values"] - 5000) <= 4 * 0.01625 * 5000 + 1 for r in found)
    assert sum(r["rows"] for r in found) == 200_000
    whole = sketches.distinct_estimates(sketches.merged_sketches(fine)).first()
    assert abs(whole["distinct_values"] - 40_000) <= 4 * 0.01625 * 40_000
    assert abs(sketches.standard_error() - 0.01625) < 1e-9


def test_sketches_have_a_bounded_size(spark):
    rows = spark.range(300_000).select(F.lit("a").alias("brand"), F.col("id").cast("string").alias("product"))
    assert sketches.distinct_sketches(rows, ["brand"], "product").select(F.length("sketch").alias("n")).first()["n"] < 3 << 12


def test_nulls_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, None), (None, "x"), ("a", None)], "brand string, product string")
    found = sketches.distinct_estimates(sketches.distinct_sketches(rows, ["brand"], "product")).collect()
    assert sorted((r["brand"] or "", r["rows"], r["distinct_values"]) for r in found) == [("", 2, 1), ("a", 1, 0)]
    assert sketches.distinct_sketches(rows.limit(0), ["brand"], "product").count() == 0


def test_the_error_check_can_fail(spark):
    row = spark.range(1).select(sketches.within_error(F.lit(120), F.lit(100)).alias("far"),
                                sketches.within_error(F.lit(106), F.lit(100)).alias("near")).first()
    assert (row["far"], row["near"]) == (False, True)
