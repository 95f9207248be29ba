"""Tables laid out by brand: odd brands, hot brands, and which folders are read."""

from __future__ import annotations

import glob
import uuid

import pytest
from pyspark.sql import functions as F

from opinarium.sources import brand_layout

BRANDS = [None, "", "007", "1e3", "2020-01-01", "none", "b:", "A/B =%", "é", "plain", "PLAIN"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("brands"))


def key(row):
    return tuple((v is not None, str(v)) for v in row)


@pytest.fixture(scope="module")
def laid_out(spark, folder):
    rows = [(i, BRANDS[i % len(BRANDS)], f"text {i}") for i in range(220)]
    df = spark.createDataFrame(rows, "id long, brand_name string, note string")
    return rows, brand_layout.write_by_brand(df, f"{folder}/odd")


def read(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def test_all_rows_come_back(spark, laid_out):
    rows, table = laid_out
    assert read(table.rows(spark).drop("brand_part")) == sorted(rows, key=key)


@pytest.mark.parametrize("brands", [[b] for b in BRANDS] + [[None, "", "plain"], ["absent"], []])
def test_listed_brands(spark, laid_out, brands):
    rows, table = laid_out
    found = table.of_brands(spark, brands)
    assert found.columns == ["id", "brand_name", "note"]
    assert read(found) == sorted((r for r in rows if r[1] in brands), key=key)


def test_chosen_brands_repeat_no_rows(spark, laid_out):
    rows, table = laid_out
    chosen = spark.createDataFrame([("007",), ("007",), (None,), ("",), ("absent",)], "brand_name string")
    assert read(table.of_chosen(spark, chosen)) == sorted((r for r in rows if r[1] in ("007", None, "")), key=key)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_folders_are_left_out(spark, laid_out, folder):
    _, table = laid_out
    listed = plan_of(table.of_brands(spark, ["plain", "é"]))
    assert "PartitionFilters: [brand_part" in listed and "b:plain" in listed
    assert len(table.of_brands(spark, ["plain"]).inputFiles()) <= len(table.rows(spark).inputFiles())
    assert table.of_brands(spark, ["plain"]).select(F.input_file_name().alias("f")).distinct().count() == 1
    spark.createDataFrame([(b, i) for i, b in enumerate(BRANDS)], "brand_name string, sold int").write.parquet(f"{folder}/sold")
    chosen = table.of_chosen(spark, spark.read.parquet(f"{folder}/sold").filter("sold >= 9"))
    assert "dynamicpruning" in plan_of(chosen)
    assert {r["brand_name"] for r in chosen.collect()} == {"plain", "PLAIN"}


def test_a_hot_brand_is_written_by_many_tasks(spark, folder):
    df = spark.range(9000).select("id", F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("brand_name"))
    # Else adaptive execution puts so few bytes into one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = brand_layout.write_by_brand(df, f"{folder}/hot", rows_per_file=500)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = glob.glob(f"{folder}/hot/brand_part=b%3Ahot/*.parquet") + glob.glob(f"{folder}/hot/brand_part=b:hot/*.parquet")
    assert len({f.rpartition("part-")[2].split("-")[0] for f in files}) > 1
    assert table.of_brands(spark, ["hot"]).count() == 8100


def test_empty_table_and_clashing_column(spark, folder):
    empty = brand_layout.write_by_brand(spark.createDataFrame([], "id long, brand_name string"), f"{folder}/{uuid.uuid4().hex}")
    assert empty.rows(spark).collect() == [] and empty.of_brands(spark, ["x"]).collect() == []
    with pytest.raises(ValueError, match="brand_part"):
        brand_layout.write_by_brand(spark.createDataFrame([(1, "a")], "brand_part int, brand_name string"), folder)


def test_aspects_take_the_brand_of_their_review(spark, folder):
    reviews = spark.createDataFrame([("1", "a"), ("2", None), ("1", "b")], "review_id string, brand_name string")
    aspects = spark.createDataFrame([("1", "x"), ("1", "x"), ("2", "y"), ("3", "z")], "review_id string, aspect string")
    table = brand_layout.write_aspects_by_brand(reviews, aspects, f"{folder}/aspects")
    assert read(table.rows(spark).select("review_id", "aspect", "brand_name")) == [
        ("1", "x", "a"), ("1", "x", "a"), ("2", "y", None)]
