from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from opinarium.operators import cleaning as c


def report_of(spark, df, **options):
    return {(r["metric"], r["column_name"]): r["value"]
            for r in c.cleaning_report(df, **options).collect()}


def small(spark):
    return spark.createDataFrame([
        ("a1", "lip", "\t<p>lasts all day</p> ", 4.5, "2022-11-30"),
        ("a2", "lip", "\n ", 2.0, "2022-12-01"),
        ("a3", "eye", "smudges", 0.5, "2022-12-02"),
        ("a4", "hair", "cap was cracked", 1.0, None),
    ], "review_id string, product_id string, review_text string, rating double, review_date string")


def test_clean_small_table(spark):
    rows = c.clean_reviews(small(spark)).orderBy("review_id").collect()
    assert [r["review_id"] for r in rows] == ["a1", "a4"]
    assert rows[0]["review_text"] == "lasts all day"
    assert rows[0]["review_date"] == dt.datetime(2022, 11, 30)
    assert rows[1]["review_date"] is None


def test_report_small_table(spark):
    report = report_of(spark, small(spark))
    assert report["rows_before", None] == 4
    assert report["rows_after", None] == 2
    assert report["rows_removed", None] == report["rows_removed_total", None] == 2
    assert report["removed_blank_text", None] == 1
    assert report["removed_invalid_rating", None] == 1
    assert report["missing_values_after", "review_date"] == 1
    assert report["missing_values_after", "review_text"] == 0


def test_ratings_out_of_range_missing_or_textual_are_dropped(spark):
    df = spark.createDataFrame(
        [("a", "1"), ("b", "5.0"), ("c", "0.99"), ("d", "5.01"), ("e", None), ("f", "abc"),
         ("g", "nan"), ("h", "inf")], "review_text string, review_rating string")
    kept = {r["review_text"] for r in c.clean_reviews(df).collect()}
    assert kept == {"a", "b"}


def test_without_rating_column_all_texts_stay(spark):
    df = spark.createDataFrame([("a",), (None,), (" ",)], "review_text string")
    assert [r[0] for r in c.clean_reviews(df).collect()] == ["a"]


def test_optional_columns_are_stripped_typed_and_kept(spark):
    df = spark.createDataFrame(
        [("x", " t ", None, " b ", "10", "n/a", "False", None, "keep me ")],
        "review_text string, review_title string, author string, brand_name string, "
        "mrp string, price string, is_a_buyer string, pro_user string, other string")
    row = c.clean_reviews(df).first()
    assert row.asDict() == {
        "review_text": "x", "review_title": "t", "author": None, "brand_name": "b", "mrp": 10.0,
        "price": None, "is_a_buyer": False, "pro_user": None, "other": "keep me "}
    assert c.clean_reviews(df, missing_flag=True).first()["pro_user"] is True


def test_cleaning_plain_text_twice_changes_nothing(spark):
    once = c.clean_reviews(small(spark))
    assert sorted(c.clean_reviews(once).collect()) == sorted(once.collect())


def test_price_anomalies_keep_rows(spark):
    df = spark.createDataFrame([(100.0, 90.0), (None, 5.0), (0.0, 1.0), (10.0, None), (5.0, 9.0)],
                               "mrp double, price double")
    row = c.price_anomalies(df).first().asDict()
    assert row == {"total_rows": 5, "mrp_missing": 1, "mrp_not_positive": 1, "price_missing": 1,
                   "price_above_mrp": 2}


def test_cleaning_does_not_shuffle(spark):
    plan = c.clean_reviews(small(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_report_reads_the_table_once(spark):
    df = spark.range(10).select(F.lit("x").alias("review_text"))
    plan = c.cleaning_report(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1
