from __future__ import annotations


from opinarium.operators import cleaning, extraction
from opinarium.session import working_folder


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tags_are_removed_once_per_row(spark):
    df = spark.createDataFrame([("<b>x</b>", 4.0)], "review_text string, review_rating double")
    assert optimized(cleaning.clean_reviews(df)).count("regexp_replace") == 1


def test_answers_are_parsed_once_per_row(spark):
    df = spark.createDataFrame([("1", "{}")], "review_id string, raw string")
    valid = extraction.valid_answers(extraction.parse_answers(df))
    assert optimized(valid).lower().count("parsejson(") == 2


def test_filters_on_other_columns_still_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("p", "<b>x</b>", 4.0)], "product_id string, review_text string, review_rating double"
                          ).write.parquet(path)
    cleaned = cleaning.clean_reviews(spark.read.parquet(path)).filter("product_id = 'p'")
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(product_id,p)" in plan
    assert cleaned.count() == 1


def test_working_folder_lies_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = working_folder(spark, "x"), working_folder(spark, "x")
    assert a.startswith(base) and a != b


def test_working_folder_falls_back_to_the_warehouse():
    class Conf:
        def get(self, name, default=None):
            return {"spark.sql.warehouse.dir": "hdfs://shared/warehouse"}.get(name, default)

    class Session:
        conf = Conf()

    assert working_folder(Session(), "x").startswith("hdfs://shared/warehouse/_working/x-")
