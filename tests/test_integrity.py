from __future__ import annotations

from opinarium.operators import integrity as g
from opinarium.operators import profiling as p


def test_primary_key_status(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "review_id string")
    assert tuple(g.check_primary_key(df).first()) == (3, 2, g.KEY_BROKEN)
    assert tuple(g.check_primary_key(df.distinct()).first()) == (2, 2, g.KEY_OK)


def test_orphans(spark):
    parent = spark.createDataFrame([("a",), ("a",)], "review_id string")
    child = spark.createDataFrame([("a", 1), ("x", 2), (None, 3)], "review_id string, n int")
    assert [tuple(r) for r in g.check_foreign_key(child, parent).collect()] == [("x", 2)]


def test_rules(spark):
    reviews = spark.createDataFrame(
        [("a", "great", "llm"), (None, None, None), ("c", "mixed", "llm")],
        "review_id string, overall_sentiment string, extraction_method string")
    aspects = spark.createDataFrame(
        [("a", "finish", "positive", "oops"), ("a", None, "bad", None), ("b", "x", None, "y")],
        "review_id string, aspect string, aspect_sentiment string, issue string")
    got = {(r["table_name"], r["column_name"], r["rule"]): r["violations"]
           for r in g.check_tables(reviews, aspects).collect()}
    assert got == {
        ("reviews", "review_id", "not_null"): 1,
        ("reviews", "overall_sentiment", "not_null"): 1,
        ("reviews", "overall_sentiment", "domain"): 1,
        ("reviews", "extraction_method", "not_null"): 1,
        ("review_aspects", "review_id", "not_null"): 0,
        ("review_aspects", "aspect", "not_null"): 1,
        ("review_aspects", "aspect_sentiment", "not_null"): 1,
        ("review_aspects", "aspect_sentiment", "domain"): 1,
        ("review_aspects", "issue", "only_on_negative"): 1,
    }


def test_counts_and_provenance(spark):
    a, b = spark.range(3), spark.range(0)
    assert [tuple(r) for r in g.row_counts({"a": a, "b": b}).collect()] == [("a", 3), ("b", 0)]
    df = spark.createDataFrame([("llm",), ("llm",), ("fixture",)], "extraction_method string")
    assert [tuple(r) for r in g.provenance(df).collect()] == [("fixture", 1), ("llm", 2)]


def test_duplicate_rows_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1), ("a", 2)], "x string, y int")
    assert tuple(p.duplicate_rows(df).first()) == (4, 1)
    assert tuple(p.duplicate_rows(df.limit(0)).first()) == (0, 0)
