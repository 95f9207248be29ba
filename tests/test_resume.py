from __future__ import annotations

from pyspark.sql import functions as F

from opinarium.operators import resume as r
from tests.plans import executed


def ids(spark, *values, **more):
    return spark.createDataFrame([(v,) for v in values], "review_id string")


def listed(df):
    return sorted(x["review_id"] for x in df.collect())


def test_pending_compares_trimmed_text(spark):
    reviews = spark.createDataFrame([(1,), (2,), (3,)], "review_id bigint")
    done = ids(spark, " 1 ", "3\t", "3", "9")
    assert listed(r.pending_reviews(reviews, done)) == [2]


def test_reviews_without_id_are_pending(spark):
    reviews = spark.createDataFrame([(None,), ("a",)], "review_id string")
    assert r.pending_reviews(reviews, ids(spark, "a", None)).count() == 1


def test_known_aspects(spark):
    aspects = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "review_id string, n int")
    assert sorted(x["n"] for x in r.known_aspects(aspects, ids(spark, "a ", "a")).collect()) == [1, 2]


def test_counts(spark):
    row = r.resume_counts(ids(spark, "a", "b", "c"), ids(spark, " a", "a", "z")).first()
    assert tuple(row) == (3, 1, 2)


def test_first_wins(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only"), (None, 1, "x"),
                                (None, 2, "y")], "review_id string, n int, v string").repartition(3)
    rows = {(x["review_id"], x["v"]) for x in r.first_per_key(df, ["review_id"], ["n"]).collect()}
    assert rows == {("a", "early"), ("b", "only"), (None, "x")}


def test_copies_of_one_key_are_reduced_before_the_shuffle(spark):
    df = spark.range(0, 30_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("review_id"),
        F.col("id").alias("n"))
    out = r.first_per_key(df, ["review_id"], ["n"])
    plan = executed(out)
    assert plan.count("WindowGroupLimit") == 2
    assert out.count() == 20_001
    assert out.filter("review_id = 'hot'").first()["n"] == 0


def test_cascade_delete(spark):
    reviews = ids(spark, "a", "b")
    aspects = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "review_id string, n int")
    left, children = r.remove_reviews(reviews, aspects, ids(spark, " b"))
    assert listed(left) == ["a"] and listed(children) == ["a"]


def test_first_pending_deals_the_rows_once(spark):
    rows = spark.createDataFrame([("1", 2), ("1", 1), (" 1", 5), ("2 ", 3), ("3", 4), (None, 6), (None, 7)], "review_id string, n int")
    known = spark.createDataFrame([("2",), (" 3",)], "review_id string")
    found = r.first_pending(rows, known, ["n"])
    assert found.columns == rows.columns
    assert sorted(x["n"] for x in found.collect()) == [1, 5, 6]
    assert executed(found).count("Exchange hashpartitioning") == 2
    plain = r.first_per_key(r.pending_reviews(rows, known), ["review_id"], [])
    assert sorted(map(repr, r.first_pending(rows, known, []).collect())) == sorted(map(repr, plain.collect()))
