from __future__ import annotations

from opinarium.operators.resume import pending_reviews, remove_reviews
from tests.plans import executed


def test_a_delete_sorts_no_rows(spark):
    """Only distinct ids are held by a task; the rows of both tables stream past them."""
    reviews = spark.createDataFrame([(str(i), "x") for i in range(50)], "review_id string, brand_name string")
    aspects = spark.createDataFrame([(str(i % 60), "a") for i in range(200)], "review_id string, aspect string")
    ids = spark.createDataFrame([(f" {i} ",) for i in range(0, 50, 2)] * 3, "review_id string")
    for left in remove_reviews(reviews, aspects, ids):
        assert "SortMergeJoin" not in executed(left) and "ShuffledHashJoin" in executed(left)
        assert "_id_key" not in left.columns
        assert {int(r["review_id"]) % 2 for r in left.filter("review_id < 50").collect()} == {1}


def test_a_row_without_id_stays(spark):
    rows = spark.createDataFrame([(None, "n"), (" 1", "a"), ("2", "b")], "review_id string, brand_name string")
    ids = spark.createDataFrame([("1",), (None,)], "review_id string")
    assert sorted(r["brand_name"] for r in pending_reviews(rows, ids).collect()) == ["b", "n"]
    assert sorted(r["brand_name"] for r in remove_reviews(rows, rows, ids)[0].collect()) == ["b", "n"]
