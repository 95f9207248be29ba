"""Gapless numbers, in groups and over all rows."""

from __future__ import annotations

import random

from opinarium.operators.cleaning import cleaning_report, clean_reviews, write_cleaned
from opinarium.operators.numbering import dense_numbers
from opinarium.plans.analysis import aspects_of
from opinarium.session import stored
from opinarium.sources.tables import with_dense_aspect_id


def frame(spark, rows):
    return stored(spark.createDataFrame(rows, "g string, v int, w string").repartition(5), "test")


def test_numbers_follow_the_order_in_every_group(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None, ""]), rng.choice([None, *range(40)]), str(i)) for i in range(500)]
    out = dense_numbers(frame(spark, rows), ["v", "w"], "n", ["g"], total="all").collect()
    for group in {r["g"] for r in out}:
        own = sorted((r for r in out if r["g"] == group), key=lambda r: (r["v"] is not None, r["v"] or 0, r["w"]))
        assert [r["n"] for r in own] == list(range(len(own))) and {r["all"] for r in own} == {len(own)}
    assert sorted(((r["g"], r["v"], r["w"]) for r in out), key=repr) == sorted(rows, key=repr)


def test_equal_rows_spread_over_ranges(spark):
    """One row a thousand times: no task gets them all, and each gets a number of its own."""
    out = dense_numbers(frame(spark, [("a", 1, "x")] * 1000), ["v"], "n", first=1)
    assert sorted(r["n"] for r in out.collect()) == list(range(1, 1001))
    files = [f for f in out.inputFiles() if "ranges" in f]
    assert len(files) > 4


def test_no_rows_and_clashing_columns(spark):
    assert dense_numbers(frame(spark, []), ["v"], "n").collect() == []
    named = stored(spark.createDataFrame([(2, "p"), (1, "q")], "v int, rows_ string"), "test")
    assert sorted(tuple(r) for r in dense_numbers(named, ["v"], "n").collect()) == [(1, "q", 0), (2, "p", 1)]


def test_dense_aspect_ids(spark):
    aspects = spark.createDataFrame([("b", 0), ("a", 1), ("a", 0)], "review_id string, pos long")
    out = with_dense_aspect_id(aspects).collect()
    assert sorted((r["aspect_id"], r["review_id"], r["pos"]) for r in out) == [(1, "a", 0), (2, "a", 1), (3, "b", 0)]


def test_observed_report_equals_the_report(spark, tmp_path):
    raw = spark.createDataFrame([("1", "fine", "3"), ("2", None, "4"), ("3", " ", "2"), ("4", "good", "9"), ("5", "x", None)],
                                "review_id string, review_text string, rating string")
    for df in (raw, raw.limit(0)):
        report = write_cleaned(df, str(tmp_path / "out"))
        assert sorted(map(tuple, report.collect()), key=repr) == sorted(map(tuple, cleaning_report(df).collect()), key=repr)
        written = spark.read.parquet(str(tmp_path / "out"))
        assert sorted(map(tuple, written.collect())) == sorted(map(tuple, clean_reviews(df).collect()))


def test_aspects_of_brands(spark):
    reviews = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "b"), ("3", None)], "review_id string, brand_name string")
    aspects = spark.createDataFrame([("1", "x"), ("2", "y"), ("2", "z"), ("3", "x")], "review_id string, aspect string")
    assert sorted(map(tuple, aspects_of(reviews, aspects, ["b"]).collect())) == [("2", "y"), ("2", "z")]
    assert aspects_of(reviews, aspects, None).count() == 4
