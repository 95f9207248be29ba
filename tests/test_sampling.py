from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from opinarium.operators import sampling as s

SCHEMA = "review_id string, brand_name string, review_rating double, review_text string"


def expected_ids(rows, n, seed=42):
    """The sample by definition: quota per stratum, then trim or fill in hash order."""
    def place(row):
        return hashlib.md5(f"{seed}|{row[0]}".encode()).hexdigest()

    usable = [r for r in rows if r[3] is not None and r[3].strip()]
    fraction = min(1.0, n / len(usable)) if usable else 0.0
    strata = {}
    for row in usable:
        strata.setdefault((row[1], row[2]), []).append(row)
    tiers = []
    for key, members in strata.items():
        quota = 0 if None in key else round(fraction * len(members))
        for i, row in enumerate(sorted(members, key=place)):
            tiers.append((0 if i < quota else 1, place(row), row[0]))
    return {t[2] for t in sorted(tiers)[:n]}


def make_rows(count, strata, seed, nulls=0.0, hot=None):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        brand = f"b{rng.randrange(strata)}"
        if hot and rng.random() < hot:
            brand = "hot"
        if rng.random() < nulls:
            brand = None
        text = rng.choice(["fine", " ", None, "good", "bad"])
        rows.append((f"r{i}", brand, float(rng.randrange(1, 6)), text))
    return rows


@pytest.mark.parametrize("count, strata, n, nulls, hot", [
    (300, 4, 60, 0.0, None),     # some rounding either way
    (300, 60, 50, 0.0, None),    # many strata below half a row: filled up
    (400, 60, 235, 0.0, None),   # many strata above half a row: trimmed
    (300, 5, 40, 0.35, None),    # a third of the rows has no stratum
    (600, 20, 100, 0.0, 0.4),    # one stratum holds a large part
    (50, 3, 500, 0.2, None),     # fewer rows than asked for
    (300, 4, 1, 0.0, None),
])
def test_stratified_sample_by_definition(spark, count, strata, n, nulls, hot):
    rows = make_rows(count, strata, count + n, nulls, hot)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [r[0] for r in s.stratified_sample(df, n, key=["review_id"]).collect()]
    assert len(got) == len(set(got))
    assert set(got) == expected_ids(rows, n)


def test_rounding_cases_really_trim_and_fill():
    def quota_sum(count, strata, n):
        usable = [r for r in make_rows(count, strata, count + n) if r[3] and r[3].strip()]
        sizes = {}
        for r in usable:
            sizes[r[1], r[2]] = sizes.get((r[1], r[2]), 0) + 1
        return sum(round(n / len(usable) * k) for k in sizes.values())

    assert quota_sum(300, 60, 50) < 50
    assert quota_sum(400, 60, 235) > 235


def test_partitioning_does_not_change_the_sample(spark):
    rows = make_rows(200, 4, 1)
    df = spark.createDataFrame(rows, SCHEMA)
    a = s.stratified_sample(df.repartition(1), 30).collect()
    b = s.stratified_sample(df.repartition(7), 30).collect()
    assert sorted(a, key=repr) == sorted(b, key=repr) and len(a) == 30


def test_seed_changes_the_sample(spark):
    df = spark.createDataFrame(make_rows(200, 4, 1), SCHEMA)
    a, b = (set(s.stratified_sample(df, 30, seed=x).collect()) for x in (1, 2))
    assert a != b


@pytest.mark.parametrize("n", [10, 150, 299])
def test_copies_are_counted_not_lost(spark, n):
    """A third of the rows are copies of one row; the size stays exact."""
    rows = [("same", "b0", 5.0, "copy")] * 100
    rows += [(f"r{i}", f"b{i % 3}", 4.0, f"t{i}") for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = [tuple(r) for r in s.stratified_sample(df, n).collect()]
    assert len(got) == n
    for row in set(got):
        assert got.count(row) <= rows.count(row)


def test_copies_of_one_row_only(spark):
    df = spark.createDataFrame([("same", "b", 5.0, "copy")] * 50, SCHEMA)
    assert s.stratified_sample(df, 20).count() == 20
    assert s.exact_sample(df, 20).count() == 20


def test_repeat_in_steps(spark, monkeypatch):
    monkeypatch.setattr(s, "_EXPLODE_STEP", 4)
    df = spark.createDataFrame([("a", 0), ("b", 4), ("c", 9)], "x string, times bigint")
    out = s._repeat(df, "times").groupBy("x").count().collect()
    assert {r["x"]: r["count"] for r in out} == {"b": 4, "c": 9}


def test_random_sample_takes_the_first_by_hash(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("review_id"))
    order = sorted(range(500), key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())
    for n in (1, 40, 499):
        drawn = {r[0] for r in s.random_sample(df, n, key=["review_id"]).collect()}
        assert drawn == {str(i) for i in order[:n]}


def test_without_strata_columns_a_plain_sample(spark):
    df = spark.createDataFrame([(str(i), "x") for i in range(30)], "review_id string, review_text string")
    assert s.stratified_sample(df, 7).count() == 7


def test_balance(spark):
    df = spark.createDataFrame(
        [("1", "a", 1.0, "x"), ("2", "a", 1.0, "x"), ("3", None, 1.0, "x"), ("4", "b", 2.0, "x")],
        SCHEMA)
    sample = df.filter("review_id in ('1', '3')")
    rows = [tuple(r) for r in s.sample_balance(df, sample).collect()]
    assert rows == [(None, 1.0, 1, 1, 25.0, 50.0), ("a", 1.0, 2, 1, 50.0, 50.0),
                    ("b", 2.0, 1, 0, 25.0, 0.0)]


def test_final_plan_is_a_filter_without_shuffle(spark):
    df = spark.createDataFrame(make_rows(300, 4, 3), SCHEMA)
    sample = s.stratified_sample(df, 50, key=["review_id"])
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan and "Window" not in plan
