"""Equal scores, scaled and repeated vectors, and a vector that many rows share, against brute force."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opinarium.llm import neighbours


def by_brute_force(rows, asked, k):
    """One cosine at a time, ties to smaller ids."""
    out = {}
    for q, v in rows:
        if asked(q):
            scores = []
            for i, w in rows:
                if i != q:
                    a, b = np.array([v]), np.array([w])
                    scores.append((-((a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))))[0], i))
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(spark, rows, asked, k):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "id long, vector array<double>")
    out = {}
    for r in sorted(neighbours.nearest_neighbours(df, asked, k).collect(), key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_equal_and_scaled_vectors(spark):
    """Every query has fewer than k other vectors in its cluster and its copies; scales are powers of two,
    by which a cosine does not change."""
    random = np.random.default_rng(8)
    rows, ids = [], random.permutation(600).tolist()
    while len(ids) >= 12:
        centre = random.standard_normal(48)
        for _ in range(3):
            near = centre + 0.05 * random.standard_normal(48)
            for scale in (1, 1, 4, 0.125):
                rows.append((ids.pop(), near * scale))
    asked = lambda i: i % 7 == 0
    assert found(spark, rows, F.col("id") % 7 == 0, 5) == by_brute_force(rows, asked, 5)


@pytest.mark.parametrize("scale", [1e-200, 1e200])
def test_scores_of_extreme_vectors(spark, scale):
    random = np.random.default_rng(2)
    rows = [(i, random.standard_normal(8)) for i in range(30)]
    plain = found(spark, rows, F.lit(True), 3)
    assert {q: [i for i, _ in f] for q, f in found(spark, [(i, v * scale) for i, v in rows], F.lit(True), 3).items()} \
        == {q: [i for i, _ in f] for q, f in plain.items()}


def test_places_do_not_change_scores():
    random = np.random.default_rng(4)
    left, right = random.standard_normal((300, 96)), random.standard_normal((1, 96))
    right = np.repeat(right, 300, axis=0)
    who = np.zeros(300, dtype=int)
    scores = neighbours._pair_scores(left, neighbours._norms(left), who, right, neighbours._norms(right), np.arange(300))
    assert len(set(scores.tolist())) == 1


def test_a_vector_of_most_rows(spark):
    """Only k + 1 rows of it are indexed, the limit works before the shuffle, and all of its queries are answered."""
    rows = [(i, np.array([1.0, 2.0, 3.0])) for i in range(3000)] + [(5000 + i, np.array([3.0, 1.0, i])) for i in range(5)]
    out = found(spark, rows, F.col("id") % 100 == 0, 2)
    assert [i for i, _ in out[0]] == [1, 2] and [i for i, _ in out[2900]] == [0, 1] and len(out) == 31
    assert all(s == pytest.approx(1.0, abs=1e-15) for q in range(0, 3000, 100) for _, s in out[q])


def test_no_window_gathers_a_vector(spark):
    from pyspark.sql import Window
    df = spark.createDataFrame([(1, [1.0])], "id long, vector array<double>").distinct()
    placed = df.withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).filter("place <= 6")
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
