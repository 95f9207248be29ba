"""Dropping copies by narrow digests: values against brute force, and what the plans shuffle."""

from __future__ import annotations

import random
import re

import pytest

from opinarium.llm import exact_dedup


def made(rows):
    choose = random.Random(rows)
    out = []
    for i in range(rows):
        text = choose.choice([None, "", "Hot text", f"Text {choose.randrange(rows // 3)}", f"alone {i}"])
        out.append((choose.choice([None, i, i // 2]), text, choose.choice(["a", "b", None]), choose.randrange(3)))
    return out + out[:40] + [(10**9, "hot TEXT", "z", 1)] * 50


def by_brute_force(rows):
    """Of each text the largest row by id, then by the other columns; null is the smallest."""
    low = lambda text: re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in (r[0], r[1], r[2], r[3]))
    best = {}
    for r in rows:
        if low(r[1]) not in best or key(r) > key(best[low(r[1])]):
            best[low(r[1])] = r
    return best


@pytest.fixture(params=["broadcast list", "filter"])
def way(request, monkeypatch):
    if request.param == "filter":
        monkeypatch.setattr(exact_dedup, "BROADCAST_TEXTS", 0)
    return request.param


def test_one_row_of_each_text(spark, way):
    rows = made(600)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_rows int")
    out = [tuple(r) for r in exact_dedup.drop_copies(docs).collect()]
    assert sorted(out, key=str) == sorted(by_brute_force(rows).values(), key=str)


def test_the_filter_lets_every_repeated_text_through(spark):
    digests = exact_dedup.digested(spark.createDataFrame([(i, f"t{i % 700}") for i in range(1000)], "doc_id long, text string"))
    size = 64 * 1000
    words = exact_dedup.repeated_bits(digests, size)
    flagged = exact_dedup.possibly_repeated(digests, words, size).collect()
    count = {}
    for r in flagged:
        at = [int(r["text_sha256"][i:i + 15], 16) % size for i in (0, 15)]
        for bit in at:
            count[bit] = count.get(bit, 0) + 1
    for r in flagged:
        at = [int(r["text_sha256"][i:i + 15], 16) % size for i in (0, 15)]
        assert r["possible"] == all(count[bit] > 1 for bit in at)
    assert sum(r["possible"] for r in flagged) < 620


def test_no_text_is_shuffled_by_a_word_of_the_filter(spark, monkeypatch):
    """With automatic broadcasts off, whole rows are shuffled once at most, by their digest."""
    monkeypatch.setattr(exact_dedup, "BROADCAST_TEXTS", 0)
    docs = spark.createDataFrame([(i, f"text {i % 50}") for i in range(200)], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = exact_dedup.drop_copies(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert not [k for k in keys if "word" in k] and "_digest" in " ".join(keys)
    # Rows, the list of repeated texts; nothing else.
    assert len(keys) <= 2
