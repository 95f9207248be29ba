"""Collocations against counts of every phrase, and the scans that lead to them."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest

from opinarium.llm import collocations as co
from opinarium.llm.arrays import block_of
from opinarium.llm.bloom import Filter, filters
from opinarium.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F
from tests.comparison import differences, duck

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def by_hand(rows, threshold, first, longest=5):
    places, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            total[lang] += len(words)
            places.update((lang, tuple(words[i:i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in places.items() if a >= threshold and len(p[1]) > 1}
    covered = {(lang, w[i:j]) for (lang, w), a in candidates.items() for i in range(len(w))
               for j in range(i + 2, len(w) + 1) if j - i < len(w) and places[lang, w[i:j]] <= a}
    found = collections.defaultdict(list)
    for (lang, w), a in candidates.items():
        if (lang, w) not in covered:
            cuts = [(places[lang, w[:k]], places[lang, w[k:]]) for k in range(1, len(w))]
            score, k = min((1000 * a * total[lang] // (left * right), k) for k, (left, right) in enumerate(cuts))
            found[lang].append((" ".join(w), a, *cuts[k], total[lang], score))
    out = []
    for lang, own in found.items():
        own.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i, *r) for i, r in enumerate(own[:first], 1)]
    return sorted(out)


def found(spark, rows, threshold, first, parts=3, **options):
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    return sorted(tuple(r) for r in co.collocations(frame, threshold, first, **options).collect())


def prose():
    rng = random.Random(1)
    words = ["the", "The", "of", "é", "big", "bad", "wolf", "x1", "a"]
    gaps = [" "] * 6 + ["  ", "\t", ". ", "\n", ",", " the big bad wolf ran off ", " THE BIG bad wolf ran off "]
    return [(rng.choice(["en", "en", "en", None, "und", "de"]),
             "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.choice([0, 3, 40, 200]))))
            for _ in range(50)] + [("en", None), ("en", ""), ("en", " ., \n"), ("fr", "seul")]


@pytest.mark.parametrize("threshold,first,shards", [(5, 1000, 2), (5, 7, 1)])
def test_equals_counts_of_every_phrase(spark, threshold, first, shards):
    rows = prose()
    expected = by_hand(rows, threshold, first)
    assert found(spark, rows, threshold, first, shards=shards) == expected
    assert len(expected) > 10


def test_hot_language_and_repeated_rows(spark):
    rows = prose()[:20] * 4 + [("en", "a rose is a rose is a rose is " * 300)] * 3
    assert found(spark, rows, 20, 50, parts=5, shards=2) == by_hand(rows, 20, 50)


def test_empty_table_and_further_columns(spark):
    assert found(spark, [], 2, 10) == []
    rows = [("en", "one two three one two")] * 3
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "lang string, text string, part int, id int, n int")
    assert sorted(tuple(r) for r in co.collocations(frame, 3, 9, shards=2).collect()) == by_hand(rows, 3, 9)


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(QUERIES["op11_collocations"](spark, sf), duck(sf), ORACLES["op11_collocations"]) == []


def test_only_active_phrases_are_sent(spark):
    """Of a sequence whose first three words are frequent, only phrases of these are counted, and
    after a cycle none."""
    block = block_of(["a b c d e f"])
    codes = co.word_codes(block, np.array([5], np.uint64))[0]
    keys = spark.createDataFrame([(int(c), i) for i, c in enumerate(codes[:3].view(np.int64).tolist())], "id long, hit int")
    made = filters(keys, "id", 3, {"known": F.lit(True), "recent": F.col("hit") >= 0, "none": F.col("hit") > 9})
    sent = list(co.Scan(False, 5, made["known"], made["recent"]).pairs(codes))
    assert [list(zip(a.tolist(), b.tolist())) for a, b in sent] == [
        [(codes[0], codes[1]), (codes[1], codes[2])]]
    late = list(co.Scan(False, 5, made["known"], made["none"]).pairs(codes))
    assert sum(len(a) for a, _ in late) == 0


def test_filter_holds_every_key():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    words = np.zeros((1 << 20) // 64, np.uint64)
    for half in (keys, keys >> np.uint64(32)):
        place = half & np.uint64((1 << 20) - 1)
        np.bitwise_or.at(words, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
    assert Filter(words).holds(keys).all()
    assert Filter(words).holds(rng.integers(0, 1 << 63, 5000, dtype=np.uint64)).mean() < 0.01
