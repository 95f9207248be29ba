"""Buckets that the comparison of pairs makes smaller."""

from __future__ import annotations

from opinarium.llm import near_dedup


def _changed(words, at, mark):
    return [mark + w if at <= i < at + 10 else w for i, w in enumerate(words)]


def test_a_large_bucket_that_loses_a_stray_is_still_compared(spark, monkeypatch):
    """Bucket 1 has 5 members and 2 strays. Bucket 2 links one of them, so 5 pairs are left of 10."""
    base = [f"w{i}" for i in range(100)]
    m1, m2 = _changed(base, 0, "a"), _changed(base, 10, "b")
    texts = {0: base, 1: m1, 2: m2, 3: _changed(m1, 20, "c"), 4: _changed(m2, 30, "d"), 5: [f"z{i}" for i in range(100)]}
    buckets = [(1, 0, k) for k in (0, 1, 2, 3, 4)] + [(2, 5, k) for k in (5, 1, 3)]

    def made(sets):
        node = {r["doc_id"]: r["node"] for r in sets.collect()}
        return spark.createDataFrame([(b, node[leader], node[k]) for b, leader, k in buckets],
                                     "bucket long, leader binary, node binary")

    monkeypatch.setattr(near_dedup, "_buckets", made)
    monkeypatch.setattr(near_dedup, "PAIRS_OF_BUCKET", 6)
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in texts.items()], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(docs, 1).collect()}
    assert found == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 5}
