"""Sharding against a walk of the ring row by row, and how many rows one more shard moves."""

from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from opinarium.llm import sharding


def key():
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.struct(F.col("doc_id"), F.crc32(text.cast("binary")), F.octet_length(text))


def walked(hashes: list[tuple[int, int]], shards: int) -> dict[int, tuple[int, int]]:
    """(shard, slot) of every id: each row waits at the first node clockwise of its hash; a node takes
    rows in the order of the ring while its shard has room, the others go on to the next with room."""
    nodes = sharding.ring(shards)
    points = [p for p, _ in nodes]
    waiting = [[] for _ in nodes]

    def clockwise(h):
        point = h >> (64 - sharding.POINT_BITS)
        node = next((i for i, p in enumerate(points) if p >= point), 0)
        return node, node == 0 and point <= points[0], h

    for h, i in sorted(hashes, key=lambda x: clockwise(x[0])):
        waiting[clockwise(h)[0]].append(i)
    room = [len(hashes) // shards + (s < len(hashes) % shards) for s in range(shards)]
    out, filled = {}, [0] * shards
    while any(waiting):
        moving = [[] for _ in nodes]
        for at, (_, shard) in enumerate(nodes):
            for i in waiting[at]:
                if filled[shard] < room[shard]:
                    out[i] = (shard, filled[shard])
                    filled[shard] += 1
                else:
                    moving[at].append(i)
        waiting = [[] for _ in nodes]
        for at, left in enumerate(moving):
            to = (at + 1) % len(nodes)
            while left and filled[nodes[to][1]] >= room[nodes[to][1]]:
                to = (to + 1) % len(nodes)
            waiting[to].extend(left)
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, None if i % 50 == 0 else f"text é {i}") for i in range(5000)]
    return spark.createDataFrame(rows, "doc_id long, text string").cache()


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_rows_go_where_the_walk_takes_them(docs, shards):
    hashes = [(r["h"] % (1 << 64), r["doc_id"]) for r in docs.select("doc_id", F.xxhash64(key()).alias("h")).collect()]
    found = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_documents(docs, shards).collect()}
    assert found == walked(hashes, shards)


def test_sizes_and_digests(docs):
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    for r in sharding.shard_documents(docs).collect():
        assert (r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 1, zlib.crc32(texts[r["doc_id"]]))


def test_one_more_shard_moves_few_rows(docs):
    """A seventeenth of the rows must move; capacities one apart cost some more, but far from all."""
    before, after = ({r["doc_id"]: r["shard"] for r in sharding.shard_documents(docs, n).collect()} for n in (16, 17))
    moved = [i for i in before if before[i] != after[i]]
    assert 1 / 17 - 0.01 <= len(moved) / len(before) <= 0.25
    assert sum(after[i] != 16 for i in moved) <= 0.15 * len(before)
