"""Consistent hashing with virtual nodes and bounded loads.

Shards own virtual nodes on a ring of points. A row belongs to the first node clockwise of the
hash of its key. Each shard has a capacity; what a full shard cannot take continues clockwise to
the next node of a shard with room. Capacities here differ by one at most, so the numbers of rows
do too, and a row only leaves its own shard if that one overflows.

The rows of an arc, the stretch of the ring that ends at a node, are ordered by hash, and an
overflow takes its end. So an arc falls into few consecutive ranges, each for one shard. These
ranges follow from the number of rows of each arc alone; rows find theirs by rank. A rank is the
sum of counts of finer cells before it plus the rank in its cell, and there are so many cells that
each has a bounded number of rows on average. Equal rows share a hash, so they are counted before
the shuffle and multiplied after it.

Null keys and null texts count as empty. Rows that repeat are rows of their own. An empty table
gives no rows. Only key, size and digest of a row are shuffled, never its text.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinarium.session import stored

POINT_BITS = 12
NODES_PER_SHARD = 32
#: Rows of a cell on average.
CELL_ROWS = 4096
#: Copies of one row are multiplied in parts of so many.
PART_COPIES = 4096


def ring(shards: int) -> list[tuple[int, int]]:
    """(point, shard) of every virtual node, by point. More shards only add nodes."""
    taken: dict[int, int] = {}
    for shard in range(shards):
        for replica in range(NODES_PER_SHARD):
            digest = hashlib.md5(f"shard {shard} node {replica}".encode()).digest()
            point = int.from_bytes(digest[:4], "big") >> (32 - POINT_BITS)
            while point in taken:
                point = (point + 1) % (1 << POINT_BITS)
            taken[point] = shard
    return sorted(taken.items())


def arc_ranges(counts: dict[int, int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, slot of the first rank) for all rows.

    ``counts`` has the rows of each arc, named by the point of its node. In each round every
    shard takes from its nodes, in ring order, what it has room for; the rest moves to the next
    node of a shard with room. A range is cut only when its shard becomes full.
    """
    nodes = ring(shards)
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    slot = [0] * shards
    waiting = [[(point, 0, counts[point])] if counts.get(point) else [] for point, _ in nodes]
    ranges = []
    while any(waiting):
        moving: list[list] = [[] for _ in nodes]
        for i, (_, shard) in enumerate(nodes):
            for arc, low, high in waiting[i]:
                take = min(room[shard], high - low)
                if take:
                    ranges.append((arc, low, low + take, shard, slot[shard]))
                    room[shard] -= take
                    slot[shard] += take
                if low + take < high:
                    moving[i].append((arc, low + take, high))
        waiting = [[] for _ in nodes]
        for i, left in enumerate(moving):
            j = (i + 1) % len(nodes)
            while left and not room[nodes[j][1]]:
                j = (j + 1) % len(nodes)
            waiting[j].extend(left)
    return ranges


def assign_shards(rows: DataFrame, key: Column, carried: dict[str, Column], shards: int,
                  cell_rows: int = CELL_ROWS) -> DataFrame:
    """Per row the ``carried`` columns, its ``shard`` and its ``slot`` there, gapless from 0."""
    spark = rows.sparkSession
    names = list(carried)
    keyed = rows.select(*(c.alias(n) for n, c in carried.items()), F.xxhash64(key).alias("_hash"))
    equal = stored(keyed.groupBy(*names, "_hash").agg(F.count("*").alias("_copies")), "ring-rows")
    total = equal.agg(F.sum("_copies")).first()[0] or 0
    bits = POINT_BITS + max(0, (total // cell_rows >> POINT_BITS).bit_length())
    # The order of the ring is that of the unsigned hash.
    cell = F.shiftrightunsigned(F.col("_hash"), 64 - bits)
    nodes = [point for point, _ in ring(shards)]
    owner, at = [], 0
    for point in range(1 << POINT_BITS):  # a fixed number of points
        at += at < len(nodes) and nodes[at] < point
        owner.append((point, nodes[at % len(nodes)]))
    arcs = spark.createDataFrame(owner, "_point int, _arc int")

    celled = equal.withColumn("_cell", cell)
    sizes = celled.groupBy("_cell").agg(F.sum("_copies").alias("_rows"))
    sizes = sizes.withColumn("_point", F.shiftrightunsigned("_cell", bits - POINT_BITS).cast("int"))
    sizes = stored(sizes.join(F.broadcast(arcs), "_point").drop("_point"), "ring-cells")
    counts = {r["_arc"]: r["n"] for r in sizes.groupBy("_arc").agg(F.sum("_rows").alias("n")).collect()}
    # The arc of the first node begins behind the last one, so its cells wrap around.
    wraps = F.when((F.col("_arc") == nodes[0]) &
                   (F.shiftrightunsigned("_cell", bits - POINT_BITS) <= nodes[0]), 1).otherwise(0)
    earlier = Window.partitionBy("_arc").orderBy(wraps, "_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_cell", "_arc", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))

    in_cell = Window.partitionBy("_cell").orderBy(
        F.expr("_hash ^ (-9223372036854775807 - 1)"), *names).rowsBetween(Window.unboundedPreceding, -1)
    ranked = celled.withColumn("_rank", F.coalesce(F.sum("_copies").over(in_cell), F.lit(0))) \
        .join(starts, "_cell").withColumn("_rank", F.col("_rank") + F.col("_before"))
    ranges = spark.createDataFrame(arc_ranges(counts, shards),
                                   "_arc int, _low long, _high long, shard int, _slot long")
    single = ranked.filter("_copies = 1").select(*names, "_arc", "_rank")
    parts = ranked.filter("_copies > 1").select("*", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(PART_COPIES).cast("long"))).alias("_part"))
    parts = parts.repartition(F.col("_hash"), F.col("_part"))
    several = parts.select(*names, "_arc", F.explode(F.sequence(
        F.col("_rank") + F.col("_part"),
        F.col("_rank") + F.least(F.col("_part") + PART_COPIES, F.col("_copies")) - 1)).alias("_rank"))
    # At most one range per node and one more per shard: a bounded number of rows.
    placed = single.unionByName(several).join(F.broadcast(ranges), "_arc") \
        .filter("_low <= _rank and _rank < _high")
    return placed.select(*names, "shard", (F.col("_slot") + F.col("_rank") - F.col("_low")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``rows``: numbers of rows are at most one apart. A row's place on the ring follows
    from its id and its text, so rows that share an id spread over the ring.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    carried = {"doc_id": F.col("doc_id"), "size": (F.octet_length(text) + 1).cast("long"),
               "text_crc32": F.crc32(text.cast("binary"))}
    key = F.struct(F.col("doc_id"), F.crc32(text.cast("binary")), F.octet_length(text))
    return assign_shards(docs, key, carried, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
