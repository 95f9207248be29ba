"""Connected components of a graph by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinarium.llm.arrays import mapped
from opinarium.session import removed, stored, stored_at

#: Links that a task turns into stars at once.
LINKS_AT_ONCE = 1 << 18
#: Tasks that turn links into stars and write them, unless the cluster runs more side by side.
STAR_TASKS = 16


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest among its neighbours and itself."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    down = _downwards(edges)
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _downwards(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _in_few_tasks(edges: DataFrame) -> DataFrame:
    return edges.coalesce(max(STAR_TASKS, edges.sparkSession.sparkContext.defaultParallelism))


def _starred(a: pa.Array, b: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Links of the same components, from every node but the smallest of each to that one."""
    names = pc.unique(pa.concat_arrays([a, b]))
    names = names.take(pc.sort_indices(names))
    left, right = (pc.index_in(side, names).to_numpy() for side in (a, b))
    least = np.arange(len(names))
    while True:
        low, high = np.minimum(least[left], least[right]), np.maximum(least[left], least[right])
        if (low == high).all():
            break
        np.minimum.at(least, high, low)
        while (least != least[least]).any():
            least = least[least]
    linked = np.flatnonzero(least != np.arange(len(names)))
    return names.take(pa.array(linked)), names.take(pa.array(least[linked]))


def _contracted(edges: DataFrame) -> DataFrame:
    """The same components with the links that a task holds turned into stars, so many at a time."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in edges.schema])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += len(batch)
            if count >= LINKS_AT_ONCE:
                yield star(held)
                held, count = [], 0
        if count:
            yield star(held)

    def star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        sides = [pa.concat_arrays([batch.column(c) for batch in held]) for c in ("a", "b")]
        return pa.RecordBatch.from_arrays(list(_starred(*sides)), ["a", "b"])

    return _downwards(mapped(_in_few_tasks(edges.select("a", "b")), run, schema))


def _unsettled(edges: DataFrame) -> bool:
    """Whether the links, from larger to smaller nodes, are anything but stars around the smallest."""
    lower = F.when(F.col("b") < F.col("a"), F.col("b"))
    nodes = _both(edges).groupBy("a").agg(
        F.min(lower).alias("least"), F.max(lower).alias("most"), F.max(F.col("b") > F.col("a")).alias("above"))
    wrong = (F.col("least") != F.col("most")) | (F.col("least").isNotNull() & F.col("above"))
    return nodes.agg(F.count_if(wrong)).first()[0] > 0


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it can reach, for every node of ``links`` but the
    roots themselves. ``links`` has columns a and b of any ordered type; loops and repeats do no harm.

    Each round is written to the shared folder, which also ends the lineage. A task first turns the
    links it holds into stars, so that only what lies across tasks is left to the rounds. The rounds
    needed grow with the logarithm of the longest path. Hub nodes are aggregated before the shuffle.
    """
    edges, folder = stored_at(_contracted(links.filter("a <> b")), "links")
    while _unsettled(edges):
        edges, new_folder = stored_at(_contracted(_small_star(_large_star(edges))), "links")
        removed(edges.sparkSession, folder)
        folder = new_folder
    settled = stored(_in_few_tasks(edges.distinct()), "stars")
    removed(edges.sparkSession, folder)
    return settled.select(F.col("a").alias("node"), F.col("b").alias("root"))
