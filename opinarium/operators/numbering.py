"""Gapless numbers in a given order, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opinarium.session import stored


def dense_numbers(df: DataFrame, order: Sequence[str], number: str, group: Sequence[str] = (),
                  first: int = 0, total: str | None = None) -> DataFrame:
    """Adds ``number``: ``first``, ``first + 1``, ... in the order of the named columns, anew in
    every group; and ``total``, if named, the rows of the group.

    Rows are dealt to ranges of the order and sorted within them, so a large group spreads over
    many tasks. A prefix sum over the rows counted per group and range gives every range its first
    number. Nulls come first. Rows that are equal in the order are numbered as they are read, so
    give a stored table; the numbers then stay what they are if an executor is lost. The result is
    written to the shared folder. A table without rows gives none.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group, *order]
    # Rows that are equal in the order may lie in several ranges.
    marked = df.withColumn("_read", F.monotonically_increasing_id())
    dealt = marked.repartitionByRange(parts, *keys, "_read").sortWithinPartitions(*keys, "_read")
    placed = stored(dealt.drop("_read").withColumns({
        "_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ranges")

    names = {c: f"_g{i}" for i, c in enumerate(group)}
    own = list(names.values())
    counts = placed.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_least"))
    counts = counts.withColumnsRenamed({**names, "_range": "_of"})
    # One row per group and range.
    within = W.partitionBy(*own) if own else W.partitionBy(F.lit(0))
    before = F.sum("_rows").over(within.orderBy("_of").rowsBetween(W.unboundedPreceding, -1))
    offsets = stored(counts.select(
        *own, "_of", (F.coalesce(before, F.lit(0)) - F.col("_least") + first).alias("_shift"),
        F.sum("_rows").over(within).alias("_total")), "range-offsets")
    match = F.col("_range") == F.col("_of")
    for name, other in names.items():
        match = match & F.col(name).eqNullSafe(F.col(other))
    added = [(F.col("_at") + F.col("_shift")).alias(number)]
    if total:
        added.append(F.col("_total").alias(total))
    return placed.join(offsets, match).select(*df.columns, *added)
