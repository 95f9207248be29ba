"""Bloom filters of 64-bit keys that Spark builds and every task holds, in a bounded size.

A filter only saves work: what passes it is checked against the keys themselves by a join. Beyond
``MOST_BITS`` it lets more through and nothing else changes.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 24
#: A filter takes between 128 KB and 64 MB.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 29


class Filter:
    """Two bits for each key: its lower and its upper half, modulo the size."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """True for every key (uint64) that was put in, and for few others."""
        found = np.ones(len(keys), dtype=bool)
        mask = np.uint64(len(self.words) * 64 - 1)
        for half in (keys, keys >> np.uint64(32)):
            place = half & mask
            found &= (self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return found


def filters(keys: DataFrame, key: str, count: int, chosen: dict[str, Column]) -> dict[str, Broadcast]:
    """For every name a filter of the keys that its condition holds for, as a broadcast.

    ``count`` is the number of keys. The bits are set by a grouped aggregation; at most
    ``MOST_BITS / 64`` words reach the driver.
    """
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_KEY * max(1, count) - 1).bit_length()))
    places = F.array(F.col(key).bitwiseAND(F.lit(size - 1)),
                     F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(size - 1)))
    bits = keys.select(F.explode(places).alias("place"), *[c.alias(n) for n, c in chosen.items()])
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    found = bits.groupBy(F.shiftright("place", 6).alias("word")).agg(
        *[F.bit_or(F.when(F.col(n), bit).otherwise(F.lit(0).cast("long"))).alias(n) for n in chosen]).toArrow()
    at = found.column("word").to_numpy()
    context, made = keys.sparkSession.sparkContext, {}
    for name in chosen:
        words = np.zeros(size // 64, dtype=np.uint64)
        words[at] = found.column(name).to_numpy().view(np.uint64)
        made[name] = context.broadcast(Filter(words))
    return made
