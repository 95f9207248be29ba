"""An index of seen ids that a batch reads only where it must.

Ids lie in hash buckets. Every batch adds to each bucket that it meets a file of its ids and a Bloom
filter over them. A later batch asks the filters of its own buckets which of its ids may have been
seen, and by which batches; only those files are read, and only of the buckets concerned. Ids that
no filter holds are new without a look at any id. What is read does not grow with the table but with
the repeats, apart from the filters, which take two bytes an id in the buckets that a batch meets.

A batch that is repeated replaces its own files and does not see its own ids. Ids may repeat within a
batch; a null id is never seen. Choose so many buckets that the ids of one batch in one of them fit
into a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinarium.session import stored
from opinarium.sources.files import read_or_empty

#: Buckets of an index; all batches of one index must agree.
BUCKETS = 256
BITS_PER_KEY = 16
#: Batches whose files are named one by one in a filter of partitions.
_LISTED = 2000
_FILTERS = "bucket int, run string, batch_id long, ids long, bits binary"


def _positions(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Three places of every 64-bit key in a filter of so many bits (a power of two)."""
    mask = np.uint64(bits - 1)
    for shift in (0, 21, 42):
        yield (keys >> np.uint64(shift)) & mask


def filter_bits(keys: np.ndarray) -> bytes:
    """A Bloom filter of the keys (uint64), of 64 bytes at least and 2 MB at most."""
    bits = min(1 << 24, max(512, 1 << (BITS_PER_KEY * len(keys) - 1).bit_length()))
    flags = np.zeros(bits, dtype=bool)
    for place in _positions(keys, bits):
        flags[place] = True
    return np.packbits(flags).tobytes()


def may_hold(bits: bytes, keys: np.ndarray) -> np.ndarray:
    """True for every key that the filter was made of, and for few others."""
    flags = np.unpackbits(np.frombuffer(bits, np.uint8)).view(bool)
    return np.logical_and.reduce([flags[place] for place in _positions(keys, len(flags))])


@dataclass(frozen=True)
class IdIndex:
    """The index in a folder. ``batch`` names a batch by its run and number."""

    folder: str
    buckets: int = BUCKETS

    def _keyed(self, rows: DataFrame, key: str) -> DataFrame:
        hashed = F.xxhash64(F.col(key))
        return rows.withColumns({"_hash": hashed, "bucket": F.pmod(hashed, F.lit(self.buckets)).cast("int")})

    def hits(self, ids: DataFrame, key: str, run: str, batch_id: int) -> DataFrame:
        """The ids that other batches may hold: bucket, run, batch_id and the id. ``ids`` are distinct.

        Filters lie in one folder per batch, sorted by bucket; those in buckets without such ids are skipped.
        """
        spark = ids.sparkSession
        own = stored(self._keyed(ids.filter(F.col(key).isNotNull()).select(key), key), "index-ids")
        met = [r["bucket"] for r in own.select("bucket").distinct().collect()]  # at most the buckets
        known = read_or_empty(spark, f"{self.folder}/filters", _FILTERS)
        known = known.filter(F.col("bucket").isin(met) & ((F.col("run") != run) | (F.col("batch_id") != batch_id)))
        names = ["bucket", "run", "batch_id", key]

        def ask(ids_: pa.Table, filters: pa.Table) -> pa.Table:
            keys = ids_.column("_hash").to_numpy().view(np.uint64)
            parts = []
            for row in filters.to_pylist():
                found = np.flatnonzero(may_hold(row["bits"], keys))
                part = ids_.select(["bucket", key]).take(pa.array(found))
                parts.append(part.append_column("run", pa.array([row["run"]] * len(found), pa.string()))
                             .append_column("batch_id", pa.array([row["batch_id"]] * len(found), pa.int64())))
            if not parts:
                return pa.table({"bucket": pa.array([], pa.int32()), "run": pa.array([], pa.string()),
                                 "batch_id": pa.array([], pa.int64()), key: ids_.column(key).slice(0, 0)})
            return pa.concat_tables(parts).select(names)

        schema = f"bucket int, run string, batch_id long, `{key}` string"
        return stored(own.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(ask, schema), "index-hits")

    def seen(self, ids: DataFrame, key: str, run: str, batch_id: int) -> DataFrame:
        """Those of the distinct ids that other batches hold. The index files read are those that a
        filter lets through."""
        spark = ids.sparkSession
        hits = self.hits(ids, key, run, batch_id)
        batches = hits.select("run", "batch_id").distinct().limit(_LISTED + 1).collect()
        if not batches:
            return hits.select(key)
        buckets = [r["bucket"] for r in hits.select("bucket").distinct().collect()]
        known = read_or_empty(spark, f"{self.folder}/ids", f"`{key}` string, _hash long, bucket int, run string, batch_id long").filter(F.col("bucket").isin(buckets))
        if len(batches) <= _LISTED:
            known = known.filter(reduce(lambda a, b: a | b, [
                (F.col("run") == r["run"]) & (F.col("batch_id") == r["batch_id"]) for r in batches]))
        return hits.join(known, ["bucket", "run", "batch_id", key], "left_semi").select(key).distinct()

    def add(self, ids: DataFrame, key: str, run: str, batch_id: int) -> None:
        """Adds the ids of a batch, or puts them in the place of what it added before."""
        rows = self._keyed(ids.filter(F.col(key).isNotNull()).select(key).distinct(), key)
        named = rows.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("long")})
        place = f"run={run}/batch_id={batch_id}"
        own = f"{self.folder}/ids/{place}"
        named.repartition("bucket").sortWithinPartitions("bucket", key).select("bucket", key, "_hash") \
            .write.mode("overwrite").partitionBy("bucket").parquet(own)
        written = ids.sparkSession.read.schema(f"`{key}` string, _hash long, bucket int").parquet(own)

        def make(group: pa.Table) -> pa.Table:
            keys = group.column("_hash").to_numpy().view(np.uint64)
            return pa.table({"bucket": group.column("bucket").slice(0, 1), "ids": pa.array([len(keys)], pa.int64()),
                             "bits": pa.array([filter_bits(keys)], pa.binary())})

        made = written.select("bucket", "_hash").groupBy("bucket").applyInArrow(make, "bucket int, ids long, bits binary")
        made.sortWithinPartitions("bucket").write.mode("overwrite").parquet(f"{self.folder}/filters/{place}")
