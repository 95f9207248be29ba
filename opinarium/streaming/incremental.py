"""Adding only reviews that were not seen before, from a stream of arriving files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinarium.functions.text import id_key
from opinarium.operators.resume import first_per_key, pending_reviews
from opinarium.session import removed, stored_at
from opinarium.sources.files import read_or_empty
from opinarium.streaming.id_index import IdIndex

# A batch is named by the run whose progress folder counts it, and its number there.
_BATCH = [T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]
_RUN_PROPERTY = "sql.streaming.queryId"


def add_new_reviews(stream: DataFrame, target: str, checkpoint: str,
                    transform: Callable[[DataFrame], DataFrame] | None = None,
                    processed: DataFrame | None = None,
                    order: Sequence[Column | str] = (), key: str = "review_id",
                    index: IdIndex | None = None) -> DataFrame:
    """Runs over everything that has arrived, then stops; returns the target table.

    Each micro-batch keeps the first row of every id, drops the ids that earlier batches or
    ``processed`` hold, and writes a folder of its own. A batch that is repeated after a
    failure overwrites its own folder only, so no review is lost or added twice. Spark keeps
    the name of a run in its progress folder: runs with other folders, or with a new one after
    a loss, add to the target and replace nothing.

    Without an ``index`` every batch reads all ids of the target. With one it reads those files of
    the index that may hold its ids. The index belongs to one target; rows are written before their
    ids, so a run that fails between the two is to be resumed before another one starts.
    """

    def prepared(df: DataFrame) -> DataFrame:
        rows = transform(df) if transform else df
        return rows.withColumn(key, id_key(F.col(key)))

    def add(batch: DataFrame, batch_id: int) -> None:
        rows = first_per_key(prepared(batch), [key], order)
        layout = T.StructType([rows.schema[key], *_BATCH])
        run = batch.sparkSession.sparkContext.getLocalProperty(_RUN_PROPERTY)
        place = f"{target}/run={run}/batch_id={batch_id}"
        if index:
            rows, folder = stored_at(rows, "batch")
            seen = index.seen(rows.select(key).distinct(), key, run, batch_id)
        else:
            earlier = read_or_empty(batch.sparkSession, target, layout)
            seen = earlier.filter((F.col("run") != run) | (F.col("batch_id") != batch_id)).select(key)
        if processed is not None:
            seen = seen.unionByName(processed.select(key))
        fresh = pending_reviews(rows, seen, key)
        fresh.write.mode("overwrite").parquet(place)
        if index:
            index.add(batch.sparkSession.read.schema(fresh.schema).parquet(place).select(key), key, run, batch_id)
            removed(batch.sparkSession, folder)

    query = (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    layout = T.StructType([*prepared(stream).schema.fields, *_BATCH])
    return read_or_empty(stream.sparkSession, target, layout)


def drop_recent_repeats(stream: DataFrame, arrival: str, delay: str,
                        key: str = "review_id") -> DataFrame:
    """Drops repeats of an id that arrive within ``delay`` of each other.

    For a source without end: the state is bounded by the delay, but a repeat after it gets
    through. ``arrival`` should be the time of arrival, as review dates reach back years.
    """
    return stream.withWatermark(arrival, delay).dropDuplicatesWithinWatermark([key])
