"""A user's own function over every group, where no task ever sees a whole large group.

``partial`` turns some rows of a group into state rows, ``merge`` turns state rows of several parts
of a group into state rows. Both get and return pandas tables, and must not depend on how rows are
dealt to parts. Tasks apply ``partial`` to the rows as they read them, so rows are never shuffled;
only states are, and those of a group with very many are merged in rounds of bounded fan-in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from opinarium.session import stored

Function = Callable[[pd.DataFrame], pd.DataFrame]

#: States of a group that one task merges, on average.
FAN_IN = 64
#: State rows that a task holds before it merges them or passes them on.
HELD_ROWS = 50_000


def _slices(groups: pa.Array) -> Iterator[np.ndarray]:
    """The places of the rows of each group."""
    codes = pa.array(groups).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    if len(order):
        yield from np.split(order, np.flatnonzero(np.diff(codes[order])) + 1)


def _applied(table: pa.Table, function: Function, given: Sequence[str], keep: Sequence[str],
             out: pa.Schema) -> pa.Table:
    """The function over every group of a table. Columns of ``keep`` are those of the group's first row."""
    parts = []
    for places in _slices(table.column("_group").combine_chunks()):
        rows = table.take(pa.array(places))
        made = function(rows.select(given).to_pandas())
        state = pa.Table.from_pandas(made, pa.schema([f for f in out if f.name not in keep]), preserve_index=False)
        first = rows.select(keep).take(pa.array(np.zeros(len(made), np.int64)))
        parts.append(pa.table([*first.columns, *state.columns], schema=out))
    return pa.concat_tables(parts) if parts else out.empty_table()


def grouped(df: DataFrame, keys: Sequence[str], partial: Function, merge: Function,
            state: T.StructType | str, fan_in: int = FAN_IN) -> DataFrame:
    """The keys and the merged state rows of every group.

    ``partial`` gets all columns but the keys. Keys may be null; nulls are one group, as NaN is.
    Rows that repeat are passed on as often as they occur. A table without rows has no groups.
    ``merge`` is called for every group, also for one with a single state.
    """
    state = T.StructType.fromDDL(state) if isinstance(state, str) else state
    named = {k: f"_k{i}" for i, k in enumerate(keys)}
    own, given, states = list(named.values()), [c for c in df.columns if c not in keys], state.names
    group = F.to_json(F.struct(*[F.col(k).cast("string").alias(n) for k, n in named.items()]), {"ignoreNullFields": "false"})
    rows = df.select(group.alias("_group"), *[F.col(k).alias(n) for k, n in named.items()], *given)
    keep = ["_group", *own]
    schema = T.StructType([*(rows.schema[c] for c in keep), *state])
    arrow = to_arrow_schema(schema)
    numbered = T.StructType(list(schema)).add("_piece", T.LongType())

    def first_states(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId() << 33
        held = arrow.empty_table()

        def passed(table: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal piece
            for batch in table.to_batches():
                numbers = np.arange(piece, piece + len(batch), dtype=np.int64)
                piece += len(batch)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers)], [*arrow.names, "_piece"])

        for batch in batches:
            held = pa.concat_tables([held, _applied(pa.Table.from_batches([batch]), partial, given, keep, arrow)])
            if len(held) > HELD_ROWS:
                held = _applied(held, merge, states, keep, arrow)
                if len(held) > HELD_ROWS // 2:
                    yield from passed(held)
                    held = arrow.empty_table()
        yield from passed(_applied(held, merge, states, keep, arrow))

    def merged(table: pa.Table) -> pa.Table:
        piece = table.column("_piece")
        least = min(piece.to_pylist())
        made = _applied(table, merge, states, keep, arrow)
        return made.append_column("_piece", pa.array(np.full(len(made), least, np.int64)))

    found = stored(rows.mapInArrow(first_states, numbered), "group-states")
    while True:
        parts = found.groupBy("_group").agg(F.ceil(F.count_distinct("_piece") / fan_in).alias("_parts"))
        several = parts.filter("_parts > 1")
        last = several.isEmpty()
        if last:
            dealt = found.withColumn("_part", F.lit(0).cast("long"))
        else:
            dealt = found.join(several, "_group", "left").withColumn(
                "_part", F.pmod(F.xxhash64("_piece"), F.coalesce("_parts", F.lit(1)))).drop("_parts")
        result = dealt.select("_group", *own, *states, "_piece", "_part").groupBy("_group", "_part") \
            .applyInArrow(merged, numbered)
        if last:
            return result.select(*[F.col(n).alias(k) for k, n in named.items()], *states)
        found = stored(result, "group-states")
