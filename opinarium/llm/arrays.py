"""Whole texts as flat byte arrays: blocks of rows, word spans, and hashes of spans.

Every function works on one block of UTF-8 bytes with numpy, without a Python loop over words.
A block holds whole texts and, unless one text alone is longer, at most ``BLOCK_BYTES`` bytes.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

BLOCK_BYTES = 1 << 20
#: Batches that reach a Python worker. Spark's own 64 MB would be held several times over by the
#: JVM and by each worker.
BATCH_BYTES = 4 << 20
#: Stands behind every text of a block. UTF-8 has no such byte.
END = 0xFF

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mapped(rows: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` on batches of at most ``BATCH_BYTES``, or less if the session says so."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    conf = rows.sparkSession.conf
    if conf.get(name) in ("67108864", "67108864b", "64m", "64MB"):
        conf.set(name, str(BATCH_BYTES))
    return rows.mapInArrow(function, schema)


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with underscores in front until no column has it, whatever its case."""
    taken, found = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that tells for each byte whether it lies in one of the closed ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


def kept_in_worker(name: str, make: Callable):
    """What ``make`` gives, made once per Python process and name.

    The package's functions are sent to workers by value, so their globals are new in every task.
    """
    home = vars(sys.modules.setdefault("_opinarium_kept", ModuleType("_opinarium_kept")))
    if name not in home:
        home[name] = make()
    return home[name]


class Block:
    """Some rows of a batch: ``data`` has each text followed by END, then eight more END bytes.

    ``starts[i]`` and ``ends[i]`` bound the text of row ``first + i``.
    """

    def __init__(self, first: int, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.first, self.data, self.starts, self.ends = first, data, starts, ends

    def __len__(self) -> int:
        return len(self.starts)

    def lowered(self) -> Block:
        """The same rows with A-Z in lower case."""
        return Block(self.first, _LOWER[self.data], self.starts, self.ends)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()

    def rows_of(self, positions: np.ndarray) -> np.ndarray:
        """The row within the block that each position lies in."""
        return np.searchsorted(self.ends, positions, side="left")


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks over a column of texts; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield _block(first, raw[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def block_of(texts: list[str | None]) -> Block:
    """One block over some texts."""
    return next(blocks(pa.array(texts, pa.large_string()), 1 << 62))


def _block(first: int, raw: np.ndarray, offsets: np.ndarray) -> Block:
    rows = len(offsets) - 1
    shift = np.arange(rows, dtype=np.int64)
    starts, ends = offsets[:-1] + shift, offsets[1:] + shift
    data = np.full(len(raw) + rows + 8, END, dtype=np.uint8)
    inside = np.ones(len(raw) + rows, dtype=bool)
    inside[ends] = False
    data[:len(raw) + rows][inside] = raw
    return Block(first, data, starts, ends)


def spans(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of bytes that ``inside`` (by byte value) holds for."""
    flags = np.empty(len(data) + 1, dtype=np.int8)
    flags[0] = 0
    flags[1:] = inside[data]
    change = np.diff(flags)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all their bits; different values stay different."""
    values = (values ^ (values >> np.uint64(31))) * _MULTIPLIER
    values = (values ^ (values >> np.uint64(29))) * _SECOND
    return values ^ (values >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, eight bytes at a time.

    Spans of up to eight bytes and equal length have different hashes if they differ.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    lanes = np.ndarray((len(data) - 7,), dtype="<u8", buffer=np.ascontiguousarray(data), strides=(1,))
    left = ends - starts
    result = left.astype(np.uint64) * _SECOND
    at, rows, lane = starts, None, 0
    while True:
        used = np.minimum(left, 8)
        word = lanes[at] & _MASKS[used]
        if rows is None:
            result = mixed(result ^ word)
        else:
            result[rows] = mixed(result[rows] ^ word)
        longer = np.flatnonzero(left > 8)
        if not len(longer):
            return result
        rows = longer if rows is None else rows[longer]
        at, left = at[longer] + 8, left[longer] - 8
        lane += 1


_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def per_row(block: Block, starts: np.ndarray) -> np.ndarray:
    """Where the spans of each row begin in the list of spans; one entry more than rows."""
    bounds = np.searchsorted(starts, block.starts, side="left")
    return np.append(bounds, len(starts))


def repeated_ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + counts[i] - 1 for all i, one after the other."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, counts)
