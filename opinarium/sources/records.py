"""CSV files whose quoted cells hold line breaks, read by many tasks.

A physical line begins a record if the quotes before it in its file are even in number. Every block
of a file counts that for itself: each line gets the parity of the quotes before it in the block,
and how many lines of the block up to it would begin a record if the block began outside of quotes;
the rest would if it began inside. Parities of blocks combine by exclusive or, so a prefix scan over
one row per block tells which case holds, and numbers the records. Records of one line pass straight
through; only lines of longer records are shuffled, by their record.

Files follow the usual rules: a cell with a quote, a separator or a line break stands in quotes, and
a quote in it is doubled. Lines end with LF or CRLF; in files whose header ends with CRLF, one within
a cell counts as LF, elsewhere it stays. Empty records are skipped. A file with an open quote at its end is refused, and so are files whose first
lines differ, or hold half of a record.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinarium.session import stored

QUOTE = '"'


class MalformedCsv(ValueError):
    """The files cannot be read as records of one header."""


def _physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the file and the block that a task read them from. Lines end with LF only."""
    return spark.read.text(path, lineSep="\n").select(
        "value", F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_path").alias("path"))


class _Place:
    """Where a task is in a block: lines so far, those with even quotes before them, the parity, and
    whether the file's header was met."""

    def __init__(self, key: tuple[int, int]):
        self.key, self.lines, self.even, self.parity, self.head = key, 0, 0, 0, key[1] > 0


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The lines of one block in one batch: the batch, its place after them, and arrays of parity
    before the line, lines with even parity up to it, own parity, and whether it is the header."""
    place = None
    for batch in batches:
        file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(batch)]):
            if a == b:
                continue
            key = (int(file[a]), int(block[a]))
            if place is None or place.key != key:
                place = _Place(key)
            part = batch.slice(a, b - a)
            own = pc.count_substring(part.column("value"), QUOTE).to_numpy().astype(np.int64) & 1
            before = (np.cumsum(own) - own + place.parity) & 1
            even = np.cumsum(before == 0) + place.even
            head = np.zeros(len(part), dtype=bool)
            if not place.head:
                filled = np.flatnonzero(~np.isin(part.column("value").to_numpy(zero_copy_only=False), ["", "\r"]))
                if len(filled):
                    head[filled[0]] = place.head = True
            first = place.lines
            place.lines += len(part)
            place.even = int(even[-1])
            place.parity = int((before[-1] + own[-1]) & 1)
            yield part, place, first, before, even, own, head


def _blocks(lines: DataFrame) -> DataFrame:
    """One row per file and block: lines that begin a record if the block begins outside of quotes
    (``even``) or inside (``odd``), its parity, and the header if it is there."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, int], list] = {}
        for part, place, _, _, _, own, head in _pieces(batches):
            row = known.setdefault(place.key, [part.column("path")[0].as_py(), 0, 0, 0, None, 0])
            row[1:4] = place.even, place.lines - place.even, place.parity
            if head.any():
                at = int(np.argmax(head))
                row[4:] = part.column("value")[at].as_py(), int(own[at])
        rows = [(*key, *row) for key, row in known.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()))],
            ["file", "block", "path", "even", "odd", "parity", "header", "header_parity"])

    return lines.mapInArrow(run, "file long, block long, path string, even long, odd long, parity long, "
                                 "header string, header_parity long")


def _scanned(blocks: DataFrame) -> DataFrame:
    """Adds ``inside`` (the block begins within quotes) and ``records``, those that begin before it.
    A window holds the blocks of one file, one row each."""
    order = W.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2) == 1
    begun = blocks.withColumn("inside", inside).withColumn("begun", F.when(F.col("inside"), F.col("odd")).otherwise(F.col("even")))
    return begun.withColumns({
        "records": F.coalesce(F.sum("begun").over(earlier), F.lit(0)),
        "crlf": F.coalesce(F.max(F.endswith("header", F.lit("\r"))).over(W.partitionBy("file")), F.lit(False))})


def _header(blocks: DataFrame) -> list[str]:
    """The names in the first line of all files, after the checks on whole files."""
    open_end = blocks.groupBy("path").agg(F.sum("parity").alias("quotes")).filter("quotes % 2 = 1").first()
    if open_end is not None:
        raise MalformedCsv(f"a quote is open at the end of {open_end['path']}")
    heads = blocks.filter("header is not null").groupBy(F.regexp_replace("header", "\r$", "").alias("header")).agg(
        F.max("header_parity").alias("half"), F.min("path").alias("path")).limit(2).collect()
    if len(heads) > 1:
        raise MalformedCsv(f"headers differ: {heads[0]['path']} and {heads[1]['path']}")
    if not heads:
        return []
    if heads[0]["half"]:
        raise MalformedCsv(f"the header of {heads[0]['path']} goes on in a second line")
    return next(csv.reader([heads[0]["header"]]))


def records(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """The records of the files behind their headers (path, record, text), and the header's names.

    ``record`` numbers the records of a file, the header included. The files are read twice; nothing
    but one row per block is stored.
    """
    lines = _physical_lines(spark, path)
    blocks = stored(_scanned(_blocks(lines)), "csv-blocks")
    names = _header(blocks)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, first, before, even, own, head in _pieces(batches):
            number = np.arange(first, first + len(part), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([
                *(part.column(c) for c in ("value", "file", "block")), pa.array(number), pa.array(before),
                pa.array(even), pa.array(number + 1 - even), pa.array(own), pa.array(head)],
                ["value", "file", "block", "line", "before", "even", "odd", "own", "head"])

    marked = lines.drop("path").mapInArrow(
        run, "value string, file long, block long, line long, before long, even long, odd long, own long, head boolean")
    where = blocks.select("file", "block", "path", "inside", "records", "crlf")
    placed = marked.join(where, ["file", "block"]).filter("not head")
    inside = F.col("inside").cast("long")
    placed = placed.select(
        "path", "block", "line", "value", "crlf",
        (F.col("records") + F.when(F.col("inside"), F.col("odd")).otherwise(F.col("even"))).alias("record"),
        ((F.col("before") + inside) % 2 == 0).alias("begins"), ((F.col("before") + inside + F.col("own")) % 2 == 0).alias("ends"))
    whole = F.col("begins") & F.col("ends")
    single = placed.filter(whole).select("path", "record", F.col("value").alias("text"))
    long = placed.filter(~whole).groupBy("path", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("lines"), F.first("crlf").alias("crlf"))
    text = F.array_join(F.col("lines.value"), "\n")
    text = F.when(F.col("crlf"), F.replace(text, F.lit("\r\n"), F.lit("\n"))).otherwise(text)
    joined = long.select("path", "record", text.alias("text"))
    text = F.regexp_replace("text", "\r$", "")
    return single.unionByName(joined).withColumn("text", text).filter("text <> ''"), names


def read_split_csv(spark: SparkSession, path: str, ingest_order: str | None = None) -> DataFrame:
    """The rows of CSV files, every column a string named by the header; large files are split.

    ``ingest_order`` names a further column that sorts rows as they stand in their files. Without a
    line there are no columns.
    """
    found, names = records(spark, path)
    if not names:
        return spark.createDataFrame([], T.StructType([]))
    layout = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    parsed = F.from_csv("text", layout, {"quote": QUOTE, "escape": QUOTE, "multiLine": "true"})
    columns = [F.col("_row").getField(n).alias(n) for n in names]
    if ingest_order:
        columns.append(F.struct(F.col("path").alias("file"), "record").alias(ingest_order))
    return found.withColumn("_row", parsed).select(*columns)

