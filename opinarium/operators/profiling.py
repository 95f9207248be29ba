"""Column profiles: types, nulls, duplicates, value counts, quantiles and histograms."""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from opinarium.functions.parse import nan_to_null
from opinarium.operators.cleaning import long_report

QUARTILES = (0.25, 0.5, 0.75)
#: Cells into which a round of quartile search cuts a range.
CELLS = 4096
_LARGEST = sys.float_info.max


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, in one pass."""
    report = long_report(df, ("column_name",),
                         [(c, F.count_if(F.col(c).isNull())) for c in df.columns])
    return report.withColumnRenamed("value", "null_count")


def column_info(df: DataFrame) -> DataFrame:
    """Type, non-null values and rows of each column, with its place in the table."""
    dtypes = df.dtypes
    measures = [(c, t, str(i), F.count(c)) for i, (c, t) in enumerate(dtypes)]
    measures.append((None, None, None, F.count(F.lit(1))))
    report = long_report(df, ("column_name", "dtype", "place"), measures)
    rows = F.max(F.when(F.col("column_name").isNull(), F.col("value"))).over(
        W.partitionBy(F.lit(0)))
    return (
        report.withColumn("row_count", rows)
        .filter(F.col("column_name").isNotNull())
        .select(F.col("place").cast("int").alias("place"), "column_name", "dtype",
                F.col("value").alias("non_null_count"), "row_count",
                F.lit(len(dtypes)).alias("column_count"))
        .orderBy("place")
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in all columns; nulls count as equal."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def value_counts(df: DataFrame, columns: Sequence[str], top: int | None = None) -> DataFrame:
    """How often each non-null value of each given column occurs, in one pass.

    ``top`` keeps that many of the most frequent values of every column. Each column then is a
    plan of its own that reads this column only, and every task passes on ``top`` values at most.
    """
    if top is not None:
        parts = [value_counts(df, [c]).orderBy(F.desc("n"), "value").limit(top) for c in columns]
        return reduce(DataFrame.unionByName, parts).orderBy("column_name", F.desc("n"), "value")
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = texts.unpivot([], list(columns), "column_name", "value")
    counts = long.filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n"))
    return counts.orderBy("column_name", F.desc("n"), "value")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _scalar_row(df: DataFrame) -> Column:
    """The single row of an aggregate as one struct-valued scalar subquery."""
    return df.select(F.struct(*df.columns)).scalar()


def _at_ranks(numbers: DataFrame, guesses: Mapping[tuple[int, int], tuple[float, float]],
              whole: Sequence[tuple[float, float]]) -> dict[tuple[int, int], float]:
    """The value at each (column, rank), ranks counted from 0.

    A rank starts in the range guessed for it, or in the ``whole`` range of its column if the
    guess does not hold it. Every round replaces the range by the smallest and the largest
    value of a cell in it, until both are one value.
    """
    if not guesses:
        return {}
    spans = sorted({(i, *guess) for (i, _), guess in guesses.items()})
    ends = numbers.agg(*[
        F.struct(F.count_if(F.col(f"c{i}") < low), F.count_if(F.col(f"c{i}") <= high))
        for i, low, high in spans]).first()
    held = dict(zip(spans, ends))
    ranges = {}
    for (i, rank), guess in guesses.items():
        below, upto = held[i, *guess]
        ranges[i, rank] = (*guess, below) if below <= rank < upto else (*whole[i], 0)
    values = {}
    while ranges:
        values |= {key: low for key, (low, high, _) in ranges.items() if low == high}
        ranges = {key: span for key, span in ranges.items() if key not in values}
        if ranges:
            ranges = _narrowed(numbers, ranges)
    return values


def _narrowed(numbers: DataFrame, ranges: dict) -> dict:
    """For each (column, rank) the cell of its range that holds it: least and largest value, and
    the rows before it. Rows are counted per cell, so no task gets more than ``CELLS`` rows of a
    range. The largest value has a cell of its own, so every round makes a range smaller.
    """
    spans = sorted({(i, low, high) for (i, _), (low, high, _) in ranges.items()})
    inside, hits = F.lit(False), []
    for n, (i, low, high) in enumerate(spans):
        x = F.col(f"c{i}")
        start, end = (min(max(v, -_LARGEST), _LARGEST) / 2 for v in (low, high))
        place = F.floor(F.try_divide(x / 2 - start, F.lit(end - start)) * (CELLS - 2))
        place = F.greatest(F.lit(0), F.least(F.coalesce(place, F.lit(0)), F.lit(CELLS - 2)))
        cell = F.when(x == high, F.lit(CELLS - 1)).otherwise(place).cast("int")
        inside = inside | x.between(low, high)
        hits.append(F.when(x.between(low, high), F.struct(
            F.lit(n).alias("span"), cell.alias("cell"), x.alias("x"))))
    found = numbers.filter(inside).select(F.inline(F.array_compact(F.array(*hits))))
    cells = found.groupBy("span", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    earlier = W.partitionBy("span").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    ranks = numbers.sparkSession.createDataFrame(
        [(spans.index((i, low, high)), i, rank, rank - base, base)
         for (i, rank), (low, high, base) in ranges.items()],
        "span int, i int, rank bigint, place bigint, base bigint")
    place = F.col("place")
    rows = cells.join(F.broadcast(ranks), "span").filter(
        (place >= F.col("before")) & (place < F.col("before") + F.col("n"))).collect()
    return {(r["i"], r["rank"]): (r["low"], r["high"], r["base"] + r["before"]) for r in rows}


def describe(df: DataFrame, columns: Sequence[str] | None = None,
             digits: int | None = None, accuracy: int = 10_000) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column.

    Quartiles interpolate between neighbours and are exact without ordering a column. A first
    job computes the moments and a quantile sketch, which gives each quartile a range it
    probably lies in; :func:`_at_ranks` then narrows the ranges by counting. ``accuracy`` is
    that of the sketch and only decides how many rounds this takes.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    numbers = df.select(*[nan_to_null(F.col(c).cast("double")).alias(f"c{i}")
                          for i, c in enumerate(names)])
    margin = 2.0 / accuracy
    edges = [min(max(q + side * margin, 0.0), 1.0) for q in QUARTILES for side in (-1, 1)]
    basics = [
        F.struct(F.count(c).alias("count"), F.avg(c).alias("mean"),
                 F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"),
                 F.percentile_approx(c, edges, accuracy).alias("edges")).alias(c)
        for c in numbers.columns]
    known = numbers.agg(*basics).first()

    guesses = {}
    for i, column in enumerate(known):
        for q, point in enumerate(QUARTILES if column["count"] else ()):
            rank = point * (column["count"] - 1)
            for whole in (math.floor(rank), math.ceil(rank)):
                guesses[i, whole] = tuple(column["edges"][2 * q:2 * q + 2])
    values = _at_ranks(numbers, guesses, [(c["min"], c["max"]) for c in known])

    def quartile(i: int, point: float) -> float | None:
        if not known[i]["count"]:
            return None
        rank = point * (known[i]["count"] - 1)
        low, high = values[i, math.floor(rank)], values[i, math.ceil(rank)]
        return low if low == high else low + (high - low) * (rank - math.floor(rank))

    fields = ("count", "mean", "std", "min", "max")
    points = [f"p{int(100 * p)}" for p in QUARTILES]
    out = df.sparkSession.createDataFrame(
        [(i, name, *[known[i][f] for f in fields], *[quartile(i, p) for p in QUARTILES])
         for i, name in enumerate(names)],
        "i int, column_name string, count bigint, "
        + ", ".join(f"{f} double" for f in (*fields[1:], *points))).orderBy("i")

    def shown(name: str) -> Column:
        return F.col(name) if digits is None else F.round(name, digits).alias(name)

    return out.select("column_name", "count",
                      *[shown(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Rows per equal-width bin from minimum to maximum, the last bin closed.

    All bins are listed, also empty ones. Missing and infinite values are in no bin; if all
    values are equal, the range reaches half a unit to either side.
    """
    value = nan_to_null(F.col(column).cast("double"))
    finite = df.select(value.alias("x")).filter(F.abs(F.col("x")) < float("inf"))
    span = finite.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    flat = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    span = span.select((F.col("lo") - flat).alias("lo"), (F.col("hi") + flat).alias("hi"))
    known = _scalar_row(span)
    lo, width = known.getField("lo"), (known.getField("hi") - known.getField("lo")) / bins
    binned = finite.select(
        F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1)).alias("bin"))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    out = every.join(counts, "bin", "left")
    return out.select(
        "bin", (lo + F.col("bin") * width).alias("bin_start"),
        (lo + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n")).orderBy("bin")
