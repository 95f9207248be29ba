"""Distinct counts from stored sketches that can be merged without the rows.

A sketch has a fixed size, about ``2 ** precision`` bytes at most, whatever it has counted. Sketches
of fine groups are stored once; those of any coarser groups are their unions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRECISION = 12


def standard_error(precision: int = PRECISION) -> float:
    """Relative standard error of an estimate from merged sketches."""
    return 1.04 / 2 ** (precision / 2)


def distinct_sketches(df: DataFrame, keys: Sequence[str], column: str, precision: int = PRECISION) -> DataFrame:
    """One row per group: the keys, ``rows`` and the ``sketch`` of a text or integer column.

    Nulls are counted in ``rows`` only; a group of nulls has an empty sketch.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"),
                                 F.hll_sketch_agg(column, F.lit(precision)).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The sketches of coarser groups, or of all rows if no key is given."""
    return sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """Every column but the sketch, and its estimate as ``distinct_values``."""
    return sketches.withColumn("distinct_values", F.hll_sketch_estimate("sketch")).drop("sketch")


def within_error(estimate, exact, precision: int = PRECISION, errors: float = 4.0):
    """Whether an estimate is at most so many standard errors, and one value, off the exact count."""
    return F.abs(estimate - exact) <= exact * (errors * standard_error(precision)) + 1
