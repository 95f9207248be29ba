"""Share, discount and banding expressions."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import zip_longest

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinarium.functions.parse import nan_to_null

# Upper edges (inclusive) and names of the discount bands, in report order.
DISCOUNT_EDGES = (0, 10, 20, 30)
DISCOUNT_BANDS = ("No discount", "0-10%", "10-20%", "20-30%", "30%+")
UNKNOWN_BAND = "Unknown"


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``, a double; null where ``whole`` is 0."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole), digits)


def discount_pct(mrp: Column, price: Column) -> Column:
    """Listed discount in percent; null unless both prices are known and mrp is positive."""
    mrp, price = nan_to_null(mrp), nan_to_null(price)
    known = mrp.isNotNull() & (mrp > 0) & price.isNotNull()
    return F.when(known, F.lit(100.0) * (mrp - price) / mrp)


def band(value: Column, edges: Sequence[float], labels: Sequence[str],
         unknown: str | None = None) -> Column:
    """Name of the band a value falls in; each edge is the inclusive top of its band."""
    if len(labels) != len(edges) + 1:
        raise ValueError("a band list needs one label more than it has edges")
    expr = F.when(value.isNull(), F.lit(unknown))
    for edge, name in zip_longest(edges, labels):
        expr = expr.otherwise(F.lit(name)) if edge is None else expr.when(value <= edge, name)
    return expr


def position(value: Column, labels: Sequence[str]) -> Column:
    """Place of a label in a fixed list (1, 2, ...), after all of them if not listed."""
    found = F.array_position(F.array(*[F.lit(x) for x in labels]), value)
    return F.when(found > 0, found).otherwise(len(labels) + 1)
