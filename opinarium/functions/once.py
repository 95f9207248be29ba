"""Keeping the optimizer from repeating costly expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Adds or replaces columns whose values are worked out once per row.

    A filter on a computed column is otherwise pushed below the projection as a copy of the
    whole expression, which is then evaluated for the filter and again for the value. Values
    that pass through a one-element list stay values. Filters on other columns still move
    down to the scan.
    """
    others = [c for c in df.columns if c not in columns]
    row = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    out = df.select(*others, F.inline(F.array(row)))
    return out.select(*df.columns, *[c for c in columns if c not in df.columns])
