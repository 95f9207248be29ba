"""Lenient parsers: what does not parse becomes null instead of failing the job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinarium.functions.text import strip

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_INFINITY = r"(?i)^[+-]?inf(inity)?$"

_TRUE = ("true", "t", "yes", "y", "1", "1.0")
_FALSE = ("false", "f", "no", "n", "0", "0.0")


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def to_number(value: Column, dtype: str = "string") -> Column:
    """Double, or null for anything that is not a number.

    The pattern keeps out Java-only spellings such as ``1.0d``. NaN becomes null, since
    Spark sorts NaN above every number and does not treat it as missing.
    """
    if dtype != "string":
        return nan_to_null(value.cast("double"))
    text = strip(value)
    return (
        F.when(text.rlike(_NUMBER), text.try_cast("double"))
        .when(text.rlike(_INFINITY), F.when(text.startswith("-"), F.lit(float("-inf")))
              .otherwise(F.lit(float("inf"))))
    )


def to_timestamp(value: Column, dtype: str = "string", formats: Sequence[str] = ()) -> Column:
    """Zone-free timestamp, or null. ISO forms come first, then ``formats`` in order."""
    if dtype != "string":
        return value.cast("timestamp_ntz")
    text = strip(value)
    tries = [text.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def to_boolean(value: Column, dtype: str = "string", missing: bool | None = None) -> Column:
    """Boolean from the usual spellings; ``missing`` is the value for null input."""
    if dtype == "boolean":
        parsed = value
    elif dtype != "string":
        parsed = value.cast("double") != 0
    else:
        word = F.lower(strip(value))
        parsed = F.when(word.isin(*_TRUE), True).when(word.isin(*_FALSE), False)
    if missing is None:
        return parsed
    return F.when(value.isNull(), F.lit(missing)).otherwise(parsed)
