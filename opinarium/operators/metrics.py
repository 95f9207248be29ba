"""Counting, share, rate and ranking operators.

Every operator first reduces its input with a groupBy, which Spark partially aggregates
before the shuffle, so a key that holds a large part of all rows arrives as a few rows per
input partition. Totals and ranks are computed on those reduced rows only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opinarium.functions.measures import pct


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n",
             where: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows per key, plus one conditional count for each entry of ``where``."""
    extra = [F.count_if(cond).alias(alias) for alias, cond in (where or {}).items()]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name), *extra)


def require_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Drops rows with a null key, as an inner join on these keys would."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def with_total(counts: DataFrame, within: Sequence[str], part: str, total: str,
               closed: bool = False) -> DataFrame:
    """Adds the sum of ``part`` over the rows that share the ``within`` keys.

    With no ``within`` keys the total is one scalar subquery. Otherwise totals are grouped
    on their own and joined back: adaptive execution broadcasts them if they turn out small
    and splits a group that is skewed even after counting. Both branches read the same
    counted shuffle, as long as ``part`` is the only aggregate of ``counts``. ``closed`` says
    that the classes in a group come from a closed list, so a group is a handful of rows;
    then a window saves the second aggregation. Rows with a null key belong to no group and
    are dropped.
    """
    if not within:
        whole = counts.agg(F.sum(part)).scalar()
        return counts.withColumn(total, whole)
    counts = require_keys(counts, *within)
    if closed:
        return counts.withColumn(total, F.sum(part).over(W.partitionBy(*within)))
    return counts.join(totals_of(counts, within, part, total), list(within))


def totals_of(counts: DataFrame, within: Sequence[str], part: str, total: str) -> DataFrame:
    return counts.groupBy(*within).agg(F.sum(part).alias(total))


def share_of_total(counts: DataFrame, within: Sequence[str], part: str, total: str,
                   share: str, closed: bool = False) -> DataFrame:
    """Adds the group total and the percentage each row has of it."""
    out = with_total(counts, within, part, total, closed)
    return out.withColumn(share, pct(F.col(part), F.col(total)))


def rank_within(counts: DataFrame, by: Sequence[str], order: Sequence[Column],
                name: str) -> DataFrame:
    """Rank with gaps inside each group; ties share a rank. Input must be counted rows."""
    spec = W.partitionBy(*by).orderBy(*order)
    return counts.withColumn(name, F.rank().over(spec).cast("bigint"))


def top_class(counts: DataFrame, by: Sequence[str], part: str, label: str) -> DataFrame:
    """The most frequent class of each group; among equals the first label wins."""
    spec = W.partitionBy(*by).orderBy(F.desc(part), F.asc(label))
    return counts.withColumn("_rn", F.row_number().over(spec)).filter("_rn = 1").drop("_rn")


def flag_rate(df: DataFrame, keys: Sequence[str], flag: Column, total: str, flagged: str,
              rate: str, min_rows: int = 0) -> DataFrame:
    """Rows, flagged rows and flagged percentage per key, for keys with enough rows."""
    out = count_by(df, keys, total, {flagged: flag})
    if min_rows:
        out = out.filter(F.col(total) >= min_rows)
    return out.withColumn(rate, pct(F.col(flagged), F.col(total)))


def rate_and_weight(df: DataFrame, within: Sequence[str], keys: Sequence[str], flag: Column,
                    total: str, flagged: str, rate: str, weight: str, min_rows: int = 0,
                    keep_zero: bool = False) -> DataFrame:
    """Flagged percentage of each facet, and its flagged share of all rows of the entity.

    ``within`` names the entity, ``keys`` the entity and the facet. The entity total counts
    all rows, also those of facets that the final filter removes. Rows are first counted by
    key and flag; facets and entity totals are both summed up from these counts, so the
    input is read once and no entity is gathered in one task.
    """
    counts = count_by(require_keys(df, *within).withColumn("_flag", flag), [*keys, "_flag"],
                      "_rows")
    facets = counts.groupBy(*keys).agg(
        F.sum("_rows").alias(total),
        F.sum(F.when(F.col("_flag"), F.col("_rows")).otherwise(0)).alias(flagged))
    if not keep_zero:
        facets = facets.filter(F.col(flagged) > 0)
    if min_rows:
        facets = facets.filter(F.col(total) >= min_rows)
    out = facets.join(totals_of(counts, within, "_rows", "_entity_rows"), list(within))
    return (
        out.withColumn(rate, pct(F.col(flagged), F.col(total)))
        .withColumn(weight, pct(F.col(flagged), F.col("_entity_rows")))
        .drop("_entity_rows")
    )


def class_share(df: DataFrame, keys: Sequence[str], column: str, classes: Sequence[str],
                total: str, share: str, min_rows: int = 0,
                name: str = "{}_reviews") -> DataFrame:
    """Count of each given class per key and the percentage all of them make up together."""
    each = {name.format(c): F.col(column) == c for c in classes}
    out = count_by(df, keys, total, {**each, "_any": F.col(column).isin(*classes)})
    if min_rows:
        out = out.filter(F.col(total) >= min_rows)
    return out.withColumn(share, pct(F.col("_any"), F.col(total))).drop("_any")


def pivot_counts(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str],
                 total: str, name: str = "{}_mentions") -> DataFrame:
    """One count column per value of a closed list, in a single aggregation."""
    return count_by(df, keys, total, {name.format(v): F.col(column) == v for v in values})


def ordered(df: DataFrame, *order: Column | str, top: int | None = None) -> DataFrame:
    """Sorted report, or only its first ``top`` rows where a top list is asked for."""
    out = df.orderBy(*order)
    return out if top is None else out.limit(top)
