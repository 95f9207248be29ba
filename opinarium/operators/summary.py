"""Counts per product and aspect that follow loads and deletes without a second look at the rest.

Counts are sums, so those of parts of the tables add up, and what went is added with its sign
turned. A change costs as much as the rows that changed: its counts may lie beside those before, and
the report sums them, so reading costs one aggregation over the counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinarium.functions.measures import pct
from opinarium.schemas import ASPECT_SENTIMENTS

KEYS = ["product_id", "brand_name", "product_title", "aspect"]
COUNTS = ["total_mentions", *(f"{s}_mentions" for s in ASPECT_SENTIMENTS)]


def mention_counts(reviews: DataFrame, aspects: DataFrame) -> DataFrame:
    """Mentions per product and aspect, all of them and by sentiment.

    A task holds its reviews in a table and the mentions stream past it unsorted.
    """
    mentions = aspects.select("review_id", "aspect", "aspect_sentiment").join(
        reviews.select("review_id", *KEYS[:-1]).hint("shuffle_hash"), "review_id")
    return mentions.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias(COUNTS[0]),
        *[F.count_if(F.col("aspect_sentiment") == s).alias(c) for s, c in zip(ASPECT_SENTIMENTS, COUNTS[1:])])


def retracted(counts: DataFrame) -> DataFrame:
    """The same counts with their signs turned."""
    return counts.select(*KEYS, *[(-F.col(c)).alias(c) for c in COUNTS])


def changed_counts(counts: DataFrame, *changes: DataFrame) -> DataFrame:
    """The counts after the changes, in any order; groups without mentions go.

    Changes that were applied twice or never loaded show as negative counts, which are refused.
    """
    every = reduce(DataFrame.unionByName, changes, counts)
    sums = every.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in COUNTS])
    broken = F.raise_error(F.concat(F.lit("more mentions retracted than counted of "), F.coalesce("aspect", F.lit("null"))))
    total = F.when(F.least(*COUNTS) < 0, broken.cast("bigint")).otherwise(F.col(COUNTS[0]))
    return sums.withColumn(COUNTS[0], total).filter(F.col(COUNTS[0]) != 0)


def summary_of(counts: DataFrame) -> DataFrame:
    """The report over the counts, which may be in parts, with the share of negative mentions."""
    return changed_counts(counts).select(*KEYS, *COUNTS, pct(F.col("negative_mentions"), F.col("total_mentions")).alias("negative_rate_pct"))
