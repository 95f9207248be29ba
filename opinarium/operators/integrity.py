"""Key, reference, domain and provenance checks on the two result tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinarium.operators.cleaning import long_report
from opinarium.schemas import ASPECT_SENTIMENTS, OVERALL_SENTIMENTS

# The texts of the key check.
KEY_OK = "PASS: All review_ids are unique"
KEY_BROKEN = "FAIL: Duplicate review_ids detected"


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def check_primary_key(df: DataFrame, key: str = "review_id") -> DataFrame:
    """Rows, distinct keys and a status text."""
    counts = df.agg(F.count(F.lit(1)).alias("total_rows"),
                    F.count_distinct(key).alias("distinct_ids"))
    unique = F.col("total_rows") == F.col("distinct_ids")
    return counts.withColumn("primary_key_status",
                             F.when(unique, KEY_OK).otherwise(KEY_BROKEN))


def check_foreign_key(child: DataFrame, parent: DataFrame,
                      key: str = "review_id") -> DataFrame:
    """Child rows whose key is not in the parent table; a null key refers to nothing."""
    named = child.filter(F.col(key).isNotNull())
    return named.join(parent.select(key).distinct(), key, "left_anti").select(child.columns)


def provenance(reviews: DataFrame) -> DataFrame:
    """Reviews per extraction method."""
    return reviews.groupBy("extraction_method").agg(
        F.count(F.lit(1)).alias("review_count")).orderBy("extraction_method")


def _outside(column: str, allowed: Sequence[str]) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*allowed)


def review_rules() -> list[tuple[str, str, Column]]:
    return [
        ("review_id", "not_null", F.col("review_id").isNull()),
        ("overall_sentiment", "not_null", F.col("overall_sentiment").isNull()),
        ("overall_sentiment", "domain", _outside("overall_sentiment", OVERALL_SENTIMENTS)),
        ("extraction_method", "not_null", F.col("extraction_method").isNull()),
    ]


def aspect_rules() -> list[tuple[str, str, Column]]:
    silent = F.col("issue").isNotNull() & (F.col("aspect_sentiment") != "negative")
    return [
        ("review_id", "not_null", F.col("review_id").isNull()),
        ("aspect", "not_null", F.col("aspect").isNull()),
        ("aspect_sentiment", "not_null", F.col("aspect_sentiment").isNull()),
        ("aspect_sentiment", "domain", _outside("aspect_sentiment", ASPECT_SENTIMENTS)),
        ("issue", "only_on_negative", silent),
    ]


def check_rules(table_name: str, df: DataFrame,
                rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Violations of each row rule, counted in one pass."""
    measures = [(table_name, column, rule, F.count_if(broken))
                for column, rule, broken in rules]
    report = long_report(df, ("table_name", "column_name", "rule"), measures)
    return report.withColumnRenamed("value", "violations")


def check_tables(reviews: DataFrame, aspects: DataFrame) -> DataFrame:
    """All row rules of both tables."""
    return check_rules("reviews", reviews, review_rules()).unionByName(
        check_rules("review_aspects", aspects, aspect_rules()))
