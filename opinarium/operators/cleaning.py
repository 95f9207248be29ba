"""Rule-based cleaning of raw review tables.

Each rule applies only if its column is there. All rules are column expressions, so cleaning
is one pass over the input without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from opinarium.functions.once import computed_once
from opinarium.functions.parse import nan_to_null, to_boolean, to_number, to_timestamp
from opinarium.functions.text import remove_tags, strip
from opinarium.schemas import RATING_MAX, RATING_MIN

STRIPPED_COLUMNS = ("review_title", "author", "brand_name")
NUMBER_COLUMNS = ("price", "mrp", "product_rating", "product_rating_count")
FLAG_COLUMNS = ("is_a_buyer", "pro_user")
RATING_COLUMNS = ("review_rating", "rating")


def rating_column(df: DataFrame) -> str | None:
    """The rating column under its usual or its short name."""
    return next((c for c in RATING_COLUMNS if c in df.columns), None)


def standardise(df: DataFrame, date_formats: Sequence[str] = (),
                missing_flag: bool | None = None) -> DataFrame:
    """Cleans and types the columns; keeps every row and every other column."""
    dtypes = dict(df.dtypes)
    rules: dict[str, Column] = {"review_text": remove_tags(F.col("review_text").cast("string"))}
    for name in STRIPPED_COLUMNS:
        rules[name] = strip(F.col(name))
    for name in (rating_column(df), *NUMBER_COLUMNS):
        if name:
            rules[name] = to_number(F.col(name), dtypes.get(name))
    rules["review_date"] = to_timestamp(F.col("review_date"), dtypes.get("review_date"),
                                        date_formats)
    for name in FLAG_COLUMNS:
        rules[name] = to_boolean(F.col(name), dtypes.get(name), missing_flag)
    # Tag removal is the costly rule, and rows are filtered by its result.
    df = computed_once(df, {"review_text": rules.pop("review_text")})
    return df.withColumns({name: rule for name, rule in rules.items() if name in dtypes})


def drop_reason(df: DataFrame) -> Column:
    """Why a standardised row is dropped, or null for a row to keep."""
    text = F.col("review_text")
    reason = F.when(text.isNull(), "missing_text").when(text == "", "blank_text")
    rating = rating_column(df)
    if rating:
        valid = F.coalesce(F.col(rating).between(RATING_MIN, RATING_MAX), F.lit(False))
        reason = reason.when(~valid, "invalid_rating")
    return reason


_REPORT_LABELS = ("metric", "column_name")


def clean_reviews(df: DataFrame, date_formats: Sequence[str] = (),
                  missing_flag: bool | None = None) -> DataFrame:
    """Standardised rows that have a text and, where there is a rating, a valid one."""
    out = standardise(df, date_formats, missing_flag)
    return out.filter(drop_reason(out).isNull())


def cleaning_report(df: DataFrame, date_formats: Sequence[str] = (),
                    missing_flag: bool | None = None) -> DataFrame:
    """Rows before, after and removed, and nulls per column after cleaning.

    One aggregation over the raw table, in the long form ``metric, column_name, value``.
    """
    out = standardise(df, date_formats, missing_flag)
    out = out.withColumn("_reason", drop_reason(out))
    return long_report(out, _REPORT_LABELS, _report_measures(df.columns))


def write_cleaned(df: DataFrame, path: str, date_formats: Sequence[str] = (),
                  missing_flag: bool | None = None, unreported: Sequence[str] = ()) -> DataFrame:
    """Writes the cleaned rows and returns the cleaning report, from one scan of the raw rows.

    The report is observed while the rows are written. Columns in ``unreported`` are written too,
    but their nulls are not counted.
    """
    out = standardise(df, date_formats, missing_flag)
    measures = _report_measures([c for c in df.columns if c not in unreported])
    seen = Observation()
    flagged = out.withColumn("_reason", drop_reason(out)).observe(
        seen, *[agg.alias(f"m{i}") for i, (*_, agg) in enumerate(measures)])
    flagged.filter("_reason is null").drop("_reason").write.mode("overwrite").parquet(path)
    found = seen.get
    lines = [(*labels, found.get(f"m{i}", 0)) for i, (*labels, _) in enumerate(measures)]
    return df.sparkSession.createDataFrame(lines, "metric string, column_name string, value bigint")


def _report_measures(columns: Sequence[str]) -> list[tuple]:
    """Labels and aggregates of the report, over standardised rows with ``_reason``."""
    kept, reason = F.col("_reason").isNull(), F.col("_reason")
    removed = F.count_if(~kept)
    metrics = [
        ("rows_before", None, F.count(F.lit(1))),
        ("rows_after", None, F.count_if(kept)),
        ("rows_removed", None, removed),
        ("rows_removed_total", None, removed),
        ("removed_missing_text", None, F.count_if(reason == "missing_text")),
        ("removed_blank_text", None, F.count_if(reason == "blank_text")),
        ("removed_invalid_rating", None, F.count_if(reason == "invalid_rating")),
    ]
    metrics += [("missing_values_after", c, F.count_if(kept & F.col(c).isNull()))
                for c in columns]
    return metrics


def long_report(df: DataFrame, names: Sequence[str],
                measures: Sequence[tuple]) -> DataFrame:
    """Aggregates in one pass and turns the single result row into one row per measure.

    Each measure is a tuple of its label texts, one per entry of ``names``, and the
    aggregate. The result column is called ``value``.
    """
    wide = df.agg(*[agg.alias(f"m{i}") for i, (*_, agg) in enumerate(measures)])
    lines = [
        F.struct(*[F.lit(text).cast("string").alias(name)
                   for name, text in zip(names, labels)],
                 F.col(f"m{i}").cast("bigint").alias("value"))
        for i, (*labels, _) in enumerate(measures)
    ]
    return wide.select(F.inline(F.array(*lines)))


def price_anomalies(df: DataFrame) -> DataFrame:
    """Counts odd prices. It is an audit: no row is changed or removed."""
    mrp, price = nan_to_null(F.col("mrp")), nan_to_null(F.col("price"))
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(mrp.isNull()).alias("mrp_missing"),
        F.count_if(mrp <= 0).alias("mrp_not_positive"),
        F.count_if(price.isNull()).alias("price_missing"),
        F.count_if(price > mrp).alias("price_above_mrp"),
    )
