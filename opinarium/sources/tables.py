"""Loading the two result tables, checked before they are published."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinarium.operators import integrity
from opinarium.operators.numbering import dense_numbers
from opinarium.operators.resume import first_per_key, pending_reviews
from opinarium.schemas import REVIEW_ASPECTS, REVIEWS
from opinarium.session import removed, stored, stored_at
from opinarium.sources.files import conform


REVIEW_IDS = T.StructType([REVIEW_ASPECTS["review_id"]])


class IntegrityError(ValueError):
    """The tables break a rule that their consumers rely on."""


@dataclass(frozen=True)
class TableNames:
    reviews: str = "reviews"
    aspects: str = "review_aspects"
    summary: str = "product_aspect_summary"


def with_aspect_id(aspects: DataFrame) -> DataFrame:
    """Adds a key that follows from the review and the place in its answer, so it is the same in
    every load. Where no place is known, the rows of a review are numbered by their values."""
    if "pos" not in aspects.columns:
        others = sorted(c for c in aspects.columns if c != "review_id")
        place = F.row_number().over(Window.partitionBy("review_id").orderBy(*others))
        aspects = aspects.withColumn("pos", (place - 1).cast("bigint"))
    return aspects.withColumn("aspect_id", F.xxhash64("review_id", "pos"))


def with_dense_aspect_id(aspects: DataFrame, order: Sequence[str] = ("review_id", "pos")) -> DataFrame:
    """Adds ``aspect_id`` as 1, 2, 3, ... in the order of the named columns, the order of insertion.

    Other than the key of :func:`with_aspect_id` it depends on all rows, so it changes with a load.
    """
    return dense_numbers(stored(aspects, "aspects"), order, "aspect_id", first=1)


def assert_loadable(reviews: DataFrame, aspects: DataFrame) -> None:
    """Raises unless required columns are filled and no aspect is orphaned."""
    broken = integrity.check_tables(reviews, aspects).filter(
        (F.col("rule") == "not_null") & (F.col("violations") > 0)).first()
    if broken is not None:
        raise IntegrityError(f"{broken['violations']} nulls in "
                             f"{broken['table_name']}.{broken['column_name']}")
    orphans = integrity.check_foreign_key(aspects, reviews).count()
    if orphans:
        raise IntegrityError(f"{orphans} aspect rows without a review")


def nulls_counted(name: str, df: DataFrame, rules: Sequence[tuple[str, str, Column]]) -> tuple[DataFrame, Callable[[], None]]:
    """The table, and a check for after its write that raises if a required column had nulls.

    The nulls are counted while the rows are written, so the check reads nothing.
    """
    seen, broken = Observation(), {c: b for c, rule, b in rules if rule == "not_null"}

    def check() -> None:
        for column, nulls in seen.get.items():
            if nulls:
                raise IntegrityError(f"{nulls} nulls in {name}.{column}")

    return df.observe(seen, *[F.count_if(b).alias(c) for c, b in broken.items()]), check


def assert_no_orphans(aspects: DataFrame, reviews: DataFrame, known: DataFrame | None = None) -> None:
    """Raises if an aspect has no id, or a review neither in ``reviews`` nor, by its stripped id, in
    ``known``. Aspects are counted by id before anything is shuffled."""
    ids = conform(aspects.select("review_id"), REVIEW_IDS).groupBy("review_id").agg(F.count(F.lit(1)).alias("_rows"))
    lost = ids.join(reviews.select("review_id").hint("shuffle_hash"), "review_id", "left_anti")
    if known is not None:
        lost = pending_reviews(lost, known, hashed=True)
    nameless = F.col("review_id").isNull()
    found = lost.agg(*[F.coalesce(F.sum(F.when(which, F.col("_rows"))), F.lit(0)).alias(name)
                       for name, which in (("nulls", nameless), ("orphans", ~nameless))]).first()
    if found["nulls"]:
        raise IntegrityError(f"{found['nulls']} nulls in review_aspects.review_id")
    if found["orphans"]:
        raise IntegrityError(f"{found['orphans']} aspect rows without a review")


def _save(df: DataFrame, name: str, buckets: int | None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, "review_id").sortBy("review_id")
    writer.saveAsTable(name)


def save_tables(spark: SparkSession, reviews: DataFrame, aspects: DataFrame,
                names: TableNames = TableNames(), buckets: int | None = None,
                order: Sequence[Column | str] = ()) -> None:
    """Replaces both tables. Of a repeated review id the first row by ``order`` is kept.

    The inputs are computed once: what is checked is what is published. With ``buckets`` both
    tables are bucketed by review id, and later joins on it need no shuffle.
    """
    unique, unique_folder = stored_at(
        conform(first_per_key(reviews, ["review_id"], order), REVIEWS), "reviews")
    numbered, numbered_folder = stored_at(conform(with_aspect_id(aspects), REVIEW_ASPECTS), "aspects")
    assert_loadable(unique, numbered)
    _save(unique, names.reviews, buckets)
    _save(numbered, names.aspects, buckets)
    removed(spark, unique_folder)
    removed(spark, numbered_folder)


def save_summary(summary: DataFrame, names: TableNames = TableNames()) -> None:
    """The summary table that a dashboard reads."""
    summary.write.mode("overwrite").format("parquet").saveAsTable(names.summary)
