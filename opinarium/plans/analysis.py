"""The business questions, each a short plan over the metric operators.

``reviews`` has one row per review and ``aspects`` one row per aspect mention. All sorts end
in the grouping keys, so equal measures always come out in the same order. Every report over
reviews takes ``brands``, which keeps the reviews of these brands only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinarium.functions.measures import (
    DISCOUNT_BANDS,
    DISCOUNT_EDGES,
    UNKNOWN_BAND,
    band,
    discount_pct,
    pct,
    position,
)
from opinarium.functions.once import computed_once
from opinarium.operators import metrics as m
from opinarium.schemas import ASPECT_SENTIMENTS

PRODUCT = ("product_id", "brand_name", "product_title")
NEGATIVE = "negative"


def for_brands(reviews: DataFrame, brands: Sequence[str] | None) -> DataFrame:
    """Keeps the reviews of the given brands; all of them if no brand is given."""
    return reviews if not brands else reviews.filter(F.col("brand_name").isin(*brands))


def by_brand(report: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Gives a report the argument ``brands``: only the reviews of these brands count."""

    @wraps(report)
    def filtered(reviews: DataFrame, *args, brands: Sequence[str] | None = None,
                 **kwargs) -> DataFrame:
        return report(for_brands(reviews, brands), *args, **kwargs)

    return filtered


def aspects_of(reviews: DataFrame, aspects: DataFrame, brands: Sequence[str] | None) -> DataFrame:
    """The aspects of reviews of the given brands, for reports over aspects alone; all if none is
    given. Only ids are joined."""
    if not brands:
        return aspects
    return aspects.join(for_brands(reviews, brands).select("review_id").distinct(), "review_id", "left_semi")


def mentions(reviews: DataFrame, aspects: DataFrame) -> DataFrame:
    """Aspect mentions with the columns of their review. Reviews without aspects drop out.

    The plan picks the join from measured sizes; a review with very many aspects is split
    by the adaptive skew join.
    """
    return reviews.join(aspects, "review_id")


def _is_negative():
    return F.col("aspect_sentiment") == NEGATIVE


# --- review level ---------------------------------------------------------------------


@by_brand
def overall_sentiment(reviews: DataFrame) -> DataFrame:
    counts = m.count_by(reviews, ["overall_sentiment"], "review_count")
    out = m.share_of_total(counts, [], "review_count", "_all", "percentage").drop("_all")
    return m.ordered(out, F.desc("review_count"), "overall_sentiment")


@by_brand
def product_sentiment_rank(reviews: DataFrame) -> DataFrame:
    base = m.require_keys(reviews, "product_id")
    counts = m.count_by(base, [*PRODUCT, "overall_sentiment"], "sentiment_count")
    out = m.share_of_total(counts, ["product_id"], "sentiment_count", "total_reviews",
                           "sentiment_pct", closed=True)
    out = m.rank_within(out, ["product_id"], [F.desc("sentiment_count")], "sentiment_rank")
    return m.ordered(out, "product_id", "sentiment_rank", "overall_sentiment", *PRODUCT[1:])


@by_brand
def rating_alignment(reviews: DataFrame) -> DataFrame:
    base = m.require_keys(reviews, "review_rating")
    counts = m.count_by(base, ["review_rating", "overall_sentiment"], "sentiment_count")
    out = m.share_of_total(counts, ["review_rating"], "sentiment_count", "total_reviews",
                           "sentiment_pct", closed=True)
    return m.ordered(out, "review_rating", F.desc("sentiment_pct"), "overall_sentiment")


@by_brand
def dominant_sentiment_by_rating(reviews: DataFrame) -> DataFrame:
    base = m.require_keys(reviews, "review_rating")
    counts = m.count_by(base, ["review_rating", "overall_sentiment"], "sentiment_count")
    out = m.share_of_total(counts, ["review_rating"], "sentiment_count", "total_reviews",
                           "sentiment_pct", closed=True)
    out = m.top_class(out, ["review_rating"], "sentiment_count", "overall_sentiment")
    return m.ordered(out, "review_rating")


@by_brand
def negative_or_mixed_products(reviews: DataFrame, min_reviews: int = 5,
                               top: int | None = None) -> DataFrame:
    out = m.class_share(reviews, PRODUCT, "overall_sentiment", (NEGATIVE, "mixed"),
                        "sampled_review_count", "negative_or_mixed_pct", min_reviews)
    return m.ordered(out, F.desc("negative_or_mixed_pct"), F.desc("sampled_review_count"),
                     *PRODUCT, top=top)


@by_brand
def review_kpis(reviews: DataFrame) -> DataFrame:
    """Reviews per brand, per rating and per year, from one pass over the table."""
    wide = reviews.select(
        F.col("brand_name").alias("brand"),
        F.col("review_rating").cast("string").alias("rating"),
        F.year("review_date").cast("string").alias("year"),
    )
    long = wide.unpivot([], ["brand", "rating", "year"], "dimension", "value")
    counts = m.count_by(m.require_keys(long, "value"), ["dimension", "value"], "review_count")
    return m.ordered(counts, "dimension", F.desc("review_count"), "value")


@by_brand
def reviews_by_year(reviews: DataFrame) -> DataFrame:
    years = reviews.select(F.year("review_date").cast("bigint").alias("review_year"))
    counts = m.count_by(m.require_keys(years, "review_year"), ["review_year"], "review_count")
    return m.ordered(counts, "review_year")


@by_brand
def rating_distribution(reviews: DataFrame) -> DataFrame:
    base = m.require_keys(reviews, "review_rating")
    return m.ordered(m.count_by(base, ["review_rating"], "review_count"), "review_rating")


# --- aspect level ---------------------------------------------------------------------


@by_brand
def product_aspect_mentions(reviews: DataFrame, aspects: DataFrame) -> DataFrame:
    keys = [*PRODUCT, "aspect", "aspect_sentiment"]
    counts = m.count_by(mentions(reviews, aspects), keys, "mention_count")
    return m.ordered(counts, "product_id", F.desc("mention_count"), *keys[1:])


@by_brand
def product_sentiment_weight(reviews: DataFrame, aspects: DataFrame) -> DataFrame:
    keys = [*PRODUCT, "aspect", "aspect_sentiment"]
    base = m.require_keys(mentions(reviews, aspects), "product_id")
    counts = m.count_by(base, keys, "sentiment_count")
    out = m.share_of_total(counts, ["product_id"], "sentiment_count",
                           "total_aspect_mentions", "sentiment_weight_pct")
    return m.ordered(out, "product_id", F.desc("sentiment_weight_pct"), *keys[1:])


@by_brand
def negative_rate(reviews: DataFrame, aspects: DataFrame, min_mentions: int = 3,
                  top: int | None = None) -> DataFrame:
    keys = [*PRODUCT, "aspect"]
    out = m.flag_rate(mentions(reviews, aspects), keys, _is_negative(),
                      "total_aspect_mentions", "negative_mentions", "negative_rate_pct",
                      min_mentions)
    return m.ordered(out, F.desc("negative_rate_pct"), F.desc("total_aspect_mentions"), *keys,
                     top=top)


def priority_pain_points(reviews: DataFrame, aspects: DataFrame, min_mentions: int = 3,
                         brands: Sequence[str] | None = None,
                         top: int | None = None) -> DataFrame:
    keys = [*PRODUCT, "aspect"]
    out = m.rate_and_weight(mentions(for_brands(reviews, brands), aspects), ["product_id"],
                            keys, _is_negative(), "aspect_mentions", "negative_mentions",
                            "negative_rate_pct", "negative_weight_pct", min_mentions)
    return m.ordered(out, F.desc("negative_weight_pct"), F.desc("negative_rate_pct"), *keys,
                     top=top)


@by_brand
def brand_pain_points(reviews: DataFrame, aspects: DataFrame,
                      min_mentions: int = 5) -> DataFrame:
    weight = "negative_weight_within_brand_pct"
    out = m.rate_and_weight(mentions(reviews, aspects), ["brand_name"],
                            ["brand_name", "aspect"], _is_negative(), "aspect_mentions",
                            "negative_mentions", "negative_rate_pct", weight, min_mentions)
    return m.ordered(out, "brand_name", F.desc(weight), F.desc("negative_rate_pct"), "aspect")


@by_brand
def discount_band_sentiment(reviews: DataFrame, aspects: DataFrame,
                            aspect: str = "price_value") -> DataFrame:
    discounts = computed_once(reviews.select("review_id", "mrp", "price"),
                              {"_pct": discount_pct(F.col("mrp"), F.col("price"))})
    banded = discounts.filter(F.col("_pct").isNotNull()).select(
        "review_id",
        band(F.col("_pct"), DISCOUNT_EDGES, DISCOUNT_BANDS, UNKNOWN_BAND).alias("discount_band"))
    base = mentions(banded, aspects.filter(F.col("aspect") == aspect))
    counts = m.count_by(base, ["discount_band", "aspect_sentiment"], "sentiment_count")
    out = m.share_of_total(counts, ["discount_band"], "sentiment_count",
                           "total_price_value_mentions", "sentiment_pct", closed=True)
    return m.ordered(out, position(F.col("discount_band"), DISCOUNT_BANDS),
                     F.desc("sentiment_pct"), "aspect_sentiment")


def complaint_drilldown(reviews: DataFrame, aspects: DataFrame,
                        brands: Sequence[str] | None = None,
                        aspect: str | None = None) -> DataFrame:
    """Issue and full review text of each negative mention.

    The sort goes on to the review id, so rows of one brand, product and aspect can be
    spread over several range partitions.
    """
    complaints = aspects.filter(_is_negative() & F.col("issue").isNotNull())
    if aspect is not None:
        complaints = complaints.filter(F.col("aspect") == aspect)
    rows = mentions(for_brands(reviews, brands), complaints)
    rows = rows.orderBy("brand_name", "product_title", "aspect", "review_id", "issue")
    return rows.select("brand_name", "product_title", "review_rating", "aspect", "issue",
                       "review_text")


@by_brand
def product_aspect_summary(reviews: DataFrame, aspects: DataFrame) -> DataFrame:
    keys = [*PRODUCT, "aspect"]
    out = m.pivot_counts(mentions(reviews, aspects), keys, "aspect_sentiment",
                         ASPECT_SENTIMENTS, "total_mentions")
    out = out.withColumn("negative_rate_pct",
                         pct(F.col("negative_mentions"), F.col("total_mentions")))
    return m.ordered(out, "brand_name", "product_title", F.desc("total_mentions"),
                     "product_id", "aspect")


def aspect_frequency(aspects: DataFrame, top: int | None = None) -> DataFrame:
    counts = m.count_by(m.require_keys(aspects, "aspect"), ["aspect"], "mention_count")
    return m.ordered(counts, F.desc("mention_count"), "aspect", top=top)


def aspect_negative_rate(aspects: DataFrame, min_mentions: int = 0,
                         top: int | None = None) -> DataFrame:
    out = m.flag_rate(aspects, ["aspect"], _is_negative(), "aspect_mentions",
                      "negative_mentions", "negative_rate_pct", min_mentions)
    return m.ordered(out, F.desc("negative_rate_pct"), "aspect", top=top)


def aspect_sentiment_share(aspects: DataFrame) -> DataFrame:
    counts = m.count_by(aspects, ["aspect_sentiment"], "mention_count")
    out = m.share_of_total(counts, [], "mention_count", "total_mentions", "mention_pct")
    return m.ordered(out, F.desc("mention_count"), "aspect_sentiment")


@by_brand
def aspect_coverage(reviews: DataFrame, aspects: DataFrame) -> DataFrame:
    """How many reviews have at least one aspect, and how many have none.

    The ids are made distinct first, so a review with very many aspects counts once.
    """
    having = aspects.select("review_id").distinct().withColumn("_has", F.lit(1))
    whole, have = F.col("total_reviews"), F.col("with_aspects")
    counts = reviews.select("review_id").join(having, "review_id", "left").agg(
        F.count(F.lit(1)).alias("total_reviews"), F.count("_has").alias("with_aspects"))
    return counts.select(
        "total_reviews", "with_aspects", (whole - have).alias("without_aspects"),
        pct(have, whole).alias("with_aspects_pct"),
        pct(whole - have, whole).alias("without_aspects_pct"),
    )
