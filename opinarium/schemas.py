"""Table schemas and the fixed word lists of the feedback data model."""

from __future__ import annotations

from pyspark.sql import types as T

# The sentiment vocabularies of a review and of one aspect mention.
OVERALL_SENTIMENTS = ("positive", "neutral", "negative", "mixed")
ASPECT_SENTIMENTS = ("positive", "neutral", "negative")

# The standard aspect names. The list is open, extractors may add names.
STANDARD_ASPECTS = (
    "shade_match", "pigmentation", "coverage", "texture", "application", "longevity",
    "packaging", "fragrance", "finish", "price_value", "quantity", "effectiveness",
    "hair_effect", "skin_feel", "scalp_effect", "formula", "quality",
)

# The cell texts that pandas' CSV reader takes for missing by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

RATING_MIN, RATING_MAX = 1.0, 5.0

DEFAULT_SAMPLE_SIZE = 1500
DEFAULT_SEED = 42
DEFAULT_STRATA = ("brand_name", "review_rating")


def _field(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


REVIEWS = T.StructType([
    _field("review_id", T.StringType(), False),
    _field("product_id", T.StringType()),
    _field("brand_name", T.StringType()),
    _field("product_title", T.StringType()),
    _field("review_title", T.StringType()),
    _field("review_text", T.StringType()),
    _field("review_date", T.TimestampNTZType()),
    _field("review_rating", T.DoubleType()),
    _field("is_a_buyer", T.BooleanType()),
    _field("pro_user", T.BooleanType()),
    _field("review_label", T.StringType()),
    _field("mrp", T.DoubleType()),
    _field("price", T.DoubleType()),
    _field("product_rating", T.DoubleType()),
    _field("product_rating_count", T.DoubleType()),
    _field("product_tags", T.StringType()),
    _field("product_url", T.StringType()),
    _field("overall_sentiment", T.StringType(), False),
    _field("extraction_method", T.StringType(), False),
])

REVIEW_ASPECTS = T.StructType([
    _field("aspect_id", T.LongType(), False),
    _field("review_id", T.StringType(), False),
    _field("pos", T.LongType(), False),
    _field("aspect", T.StringType(), False),
    _field("aspect_sentiment", T.StringType(), False),
    _field("issue", T.StringType()),
])

# What an extractor run leaves behind for each review, before any parsing.
RAW_EXTRACTIONS = T.StructType([
    _field("review_id", T.StringType()),
    _field("raw", T.StringType()),
    _field("extraction_method", T.StringType()),
    _field("attempts", T.IntegerType()),
    _field("error", T.StringType()),
])
