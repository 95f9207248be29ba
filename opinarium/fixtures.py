"""The feedback tables, derived from the generated test tables.

Orders stand for reviews, their lines for aspect mentions, customers for products and
documents for raw review text. ``oracles.py`` states the same views in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What a line number and a return flag stand for.
ASPECT_OF_LINE = {
    1: "shade_match", 2: "finish", 3: "effectiveness", 4: "application",
    5: "pigmentation", 6: "price_value",
}
OTHER_ASPECT = "longevity"
SENTIMENT_OF_FLAG = {"A": "positive", "N": "neutral"}

# Extraction responses, good and bad, by document number modulo 10.
RESPONSES = {
    0: '{"overall_sentiment":"neutral","aspects":[]}',
    1: "not json",
    2: '{"aspects":[]}',
    3: '{"overall_sentiment":"great","aspects":[]}',
    4: '{"overall_sentiment":"positive","aspects":[{"aspect":"finish"}]}',
    5: '{"overall_sentiment":"positive"}',
}
FULL_RESPONSE = (
    '{"overall_sentiment":"mixed","aspects":['
    '{"aspect":" Shade Match","aspect_sentiment":"Positive","issue":null},'
    '{"aspect":"longevity","aspect_sentiment":"negative","issue":"fades"}]}'
)


# The columns of the generated tables that the views use. Stating them saves a job that
# would only read file footers.
COLUMNS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_quantity double, l_returnflag string, "
                "l_linestatus string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str):
    return F.col(column).cast("string")


def _chosen(rows: DataFrame, key: str, chosen: Callable[[Column], Column] | None) -> DataFrame:
    """Some rows by their review number, while it is a number; a condition on the id reads it out of
    the text again, for every row of the table."""
    return rows.filter(chosen(F.col(key))) if chosen else rows


def reviews(spark: SparkSession, sf_dir: str, chosen: Callable[[Column], Column] | None = None) -> DataFrame:
    key = F.col("o_orderkey")
    total = F.col("o_totalprice")
    discount = ((key % 9 - 1).cast("double")) * F.lit(0.045)
    joined = _chosen(table(spark, sf_dir, "orders"), "o_orderkey", chosen).join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        _text("o_orderkey").alias("review_id"),
        _text("o_custkey").alias("product_id"),
        F.col("c_mktsegment").alias("brand_name"),
        F.col("c_name").alias("product_title"),
        F.concat(F.lit("Order "), _text("o_orderkey"), F.lit(" "), F.col("o_orderpriority"))
        .alias("review_text"),
        F.col("o_orderdate").alias("review_date"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("review_rating"),
        F.when(key % 23 == 0, None).when(key % 29 == 0, F.lit(0.0)).otherwise(total)
        .alias("mrp"),
        F.when(key % 31 != 0, total * (F.lit(1.0) - discount)).alias("price"),
        F.when(key % 8 == 0, "mixed").when(key % 97 == 0, "neutral")
        .when(F.col("o_orderstatus") == "F", "negative").otherwise("positive")
        .alias("overall_sentiment"),
        F.lit("fixture").alias("extraction_method"),
    )


def review_aspects(spark: SparkSession, sf_dir: str, chosen: Callable[[Column], Column] | None = None) -> DataFrame:
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    aspect = F.lit(OTHER_ASPECT)
    for number, name in ASPECT_OF_LINE.items():
        aspect = F.when(line == number, name).otherwise(aspect)
    sentiment = F.lit("negative")
    for value, name in SENTIMENT_OF_FLAG.items():
        sentiment = F.when(flag == value, name).otherwise(sentiment)
    return _chosen(table(spark, sf_dir, "lineitem"), "l_orderkey", chosen).select(
        _text("l_orderkey").alias("review_id"),
        aspect.alias("aspect"),
        sentiment.alias("aspect_sentiment"),
        F.when((flag == "R") & (F.col("l_linestatus") == "F"),
               F.concat(F.lit("qty "), F.col("l_quantity").cast("int").cast("string")))
        .alias("issue"),
    )


def placed_aspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aspect mentions with the number of their review and their place in it."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("review_number"), _text("l_orderkey").alias("review_id"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("pos"))


def whole_reviews_with_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews, some of them twice in all columns, without product, brand or rating in some rows."""
    key = F.col("review_id").cast("bigint")
    first = reviews(spark, sf_dir).withColumns({
        "product_id": F.when(key % 37 != 0, F.col("product_id")), "brand_name": F.when(key % 41 != 0, F.col("brand_name")),
        "review_rating": F.when(key % 43 != 0, F.col("review_rating"))})
    return first.unionByName(first.filter(key % 10 == 0)).unionByName(first.filter(key % 37 == 0))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_reviews_of(table(spark, sf_dir, "documents"))


def raw_reviews_of(documents: DataFrame) -> DataFrame:
    """Dirty string columns over documents; also usable on a stream of them."""
    key = F.col("doc_id")
    return documents.select(
        _text("doc_id").alias("review_id"),
        F.concat(F.lit("P"), (key % 40).cast("string")).alias("product_id"),
        F.concat(F.lit(" "), F.col("source"), F.lit(" ")).alias("brand_name"),
        F.when(key % 19 == 0, None).when(key % 17 == 0, " <br/> ")
        .otherwise(F.concat(F.lit("  <b>"), F.col("text"), F.lit("</b><br/> ")))
        .alias("review_text"),
        F.when(key % 11 == 0, None).when(key % 13 == 0, "abc")
        .otherwise((key % 7).cast("string")).alias("review_rating"),
        F.when(key % 9 == 0, "2021-13-01")
        .otherwise(F.concat(F.lit("2021-0"), (key % 9).cast("string"), F.lit("-15")))
        .alias("review_date"),
        F.when(key % 5 == 0, "n/a").otherwise(_text("n_chars")).alias("price"),
    )


def quoted_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reviews with quotes, line breaks of both kinds and separators inside of the text."""
    broken = F.concat(F.lit('He said "'), F.col("review_id"), F.lit('",\n"so\r\n\n'), F.col("review_text"))
    return raw_reviews(spark, sf_dir).withColumn("review_text", broken)


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("doc_id") % 10
    raw = F.lit(FULL_RESPONSE)
    for number, body in RESPONSES.items():
        raw = F.when(kind == number, body).otherwise(raw)
    return table(spark, sf_dir, "documents").select(
        _text("doc_id").alias("review_id"), raw.alias("raw"))


def checkpoint_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded ids of the reviews that count as processed."""
    done = reviews(spark, sf_dir, lambda number: number % 3 == 0)
    return done.select(F.concat(F.lit(" "), F.col("review_id"), F.lit(" ")).alias("review_id"))


def reviews_with_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = reviews(spark, sf_dir).select("review_id", "overall_sentiment")
    again = first.filter(F.col("review_id").cast("bigint") % 10 == 0).select(
        "review_id", F.lit("neutral").alias("overall_sentiment"))
    return first.withColumn("ingest_order", F.lit(0)).unionByName(
        again.withColumn("ingest_order", F.lit(1)))


def aspects_with_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("review_id")
    return review_aspects(spark, sf_dir).withColumn(
        "review_id",
        F.when(key.cast("bigint") % 50 == 0, F.concat(F.lit("X"), key)).otherwise(key))
