"""Tables laid out by brand, so that reports on some brands read only the files of these brands.

Both tables get a column ``brand_part``, by which their files lie in folders. It is the brand behind a
mark, so brands that are missing, empty or look like numbers keep their folder and their type; the
brand itself stays among the columns. The rows of a brand are written by as many tasks as its count
asks for. Made for up to some thousands of brands, as every brand is a folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinarium.session import stored

PART = "brand_part"
ROWS_PER_FILE = 2_000_000
_GIVEN, _MISSING = "b:", "none"


def brand_part(brand: Column) -> Column:
    """The folder of a brand."""
    return F.coalesce(F.concat(F.lit(_GIVEN), brand), F.lit(_MISSING))


@dataclass(frozen=True)
class BrandTable:
    """A table laid out by brand: its folder and its columns without ``brand_part``."""

    path: str
    schema: T.StructType

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(T.StructType([*self.schema.fields, T.StructField(PART, T.StringType())])).parquet(self.path)

    def of_brands(self, spark: SparkSession, brands: Sequence[str | None]) -> DataFrame:
        """The rows of the listed brands; other folders are left out while planning. ``None`` stands
        for rows without a brand. An empty list gives no rows."""
        parts = [_MISSING if b is None else _GIVEN + b for b in brands]
        return self.rows(spark).filter(F.col(PART).isin(*parts) if parts else F.lit(False)).drop(PART)

    def of_chosen(self, spark: SparkSession, chosen: DataFrame, brand: str = "brand_name") -> DataFrame:
        """The rows of the brands that another table names, once each however often it names them.

        Where that table is filtered and small enough for Spark to broadcast, the other folders are
        left out at run time; else it is a semi join.
        """
        named = chosen.select(brand_part(F.col(brand)).alias(PART)).distinct()
        return self.rows(spark).join(named, PART, "left_semi").select(*self.schema.names)


def write_by_brand(df: DataFrame, path: str, brand: str = "brand_name",
                   rows_per_file: int = ROWS_PER_FILE) -> BrandTable:
    """Replaces the table at ``path`` by ``df``, laid out by ``brand``. A brand with many rows is
    spread over several tasks and files; ``df`` is read twice, first to count its brands."""
    if PART in df.columns:
        raise ValueError(f"the table has a column {PART} already")
    placed = df.withColumn(PART, brand_part(F.col(brand)))
    counts = placed.groupBy(F.col(PART).alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    spread = stored(counts.select("_part", F.ceil(F.col("_rows") / rows_per_file).alias("_tasks")), "brand-rows")
    dealt = placed.join(spread, placed[PART] == spread["_part"])
    dealt = dealt.repartition(PART, F.pmod(F.xxhash64(*df.columns), F.col("_tasks")))
    dealt.select(*df.columns, PART).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file) \
        .partitionBy(PART).parquet(path)
    return BrandTable(path, df.schema)


def write_aspects_by_brand(reviews: DataFrame, aspects: DataFrame, path: str,
                           rows_per_file: int = ROWS_PER_FILE) -> BrandTable:
    """Aspects with the brand of their review, laid out by it. Aspects without a review drop out; of a
    repeated review id the first brand in alphabetical order counts."""
    brands = reviews.groupBy("review_id").agg(F.min("brand_name").alias("brand_name"))
    return write_by_brand(aspects.join(brands, "review_id"), path, rows_per_file=rows_per_file)
