"""Reading and writing review tables: CSV at the edges, Parquet in between."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinarium.schemas import NA_TOKENS

_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")

#: Sorts raw rows as they stand in their files.
INGEST_ORDER = "ingest_order"


def missing_to_null(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Turns the texts that stand for a missing value into nulls; only text columns change."""
    return df.select(*[F.when(~F.col(c).isin(*tokens), F.col(c)).alias(c) if t == "string" else c
                       for c, t in df.dtypes])


def read_reviews_csv(spark: SparkSession, path: str, tokens: Sequence[str] = NA_TOKENS,
                     multiline: bool = True, ingest_order: bool = False) -> DataFrame:
    """Raw reviews, every column a string, named by the header.

    Quoted cells may hold line breaks and doubled quotes. Such files are read one task per
    file; where no cell holds a line break, ``multiline=False`` lets Spark split large files.
    Files whose headers differ are refused, since their cells would land in wrong columns.
    ``ingest_order`` adds the place of each row: its file, the block of the file that a task
    read, and its number in the task.
    """
    raw = spark.read.csv(path, header=True, multiLine=multiline, quote='"', escape='"',
                         enforceSchema=False)
    if ingest_order:
        raw = raw.withColumn(INGEST_ORDER, F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row")))
    return missing_to_null(raw, tokens)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table, or no rows if it does not exist. Other errors are not hidden."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in _ABSENT:
            raise
        return spark.createDataFrame([], schema)


def is_finished(spark: SparkSession, path: str) -> bool:
    """True if a whole Parquet table lies there: its commit marker is written last."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def stage(spark: SparkSession, path: str, build: Callable[[], DataFrame],
          overwrite: bool = False) -> DataFrame:
    """The table at ``path``, built and written first if it is not there yet."""
    if overwrite or not is_finished(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export that :func:`read_reviews_csv` reads back."""
    df.write.mode(mode).csv(path, header=True, quote='"', escape='"')


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema, by name and type; missing ones are null, others go.

    Texts that are no value of the column's type become null.
    """
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).try_cast(f.dataType).alias(f.name)
        for f in schema.fields])
