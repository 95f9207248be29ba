"""A training corpus from raw documents: language, copies, near copies, secrets, sequences.

Every stage takes (spark, docs, sf_dir), where docs are the rows its predecessor kept, and returns
a DataFrame that is written as Parquet and read again as the next stage's docs.

Null and empty texts, and texts without letters, go in the first stage, as do long texts without a
certain language; short texts stay. Rows that repeat a text leave one, the largest by id (null is the
smallest id) and then by the other columns; of near copies the smallest id stays (null is the largest).
Further columns, whatever their names, pass all stages but the last as they were. Texts of any length
are read whole. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinarium.llm import exact_dedup, langid, near_dedup, packing, secrets
from opinarium.llm.queries import ranks_path, table
from opinarium.session import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long documents without a certain language go, and those without letters. Profiles are fitted on the declared languages."""
    return langid.readable_documents(docs, langid.train(docs))


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts the document with the smallest id stays."""
    return near_dedup.drop_near_copies(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes."""
    return secrets.redacted(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in training sequences."""
    return packing.pack_documents(docs, ranks_path())


STAGES = [
    ("language", language),
    ("exact_dedup", copies),
    ("near_dedup", near_copies),
    ("secrets", without_secrets),
    ("packing", sequences),
]

#: Stages 1, 3 and 5 cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
