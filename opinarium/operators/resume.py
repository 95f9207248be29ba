"""Which reviews are done, which are pending, and first-wins deduplication.

Ids compare as stripped text. The id side of every semi and anti join is made distinct
first, which Spark does partly before the shuffle, so repeated ids arrive once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opinarium.functions.text import id_key

#: The column of stripped ids.
ID_KEY = "_id_key"


def distinct_ids(df: DataFrame, key: str = "review_id") -> DataFrame:
    return df.select(id_key(F.col(key)).alias(ID_KEY)).distinct()


def _against(df: DataFrame, others: DataFrame, key: str, how: str, hashed: bool = False) -> DataFrame:
    """A semi or anti join on the id. The key is a column of its own, as an expression would be
    worked out again in every comparison of the sort.

    With ``hashed`` a task holds a table of its distinct ids, and the rows of ``df``, of which an id
    may have many, stream past it: nothing of theirs is sorted or kept.
    """
    ids = distinct_ids(others, key)
    if hashed:
        ids = ids.hint("shuffle_hash")
    return df.withColumn(ID_KEY, id_key(F.col(key))).join(ids, ID_KEY, how).select(*df.columns)


def pending_reviews(reviews: DataFrame, processed: DataFrame,
                    key: str = "review_id", hashed: bool = False) -> DataFrame:
    """Reviews whose id is not among the processed ones. A review without id is pending."""
    return _against(reviews, processed, key, "left_anti", hashed)


def first_pending(reviews: DataFrame, unique: DataFrame, order: Sequence[Column | str],
                  key: str = "review_id") -> DataFrame:
    """The first row of each id, of reviews whose id is not among those of a table without repeats.

    The ids of that table are not made distinct again. Rows are dealt once, by stripped id, for the
    join and for finding the first row alike.
    """
    known = unique.select(id_key(F.col(key)).alias(ID_KEY)).hint("shuffle_hash")
    rest = reviews.withColumn(ID_KEY, id_key(F.col(key))).join(known, ID_KEY, "left_anti")
    return first_per_key(rest, [ID_KEY, key], order, reviews.columns).select(*reviews.columns)


def known_aspects(aspects: DataFrame, processed: DataFrame,
                  key: str = "review_id", hashed: bool = False) -> DataFrame:
    """Aspect rows whose review is among the processed ones."""
    return _against(aspects, processed, key, "left_semi", hashed)


def resume_counts(reviews: DataFrame, processed: DataFrame,
                  key: str = "review_id") -> DataFrame:
    """Reviews requested, already done and remaining, in one pass."""
    done = distinct_ids(processed, key).withColumn("_done", F.lit(1))
    marked = reviews.select(id_key(F.col(key)).alias(ID_KEY)).join(done, ID_KEY, "left")
    counts = marked.agg(F.count(F.lit(1)).alias("requested"),
                        F.count("_done").alias("already_done"))
    return counts.withColumn("remaining", F.col("requested") - F.col("already_done"))


def first_per_key(df: DataFrame, key: Sequence[str],
                  order: Sequence[Column | str], told_apart: Sequence[str] = ()) -> DataFrame:
    """The first row of each key in the given order; equal rows are told apart by a hash of all
    columns or of those named.

    Spark drops all but the first row of a key in every task before the shuffle (a window
    group limit), so copies of one key do not gather in one task.
    """
    spec = W.partitionBy(*key).orderBy(*order, F.xxhash64(*(told_apart or df.columns)))
    return df.withColumn("_rn", F.row_number().over(spec)).filter("_rn = 1").drop("_rn")


def remove_reviews(reviews: DataFrame, aspects: DataFrame, ids: DataFrame,
                   key: str = "review_id") -> tuple[DataFrame, DataFrame]:
    """Both tables without the given reviews: a delete that cascades to the aspects."""
    return (_against(reviews, ids, key, "left_anti", hashed=True), _against(aspects, ids, key, "left_anti", hashed=True))
