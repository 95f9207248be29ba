"""Reviews, their aspects and the summary over both, published as one version.

A load or a delete computes the next pair of tables from the current version. The summary is not
computed again: the counts of what came, and those of what went with their signs turned, lie beside
the others as parts. ``summary_of`` sums the parts and refuses sums that cannot be.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from opinarium.operators.integrity import aspect_rules, review_rules
from opinarium.functions.text import id_key
from opinarium.operators.resume import ID_KEY, distinct_ids, first_pending, first_per_key
from opinarium.operators.summary import KEYS, changed_counts, mention_counts, retracted
from opinarium.schemas import REVIEW_ASPECTS, REVIEWS
from opinarium.session import removed, stored_at
from opinarium.sources.files import conform
from opinarium.sources.snapshots import NoSnapshot, Snapshot, publish, snapshot
from opinarium.sources.tables import assert_no_orphans, nulls_counted, with_aspect_id

#: A load that meets so many parts writes them anew as one; so does any change with those of the counts.
MOST_PARTS = 32
REVIEWS_TABLE, ASPECTS_TABLE, COUNTS_TABLE = "reviews", "review_aspects", "mention_counts"


def _current(spark: SparkSession, root: str) -> Snapshot | None:
    try:
        return snapshot(spark, root)
    except NoSnapshot:
        return None


def _counts(spark: SparkSession, now: Snapshot | None, change: DataFrame) -> DataFrame:
    """The counts that a change writes: its own, or if their parts are many all of them as one."""
    return change if not now or _carried_counts(now) else changed_counts(now.table(spark, COUNTS_TABLE), change)


def _carried_counts(now: Snapshot | None) -> dict[str, int]:
    """The parts of counts that go on beside those of a change."""
    parts = now.parts[COUNTS_TABLE] if now else {}
    return parts if len(parts) < MOST_PARTS else {}


def load(spark: SparkSession, root: str, reviews: DataFrame, aspects: DataFrame,
         order: Sequence[Column | str] = ()) -> Snapshot:
    """Adds reviews that are not there yet, with their aspects; of a repeated id the first row by
    ``order`` counts. Aspects of reviews that are there already do not come in again; an aspect
    without a review at all fails the load, and nothing changes. What was there is not written again,
    unless a table has ``MOST_PARTS``.

    Rows are written once, where they are published. Aspects are read once: each is looked up among
    the ids of the new reviews and those there before, and the ones in neither are counted as they
    pass. Only if there are some are they looked for by stripped id.
    """
    now = _current(spark, root)
    known = now.table(spark, REVIEWS_TABLE) if now else None
    # Known ids go first: of a load that was there before nothing is put in order.
    first = first_pending(reviews, known, order) if now else first_per_key(reviews, ["review_id"], order)
    fresh, check_fresh = nulls_counted(REVIEWS_TABLE, conform(first, REVIEWS), review_rules())
    met, checks = Observation(), []

    def own_mentions(new: DataFrame) -> DataFrame:
        check_fresh()
        # No id is there twice, as it stands.
        ids = new.select(F.col("review_id").alias("_of"), F.lit(True).alias("_own"))
        if now:
            ids = ids.unionByName(known.select(F.col("review_id").alias("_of"), F.lit(False).alias("_own")))
        met_ids = aspects.join(ids.hint("shuffle_hash"), F.col("review_id").try_cast("string") == F.col("_of"), "left")
        watched = met_ids.observe(met, F.count_if(F.col("_own").isNull()).alias("unmet"))
        mentions = with_aspect_id(watched.filter("_own").select(*aspects.columns))
        own, check = nulls_counted(ASPECTS_TABLE, conform(mentions, REVIEW_ASPECTS), aspect_rules())
        checks.append(check)
        return own

    def counts(new: DataFrame, own: DataFrame) -> DataFrame:
        # A plan that was cut short has no count.
        if met.get.get("unmet") != 0:
            assert_no_orphans(aspects, new, known)
        checks[0]()
        return _counts(spark, now, mention_counts(new, own))

    if now and len(now.parts[REVIEWS_TABLE]) >= MOST_PARTS:
        new, new_folder = stored_at(fresh, "fresh-reviews")
        own, own_folder = stored_at(own_mentions(new), "fresh-aspects")
        made = publish(spark, root, {
            REVIEWS_TABLE: known.unionByName(new), ASPECTS_TABLE: now.table(spark, ASPECTS_TABLE).unionByName(own),
            COUNTS_TABLE: counts(new, own)}, {COUNTS_TABLE: _carried_counts(now)}, based_on=now.version)
        removed(spark, new_folder)
        removed(spark, own_folder)
        return made
    carried = {t: now.parts[t] for t in (REVIEWS_TABLE, ASPECTS_TABLE)} if now else {}
    return publish(spark, root, {
        REVIEWS_TABLE: fresh,
        ASPECTS_TABLE: lambda written: own_mentions(written[REVIEWS_TABLE]),
        COUNTS_TABLE: lambda written: counts(written[REVIEWS_TABLE], written[ASPECTS_TABLE]),
    }, {**carried, COUNTS_TABLE: _carried_counts(now)}, based_on=now.version if now else 0)


def delete(spark: SparkSession, root: str, ids: DataFrame) -> Snapshot:
    """Removes reviews by id, their aspects with them, and takes both off the summary.

    Only the parts that hold some of the ids are written again. A review and its aspects lie in
    parts of the same name.
    """
    now = snapshot(spark, root)
    every = [now.table(spark, REVIEWS_TABLE, [p]).select(
        id_key(F.col("review_id")).alias(ID_KEY), "review_id", *KEYS[:-1], F.lit(i).alias("part"))
        for i, p in enumerate(now.parts[REVIEWS_TABLE])]
    # The reviews that go, with the columns that their aspects are counted by. The ids are distinct,
    # and other than a semi join this one is not made once for each part.
    found = reduce(DataFrame.unionByName, every).join(distinct_ids(ids).hint("shuffle_hash"), ID_KEY)
    gone, gone_folder = stored_at(found.drop(ID_KEY), "deleted-reviews")
    places = {r["part"] for r in gone.select("part").distinct().collect()}  # at most MOST_PARTS
    hit = {p for i, p in enumerate(now.parts[REVIEWS_TABLE]) if i in places}
    reviews, aspects = (now.table(spark, t, hit) for t in (REVIEWS_TABLE, ASPECTS_TABLE))
    # Aspects have the id of a review as it stands there, so those of the reviews that go are all that go.
    gone_ids = gone.select("review_id").hint("shuffle_hash")
    left, left_aspects = (t.join(gone_ids, "review_id", "left_anti") for t in (reviews, aspects))
    counts = _counts(spark, now, retracted(mention_counts(gone, aspects)))
    tables = {REVIEWS_TABLE: left, ASPECTS_TABLE: left_aspects, COUNTS_TABLE: counts}
    carried = {t: {p: n for p, n in now.parts[t].items() if p not in hit} for t in (REVIEWS_TABLE, ASPECTS_TABLE)}
    carried[COUNTS_TABLE] = _carried_counts(now)
    made = publish(spark, root, tables, carried, based_on=now.version)
    removed(spark, gone_folder)
    return made
