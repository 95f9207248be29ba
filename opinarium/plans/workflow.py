"""The whole job: raw CSV to checked result tables, in stages that can be resumed."""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from opinarium.functions.text import id_key, is_blank
from opinarium.operators import extraction as ex
from opinarium.operators.cleaning import write_cleaned
from opinarium.operators.resume import first_per_key, pending_reviews, resume_counts
from opinarium.operators.sampling import exact_sample
from opinarium.plans.analysis import product_aspect_summary
from opinarium.schemas import (
    DEFAULT_SAMPLE_SIZE,
    DEFAULT_SEED,
    DEFAULT_STRATA,
    NA_TOKENS,
    RAW_EXTRACTIONS,
)
from opinarium.session import stored
from opinarium.sources.files import INGEST_ORDER, is_finished, read_or_empty, read_reviews_csv, stage, write_csv
from opinarium.sources.tables import TableNames, save_summary, save_tables

#: Reviews that one task works through before its round is stored.
ROUND_ROWS_PER_TASK = 1000
#: Where calls are so quick that a round takes less time, several are worked through together.
ROUND_SECONDS = 60.0


def run_extraction(reviews: DataFrame, path: str, factory: ex.ExtractorFactory, method: str,
                   policy: ex.CallPolicy = ex.CallPolicy(on_error=ex.STOP),
                   checkpoint_rows: int | None = None, tasks: int | None = None,
                   max_rate: float | None = None) -> dict[str, int]:
    """Extracts the reviews that have no answer yet and appends the answers to a table.

    The work is done in rounds of about ``checkpoint_rows`` reviews, by default
    ``ROUND_ROWS_PER_TASK`` for each of ``tasks``; a finished round is never repeated. Without
    ``checkpoint_rows`` rounds that end early are taken together, twice as many each time while
    they take no more than about ``ROUND_SECONDS``, so that quick calls do not wait for the start
    of jobs, and a lost run loses minutes at most or one round. The rows of a round are dealt over ``tasks`` tasks, by default as many as the cluster runs side by
    side. ``max_rate`` is the number of calls a second of the whole run, shared by the tasks;
    without it every task keeps the policy's pace. The policy must not be ``fail``, which
    would lose the answers of a round. An error ends the run after its round is stored, unless it
    rejects single reviews; the next run tries them again. A repeated review id is extracted
    once, a row without id not at all, as no answer could be traced back to it. Returns the
    rows requested, done before and remaining at the start.
    """
    if policy.on_error == ex.FAIL:
        raise ValueError("a run in rounds stops at an error or rejects the review")
    spark = reviews.sparkSession
    tasks = tasks or spark.sparkContext.defaultParallelism
    fixed, checkpoint_rows = bool(checkpoint_rows), checkpoint_rows or ROUND_ROWS_PER_TASK * tasks
    if max_rate is not None:
        policy = policy.at_rate(max_rate, tasks)
    answers, pending = f"{path}/answers", f"{path}/pending"
    done = read_or_empty(spark, answers, RAW_EXTRACTIONS).filter(F.col("error").isNull())
    reviews = reviews.filter(F.col("review_id").isNotNull())
    counts = resume_counts(reviews, done).first().asDict()
    if counts["remaining"] == 0:
        return counts

    rounds = math.ceil(counts["remaining"] / checkpoint_rows)
    todo = pending_reviews(reviews, done).select(
        ex.id_key(F.col("review_id")).alias("review_id"), "review_text")
    todo = first_per_key(todo, ["review_id"], []).withColumn(
        "round", F.pmod(F.xxhash64("review_id"), F.lit(rounds)).cast("int"))
    # One file per round: a round is no larger than a checkpoint.
    todo.repartition("round").write.mode("overwrite").partitionBy("round").parquet(pending)
    landed = read_or_empty(spark, pending, todo.schema)
    first, together = 0, 1
    while first < rounds:
        part = landed.filter((F.col("round") >= first) & (F.col("round") < first + together)).drop("round")
        seen, started = Observation(), time.monotonic()
        raw = ex.extract_reviews(part, factory, method, policy, tasks)
        raw = raw.observe(seen, F.count_if(F.col("error").isNotNull()).alias("failed"),
                          F.min("error").alias("example"))
        raw.write.mode("append").parquet(answers)
        if seen.get["failed"] and policy.on_error == ex.STOP:
            raise ex.ExtractionFailed(f"{seen.get['failed']} calls failed, for example: "
                                      f"{seen.get['example']}")
        first += together
        took = time.monotonic() - started
        if not fixed:
            together = together * 2 if 2 * took <= ROUND_SECONDS else max(1, together // 2) if took > ROUND_SECONDS else together
    return counts


def stored_answers(spark: SparkSession, path: str) -> DataFrame:
    """The answers of all rounds, without failed calls."""
    landed = read_or_empty(spark, f"{path}/answers", RAW_EXTRACTIONS)
    return landed.filter(F.col("error").isNull()).drop("error")


def failed_calls(spark: SparkSession, path: str) -> DataFrame:
    """One failed call of each review that has no answer, with its ``call_error``."""
    landed = read_or_empty(spark, f"{path}/answers", RAW_EXTRACTIONS)
    failed = landed.filter(F.col("error").isNotNull()).withColumnRenamed("error", "call_error")
    return first_per_key(pending_reviews(failed, stored_answers(spark, path)), ["review_id"],
                         [F.desc("attempts"), "call_error"])


def draw_sample(cleaned: DataFrame, n: int, strata: Sequence[str], seed: int) -> DataFrame:
    """The sampled reviews, one row per review id: the first by its place in the raw files.

    Ids, strata and places are shuffled and stored, texts are fetched for the sample only. A
    row without id is not drawn, as no answer could be traced back to it.
    """
    present = [c for c in strata if c in cleaned.columns]
    usable = cleaned.filter(~is_blank(F.col("review_text")) & F.col("review_id").isNotNull())
    places = usable.select(id_key(F.col("review_id")).alias("review_id"), *present, INGEST_ORDER)
    first = stored(first_per_key(places, ["review_id"], [INGEST_ORDER]), "first-reviews")
    drawn = stored(exact_sample(first, n, present, seed, ["review_id"]).select(INGEST_ORDER),
                   "drawn-reviews")
    rows = cleaned.join(drawn, INGEST_ORDER, "left_semi").drop(INGEST_ORDER)
    return rows.withColumn("review_id", id_key(F.col("review_id")))


@dataclass(frozen=True)
class WorkflowConfig:
    raw_path: str
    folder: str
    sample_size: int = DEFAULT_SAMPLE_SIZE
    seed: int = DEFAULT_SEED
    strata: Sequence[str] = DEFAULT_STRATA
    date_formats: Sequence[str] = ()
    multiline: bool = True
    overwrite: bool = False
    checkpoint_rows: int | None = None
    tasks: int | None = None
    max_rate: float | None = None
    missing_flag: bool | None = None
    na_tokens: Sequence[str] = NA_TOKENS
    buckets: int | None = None
    csv_export: bool = False
    names: TableNames = field(default_factory=TableNames)


def run_workflow(spark: SparkSession, config: WorkflowConfig, factory: ex.ExtractorFactory,
                 method: str,
                 policy: ex.CallPolicy = ex.CallPolicy(on_error=ex.STOP)) -> dict[str, DataFrame]:
    """Cleans, samples, extracts, parses, checks and publishes.

    Cleaned reviews, sample and parsed answers are stored under ``config.folder``. A stage
    whose table exists is skipped unless ``config.overwrite`` is set; extraction only ever
    does what is missing. Every sampled review is either published or among the rejects.
    """
    folder = config.folder.rstrip("/")
    raw = read_reviews_csv(spark, config.raw_path, config.na_tokens, config.multiline,
                           ingest_order=True)
    # The report comes out of the write of the cleaned rows, so a missing one brings both again.
    both = all(is_finished(spark, f"{folder}/{name}") for name in ("cleaned", "cleaning_report"))
    report = stage(spark, f"{folder}/cleaning_report",
                   lambda: write_cleaned(raw, f"{folder}/cleaned", config.date_formats,
                                         config.missing_flag, [INGEST_ORDER]),
                   config.overwrite or not both)
    cleaned = spark.read.parquet(f"{folder}/cleaned")
    sampled = stage(spark, f"{folder}/sampled",
                    lambda: draw_sample(cleaned, config.sample_size, config.strata, config.seed),
                    config.overwrite)

    run_extraction(sampled, f"{folder}/extraction", factory, method, policy,
                   config.checkpoint_rows, config.tasks, config.max_rate)
    answers = stored_answers(spark, f"{folder}/extraction").unionByName(
        failed_calls(spark, f"{folder}/extraction"), allowMissingColumns=True)
    answers = answers.join(sampled.select("review_id"), "review_id", "left_semi")
    parsed = stage(spark, f"{folder}/parsed", lambda: ex.parse_answers(answers), overwrite=True)
    valid = ex.valid_answers(parsed)
    sentiment = valid.select("review_id", "overall_sentiment", "extraction_method")
    reviews = sampled.join(sentiment, "review_id")
    aspects = ex.aspect_rows(valid)
    if "rating" in reviews.columns and "review_rating" not in reviews.columns:
        reviews = reviews.withColumnRenamed("rating", "review_rating")

    save_tables(spark, reviews, aspects, config.names, config.buckets)
    reviews, aspects = spark.table(config.names.reviews), spark.table(config.names.aspects)
    save_summary(product_aspect_summary(reviews, aspects), config.names)
    if config.csv_export:
        write_csv(reviews, f"{folder}/csv/reviews")
        write_csv(aspects, f"{folder}/csv/review_aspects")
    return {
        "cleaning_report": report,
        "rejected": ex.rejected_answers(parsed),
        "reviews": reviews,
        "review_aspects": aspects,
        "product_aspect_summary": spark.table(config.names.summary),
    }
