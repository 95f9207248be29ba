"""Running a user-supplied extractor over reviews and parsing what it returns.

The extractor is the only Python on the row path. It runs in ``mapInPandas``: one client per
partition, Arrow batches in and out. Its raw answers are landed first, since they are costly
and not repeatable; parsing and validation are column expressions over the landed table.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinarium.functions.once import computed_once
from opinarium.functions.text import id_key, label, snake_label
from opinarium.schemas import ASPECT_SENTIMENTS, OVERALL_SENTIMENTS, RAW_EXTRACTIONS

# Texts in an error message that mark a refused login or account, and a rate
# limit that passes.
AUTH_MARKS = ("401", "api_key", "permission", "unauthenticated", "billing", "forbidden")
RATE_MARKS = ("429", "resource_exhausted", "quota")

# An extractor takes the review id and text and returns a JSON text. A factory makes one
# extractor per partition, on the executor, and names the method it stands for.
Extractor = Callable[[str, str], str]
ExtractorFactory = Callable[[], Extractor]

FAIL, STOP, REJECT = "fail", "stop", "reject"


class ExtractionFailed(RuntimeError):
    """An extractor call failed and the policy says not to go on."""


@dataclass(frozen=True)
class CallPolicy:
    """How extractor calls are paced, repeated and given up.

    ``on_error`` says what follows a call that finally failed: ``fail`` raises in the task,
    ``stop`` records the error and makes no further call in this task, ``reject`` records it
    and goes on with the next review. Nothing ever replaces a missing answer.
    """

    # Attempts, wait and pace of a default run.
    attempts: int = 3
    wait: float = 15.0
    pace: float = 4.1
    on_error: str = FAIL
    auth_marks: tuple[str, ...] = AUTH_MARKS
    rate_marks: tuple[str, ...] = RATE_MARKS
    sleep: Callable[[float], None] = field(default=time.sleep)

    def may_repeat(self, error: Exception) -> bool:
        message = str(error).lower()
        if any(mark in message for mark in self.auth_marks):
            return False
        return any(mark in message for mark in self.rate_marks)

    def at_rate(self, calls_per_second: float, tasks: int) -> CallPolicy:
        """The same policy with a total rate shared by tasks that run side by side."""
        return replace(self, pace=tasks / calls_per_second)


def call_extractor(extractor: Extractor, policy: CallPolicy, review_id: str,
                   text: str) -> tuple[str | None, int, Exception | None]:
    """One review: its answer, the calls made, and the error if there is no answer."""
    if policy.pace > 0:
        policy.sleep(policy.pace)
    for attempt in range(1, policy.attempts + 1):
        try:
            return extractor(review_id, text), attempt, None
        except Exception as error:
            if attempt == policy.attempts or not policy.may_repeat(error):
                return None, attempt, error
        policy.sleep(policy.wait * attempt)
    raise ValueError("a policy needs at least one attempt")


def extract_reviews(reviews: DataFrame, factory: ExtractorFactory, method: str,
                    policy: CallPolicy = CallPolicy(), tasks: int | None = None) -> DataFrame:
    """Raw answer, method, number of calls and error for each review.

    ``tasks`` deals the rows evenly over that many tasks, which bounds the calls made side
    by side. Speculative execution is refused, as it would repeat calls.
    """
    if reviews.sparkSession.conf.get("spark.speculation", "false") == "true":
        raise ValueError("spark.speculation would repeat calls, turn it off")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        extractor = factory()
        stopped = False
        for batch in batches:
            rows = []
            for review_id, text in zip(batch["review_id"], batch["review_text"]):
                if stopped:
                    break
                raw, calls, error = call_extractor(extractor, policy, review_id, text)
                if error is not None and policy.on_error == FAIL:
                    raise ExtractionFailed(f"review {review_id}: {error}") from error
                rows.append((review_id, raw, method, calls, None if error is None else str(error)))
                stopped = error is not None and policy.on_error == STOP
            yield pd.DataFrame(rows, columns=RAW_EXTRACTIONS.names)

    wanted = reviews.select(id_key(F.col("review_id")).alias("review_id"),
                            F.col("review_text").cast("string").alias("review_text"))
    if tasks is not None:
        wanted = wanted.repartition(tasks)
    return wanted.mapInPandas(run, RAW_EXTRACTIONS)


# --- parsing --------------------------------------------------------------------------

# The fields of an answer, each still with its own JSON type.
ANSWER_FIELDS = ("struct<overall_sentiment variant, aspects array<struct<"
                 "aspect variant, aspect_sentiment variant, issue variant>>>")
ASPECT_LIST = "array<struct<aspect:string,aspect_sentiment:string,issue:string>>"


def _is_string(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def _wrong_item(item: Column) -> Column:
    """True for an aspect that lacks a field or has one of the wrong type."""
    # A missing issue has no type at all, a JSON null has the type VOID.
    issue = F.coalesce(F.schema_of_variant(item["issue"]), F.lit("VOID"))
    return ~(_is_string(item["aspect"]) & _is_string(item["aspect_sentiment"])
             & issue.isin("STRING", "VOID"))


def parse_answers(answers: DataFrame, check_vocabulary: bool = True) -> DataFrame:
    """Adds ``overall_sentiment``, the list ``aspects`` and ``error``, null for a valid row.

    Fields must have their JSON types: a number is not taken for a text, a required field
    must be there, ``aspects`` may be missing but not null, ``issue`` may be either. Labels
    are normalised before the vocabulary check.
    """
    # The JSON parser stops after the first value. Only a text that is one value and nothing
    # else parses both as the sole element of a list and as the sole field of an object.
    raw, doc, fields = F.col("raw"), F.col("_doc"), F.col("_fields")
    alone = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]"))).isNotNull()
    field_of = F.try_parse_json(F.concat(F.lit('{"v":'), raw, F.lit("}")))
    parsed = answers.withColumn(
        "_doc", F.when(alone, F.try_variant_get(field_of, "$.v", "variant")))
    parsed = parsed.withColumn("_fields", F.try_variant_get(doc, "$", ANSWER_FIELDS))

    items, given = fields["aspects"], F.try_variant_get(doc, "$.aspects", "variant")
    overall = label(fields["overall_sentiment"].cast("string"))
    aspects = F.transform(items, lambda a: F.struct(
        snake_label(a["aspect"].cast("string")).alias("aspect"),
        label(a["aspect_sentiment"].cast("string")).alias("aspect_sentiment"),
        a["issue"].cast("string").alias("issue")))
    aspects = F.coalesce(aspects, F.array().cast(ASPECT_LIST))

    complete = (fields.isNotNull() & _is_string(fields["overall_sentiment"])
                & F.when(items.isNull(), given.isNull())
                .otherwise(~F.exists(items, _wrong_item)))
    kind = F.schema_of_variant(doc)
    stated = F.try_variant_get(doc, "$.overall_sentiment", "variant")
    error = F.when(complete, None)
    if check_vocabulary:
        error = F.when(complete, F.when(
            ~overall.isin(*OVERALL_SENTIMENTS), "overall_sentiment_unknown"
        ).when(F.exists(aspects, lambda a: ~a["aspect_sentiment"].isin(*ASPECT_SENTIMENTS)),
               "aspect_sentiment_unknown"))
    error = (
        error.when(raw.isNull(), "no_answer")
        .when(doc.isNull(), "invalid_json")
        .when(~F.coalesce(kind.startswith("OBJECT"), F.lit(False)), "not_an_object")
        .when(~_is_string(stated), "overall_sentiment_missing")
        .when(~F.schema_of_variant(given).startswith("ARRAY"), "aspects_not_a_list")
        .otherwise("aspect_incomplete")
    )
    results = {"overall_sentiment": overall, "aspects": aspects, "error": error}
    parsed = computed_once(parsed, results)
    return parsed.select(*[c for c in answers.columns if c not in results], *results)


def valid_answers(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull())


def rejected_answers(parsed: DataFrame) -> DataFrame:
    """Answers that failed the schema or the vocabulary, with the reason.

    A call without an answer is a reject too; its ``call_error`` is kept where there is one.
    """
    extra = [c for c in ("call_error",) if c in parsed.columns]
    return parsed.filter(F.col("error").isNotNull()).select("review_id", "raw", "error", *extra)


def aspect_rows(valid: DataFrame, keep_empty: bool = False,
                extra: Sequence[str] = ()) -> DataFrame:
    """One row per aspect with its place in the answer; ``(review_id, pos)`` is a key.

    ``keep_empty`` adds a row without aspect for a review that names none.
    """
    explode = F.posexplode_outer if keep_empty else F.posexplode
    rows = valid.select("review_id", *extra, explode("aspects").alias("pos", "_a"))
    return rows.select("review_id", *extra, F.col("pos").cast("bigint").alias("pos"), "_a.*")
