from __future__ import annotations

import json
import os

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from opinarium.operators import extraction as e

GOOD = '{"overall_sentiment":"positive","aspects":[]}'


def parsed(spark, *answers, **options):
    df = spark.createDataFrame([(str(i), x) for i, x in enumerate(answers)], "review_id string, raw string")
    rows = e.parse_answers(df, **options).collect()
    return {int(r["review_id"]): r for r in rows}


@pytest.mark.parametrize("raw, error", [
    (None, "no_answer"),
    ("", "invalid_json"),
    ("not json", "invalid_json"),
    ('{"overall_sentiment":"positive"} trailing', "invalid_json"),
    (GOOD + GOOD, "invalid_json"),
    (GOOD + "," + GOOD, "invalid_json"),
    (GOOD + "] {}", "invalid_json"),
    (GOOD + "} {", "invalid_json"),
    (GOOD + ',"x":1', "invalid_json"),
    ("[]", "not_an_object"),
    ('"positive"', "not_an_object"),
    ("null", "not_an_object"),
    ("{}", "overall_sentiment_missing"),
    ('{"overall_sentiment":null}', "overall_sentiment_missing"),
    ('{"overall_sentiment":5}', "overall_sentiment_missing"),
    ('{"overall_sentiment":"great"}', "overall_sentiment_unknown"),
    ('{"overall_sentiment":"positive","aspects":null}', "aspects_not_a_list"),
    ('{"overall_sentiment":"positive","aspects":{}}', "aspects_not_a_list"),
    ('{"overall_sentiment":"positive","aspects":["finish"]}', "aspect_incomplete"),
    ('{"overall_sentiment":"positive","aspects":[null]}', "aspect_incomplete"),
    ('{"overall_sentiment":"positive","aspects":[{"aspect":"finish"}]}', "aspect_incomplete"),
    ('{"overall_sentiment":"positive","aspects":[{"aspect":1,"aspect_sentiment":"neutral"}]}',
     "aspect_incomplete"),
    ('{"overall_sentiment":"positive","aspects":[{"aspect":"a","aspect_sentiment":"neutral","issue":3}]}',
     "aspect_incomplete"),
    ('{"overall_sentiment":"positive","aspects":[{"aspect":"a","aspect_sentiment":"mixed"}]}',
     "aspect_sentiment_unknown"),
    (GOOD, None),
    (" \n" + GOOD + "\t ", None),
    ('{"overall_sentiment":" Positive "}', None),
    ('{"overall_sentiment":"mixed","aspects":[{"aspect":"a","aspect_sentiment":"neutral","issue":null,"more":1}],"x":{}}',
     None),
])
def test_validation(spark, raw, error):
    assert parsed(spark, raw)[0]["error"] == error


def test_vocabulary_check_can_be_left_out(spark):
    row = parsed(spark, '{"overall_sentiment":"Great"}', check_vocabulary=False)[0]
    assert (row["error"], row["overall_sentiment"]) == (None, "great")


def test_labels_are_normalised_and_issues_kept(spark):
    raw = json.dumps({"overall_sentiment": "MIXED", "aspects": [
        {"aspect": " Shade Match", "aspect_sentiment": "Positive", "issue": None},
        {"aspect": "longevity", "aspect_sentiment": " negative ", "issue": " Fades  "}]})
    row = parsed(spark, raw)[0]
    assert row["overall_sentiment"] == "mixed"
    assert [tuple(a) for a in row["aspects"]] == [
        ("shade_match", "positive", None), ("longevity", "negative", " Fades  ")]


def test_aspect_rows(spark):
    two = ('{"overall_sentiment":"mixed","aspects":[{"aspect":"a","aspect_sentiment":"neutral"},'
           '{"aspect":"a","aspect_sentiment":"neutral"}]}')
    df = spark.createDataFrame([("1", two), ("2", GOOD), ("3", "bad")], "review_id string, raw string")
    valid = e.valid_answers(e.parse_answers(df))
    assert [tuple(r) for r in e.aspect_rows(valid).orderBy("pos").collect()] == [
        ("1", 0, "a", "neutral", None), ("1", 1, "a", "neutral", None)]
    assert e.aspect_rows(valid, keep_empty=True).count() == 3
    rejected = e.rejected_answers(e.parse_answers(df)).collect()
    assert [tuple(r) for r in rejected] == [("3", "bad", "invalid_json")]


class Script:
    """An extractor that follows a script of errors, and the sleeps it was given."""

    def __init__(self, *errors):
        self.errors, self.calls, self.slept = list(errors), 0, []

    def __call__(self, review_id, text):
        self.calls += 1
        if self.errors:
            error = self.errors.pop(0)
            if error:
                raise RuntimeError(error)
        return GOOD

    def policy(self, **options):
        return e.CallPolicy(sleep=self.slept.append, **options)


@pytest.mark.parametrize("errors, calls, waits, fails", [
    ([], 1, [], False),
    (["429 slow down"], 2, [15.0], False),
    (["RESOURCE_EXHAUSTED", "Quota reached"], 3, [15.0, 30.0], False),
    (["429"] * 3, 3, [15.0, 30.0], True),
    (["401 denied"], 1, [], True),
    (["429 billing account"], 1, [], True),
    (["429", "socket closed"], 2, [15.0], True),
    (["socket closed"], 1, [], True),
])
def test_retries(errors, calls, waits, fails):
    script = Script(*errors)
    raw, made, error = e.call_extractor(script, script.policy(), "r", "t")
    assert (script.calls, made) == (calls, calls)
    assert script.slept == [4.1, *waits]
    assert (raw is None) == fails == (error is not None)


def test_rate_is_shared_by_tasks():
    assert e.CallPolicy().at_rate(2.0, 10).pace == 5.0


def flaky_factory():
    def extract(review_id, text):
        if text == "bad":
            raise RuntimeError("401 no permission")
        return GOOD
    return extract


def texts(spark, *bodies):
    rows = [(f" {i} ", b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "review_id string, review_text string").coalesce(1)


def test_extract_reviews_keeps_provenance(spark):
    out = e.extract_reviews(texts(spark, "x", "y"), flaky_factory, "fixture", e.CallPolicy(pace=0))
    rows = out.orderBy("review_id").collect()
    assert [tuple(r) for r in rows] == [("0", GOOD, "fixture", 1, None), ("1", GOOD, "fixture", 1, None)]


def test_fail_stops_the_job(spark):
    out = e.extract_reviews(texts(spark, "x", "bad"), flaky_factory, "fixture", e.CallPolicy(pace=0))
    with pytest.raises(PythonException, match="ExtractionFailed"):
        out.collect()


def test_reject_goes_on_without_a_default(spark):
    policy = e.CallPolicy(pace=0, on_error=e.REJECT)
    out = e.extract_reviews(texts(spark, "x", "bad", "y"), flaky_factory, "fixture", policy)
    rows = {r["review_id"]: r for r in out.collect()}
    assert rows["1"]["raw"] is None and "401" in rows["1"]["error"]
    assert rows["2"]["raw"] == GOOD


def test_stop_makes_no_further_call_in_the_task(spark):
    policy = e.CallPolicy(pace=0, on_error=e.STOP)
    out = e.extract_reviews(texts(spark, "x", "bad", "y"), flaky_factory, "fixture", policy)
    assert sorted(r["review_id"] for r in out.collect()) == ["0", "1"]


def test_one_extractor_per_partition(spark, tmp_path):
    folder = str(tmp_path)

    def factory():
        open(os.path.join(folder, f"made-{os.getpid()}-{len(os.listdir(folder))}"), "w").close()
        return lambda review_id, text: GOOD

    df = spark.range(100).select(F.col("id").cast("string").alias("review_id"), F.lit("t").alias("review_text"))
    out = e.extract_reviews(df, factory, "fixture", e.CallPolicy(pace=0), tasks=4)
    assert out.count() == 100
    assert 1 <= len(os.listdir(folder)) <= 4
