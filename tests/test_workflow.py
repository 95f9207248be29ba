from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from opinarium import schemas
from opinarium.operators import extraction as ex
from opinarium.plans import workflow as w
from opinarium.sources import files, tables

HEADER = "review_id,product_id,brand_name,product_title,review_text,review_rating,review_date,mrp,price,author"


def write_raw(path, rows):
    with open(path, "w", encoding="utf-8") as out:
        out.write(HEADER + "\n" + "\n".join(rows) + "\n")


def test_csv_keeps_line_breaks_and_reads_missing_tokens(spark, tmp_path):
    path = str(tmp_path / "raw.csv")
    write_raw(path, ['1,P1," B ",T,"two\nlines, ""quoted""",5.0,2021-01-01,10,9,NA',
                     '2,P1,B,T,NA,4,,n/a,,""', "3,null,B,T,ok,None,2021-01-02,1,1,x"])
    rows = files.read_reviews_csv(spark, path).orderBy("review_id").collect()
    assert len(rows) == 3
    assert rows[0]["review_text"] == 'two\nlines, "quoted"'
    assert rows[0]["author"] is None and rows[0]["brand_name"] == " B "
    assert rows[1]["review_text"] is None and rows[1]["mrp"] is None and rows[1]["author"] is None
    assert rows[2]["product_id"] is None and rows[2]["review_rating"] is None


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "b"\nc, d\\'), ("2", None)], "review_id string, review_text string")
    path = str(tmp_path / "out")
    files.write_csv(df, path)
    back = files.read_reviews_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_missing_input_fails(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_reviews_csv(spark, str(tmp_path / "none.csv"))


def test_absent_table_is_empty_but_a_broken_one_is_an_error(spark, tmp_path):
    assert files.read_or_empty(spark, str(tmp_path / "none"), schemas.REVIEWS).count() == 0
    (tmp_path / "broken.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        files.read_or_empty(spark, str(tmp_path / "broken.parquet"), schemas.REVIEWS).count()


def test_stage_is_skipped_once_finished(spark, tmp_path):
    path, built = str(tmp_path / "stage"), []

    def build():
        built.append(1)
        return spark.range(len(built))

    assert files.stage(spark, path, build).count() == 1
    assert files.stage(spark, path, build).count() == 1
    assert files.stage(spark, path, build, overwrite=True).count() == 2
    assert len(built) == 2


def test_conform_orders_casts_and_fills(spark):
    out = files.conform(spark.createDataFrame([(5, "x", "a")], "mrp int, extra string, review_id string"),
                        schemas.REVIEWS)
    assert out.columns == schemas.REVIEWS.names
    row = out.first()
    assert (row["mrp"], row["review_id"], row["price"]) == (5.0, "a", None)


def pair(spark, review_ids, aspect_ids, sentiment="positive"):
    reviews = spark.createDataFrame([(x, sentiment, "fixture") for x in review_ids],
                                    "review_id string, overall_sentiment string, extraction_method string")
    aspects = spark.createDataFrame([(x, "finish", "neutral") for x in aspect_ids],
                                    "review_id string, aspect string, aspect_sentiment string")
    return reviews, aspects


def names(prefix):
    return tables.TableNames(f"{prefix}_reviews", f"{prefix}_aspects", f"{prefix}_summary")


def test_save_tables(spark):
    named = names("plain")
    reviews, aspects = pair(spark, ["a", "b", "a"], ["a", "a", "b"])
    tables.save_tables(spark, reviews, aspects, named)
    saved, children = spark.table(named.reviews), spark.table(named.aspects)
    assert saved.columns == schemas.REVIEWS.names and children.columns == schemas.REVIEW_ASPECTS.names
    assert saved.count() == 2
    assert children.select("aspect_id").distinct().count() == 3


def test_save_tables_keeps_the_first_row_by_order(spark):
    named = names("ordered")
    reviews, aspects = pair(spark, ["a"], ["a"])
    later = reviews.withColumn("overall_sentiment", F.lit("negative")).withColumn("n", F.lit(2))
    both = later.unionByName(reviews.withColumn("n", F.lit(1)))
    tables.save_tables(spark, both, aspects, named, order=["n"])
    assert [r["overall_sentiment"] for r in spark.table(named.reviews).collect()] == ["positive"]


@pytest.mark.parametrize("reviews, aspects, sentiment, message", [
    (["a"], ["a", "x"], "positive", "without a review"),
    (["a"], ["a"], None, "overall_sentiment"),
    ([None], [], "positive", "review_id"),
])
def test_broken_tables_are_not_published(spark, reviews, aspects, sentiment, message):
    with pytest.raises(tables.IntegrityError, match=message):
        tables.save_tables(spark, *pair(spark, reviews, aspects, sentiment), names("broken"))
    assert not spark.catalog.tableExists("broken_reviews")


def test_bucketed_tables_join_without_a_shuffle(spark):
    named = names("bucketed")
    tables.save_tables(spark, *pair(spark, [str(i) for i in range(50)], [str(i) for i in range(50)]),
                       named, buckets=4)
    joined = spark.table(named.reviews).hint("merge").join(spark.table(named.aspects), "review_id")
    assert joined.count() == 50
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def answering(review_id, text):
    if text.startswith("vague"):
        return json.dumps({"overall_sentiment": "neutral", "aspects": []})
    if text.startswith("odd"):
        return json.dumps({"overall_sentiment": "great"})
    return json.dumps({"overall_sentiment": "mixed", "aspects": [
        {"aspect": "Shade Match", "aspect_sentiment": "positive"},
        {"aspect": "longevity", "aspect_sentiment": "negative", "issue": "fades"}]})


def test_workflow_from_csv_to_tables(spark, tmp_path):
    raw, named = str(tmp_path / "raw.csv"), names("flow")
    rows = [f"{i},P{i % 3},B{i % 2},T{i % 3},<b>review {i}</b>,{i % 5 + 1},2021-01-0{i % 9 + 1},10,8,x"
            for i in range(40)]
    rows += ["90,P1,B1,T1,vague,3,,1,1,x", "91,P1,B1,T1,odd one,3,,1,1,x", "92,P1,B1,T1,  ,3,,1,1,x",
             "93,P1,B1,T1,fine,9,,1,1,x"]
    write_raw(raw, rows)
    config = w.WorkflowConfig(raw, str(tmp_path / "work"), sample_size=100, checkpoint_rows=15, tasks=2,
                              names=named, csv_export=True)
    policy = ex.CallPolicy(pace=0, on_error=ex.STOP)
    out = w.run_workflow(spark, config, lambda: answering, "fixture", policy)
    report = {r["metric"]: r["value"] for r in out["cleaning_report"].collect() if r["column_name"] is None}
    assert (report["rows_before"], report["rows_after"]) == (44, 42)
    assert out["reviews"].count() == 41 and out["review_aspects"].count() == 80
    assert [r["review_id"] for r in out["rejected"].collect()] == ["91"]
    assert out["reviews"].filter("extraction_method <> 'fixture'").count() == 0
    assert out["product_aspect_summary"].agg(F.sum("total_mentions")).first()[0] == 80
    assert "author" not in out["reviews"].columns
    assert files.read_reviews_csv(spark, str(tmp_path / "work" / "csv" / "review_aspects")).count() == 80

    def refuse():
        raise AssertionError("no call expected")

    again = w.run_workflow(spark, config, refuse, "fixture", policy)
    assert again["reviews"].count() == 41


def test_stopped_run_resumes_where_it_broke_off(spark, tmp_path):
    path, flag = str(tmp_path / "answers"), tmp_path / "broken"
    flag.touch()
    log = str(tmp_path / "calls")
    fuse = str(flag)

    def factory():
        import os

        def extract(review_id, text):
            if int(review_id) % 10 == 7 and os.path.exists(fuse):
                raise RuntimeError("401 forbidden")
            with open(log, "a") as out:
                out.write(review_id + "\n")
            return json.dumps({"overall_sentiment": "positive"})

        return extract

    reviews = spark.range(100).select(F.col("id").cast("string").alias("review_id"),
                                      F.lit("t").alias("review_text"))
    lost = spark.createDataFrame([(None, "no id")], "review_id string, review_text string")
    reviews = reviews.unionByName(lost)
    policy = ex.CallPolicy(pace=0, on_error=ex.STOP)
    with pytest.raises(ex.ExtractionFailed, match="401"):
        w.run_extraction(reviews, path, factory, "fixture", policy, checkpoint_rows=30, tasks=2)
    before = w.stored_answers(spark, path).count()
    assert before < 100
    flag.unlink()
    counts = w.run_extraction(reviews, path, factory, "fixture", policy, checkpoint_rows=30, tasks=2)
    assert counts == {"requested": 100, "already_done": before, "remaining": 100 - before}
    done = w.stored_answers(spark, path)
    assert done.count() == done.select("review_id").distinct().count() == 100
    calls = open(log).read().split()
    assert len(calls) == len(set(calls)) == 100
    assert w.run_extraction(reviews, path, factory, "fixture", policy)["remaining"] == 0


def test_half_a_stage_is_built_anew(spark, tmp_path):
    path = str(tmp_path / "half")
    spark.range(100).repartition(4).write.parquet(path)
    (tmp_path / "half" / "_SUCCESS").unlink()
    assert not files.is_finished(spark, path)
    assert files.stage(spark, path, lambda: spark.range(7)).count() == 7


def test_files_with_different_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("review_id,review_text,review_rating\n1,long enough to come first,5\n")
    (tmp_path / "b.csv").write_text("review_rating,review_id,review_text\n9,5,swapped\n")
    with pytest.raises(Exception):
        files.read_reviews_csv(spark, str(tmp_path)).collect()


def test_a_text_that_is_no_number_is_published_as_null(spark):
    row = files.conform(spark.createDataFrame([("a", "1,234")], "review_id string, product_rating_count string"),
                        schemas.REVIEWS).first()
    assert row["product_rating_count"] is None


def test_aspect_ids_do_not_change(spark):
    rows = spark.createDataFrame([("a", "finish"), ("a", "finish"), ("b", "finish")], "review_id string, aspect string")
    first = sorted(r.aspect_id for r in tables.with_aspect_id(rows).collect())
    again = sorted(r.aspect_id for r in tables.with_aspect_id(rows.repartition(3)).collect())
    assert first == again and len(set(first)) == 3


def test_first_of_repeated_ids_is_published_and_failed_calls_are_rejects(spark, tmp_path):
    raw, named = str(tmp_path / "raw.csv"), names("repeated")
    texts = ["fails", *["vague" if i % 2 else "clear" for i in range(1, 20)]]
    rows = [f"{i},P1,B,T,{text} first,3,,1,1,x" for i, text in enumerate(texts)]
    rows += [f" {i} ,P1,B,T,{'clear' if i % 2 else 'vague'} second,3,,1,1,x" for i in range(20)]
    write_raw(raw, [*rows, ",P1,B,T,no id,3,,1,1,x"])

    def factory():
        def extract(review_id, text):
            if text.startswith("fails"):
                raise RuntimeError("no service")
            return answering(review_id, text)
        return extract

    config = w.WorkflowConfig(raw, str(tmp_path / "work"), sample_size=100, names=named)
    policy = ex.CallPolicy(pace=0, attempts=1, on_error=ex.REJECT)
    out = w.run_workflow(spark, config, factory, "fixture", policy)
    published = {r["review_id"]: r for r in out["reviews"].collect()}
    assert set(published) == {str(i) for i in range(1, 20)}
    for i in range(1, 20):
        row = published[str(i)]
        assert row["review_text"] == f"{texts[i]} first"
        assert row["overall_sentiment"] == ("neutral" if i % 2 else "mixed")
    (rejected,) = out["rejected"].collect()
    assert (rejected["review_id"], rejected["error"], rejected["call_error"]) == ("0", "no_answer", "no service")


def test_calls_of_a_round_come_from_all_tasks(spark, tmp_path):
    log = str(tmp_path / "tasks")

    def factory():
        from pyspark import TaskContext

        def extract(review_id, text):
            with open(log, "a") as out:
                out.write(f"{TaskContext.get().partitionId()}\n")
            return "{}"
        return extract

    reviews = spark.range(200).selectExpr("cast(id as string) as review_id", "'t' as review_text")
    policy = ex.CallPolicy(pace=0, on_error=ex.REJECT)
    w.run_extraction(reviews, str(tmp_path / "out"), factory, "fixture", policy, tasks=4)
    assert set(open(log).read().split()) == {"0", "1", "2", "3"}
    with pytest.raises(ValueError, match="rejects"):
        w.run_extraction(reviews, str(tmp_path / "out"), factory, "fixture", ex.CallPolicy(pace=0))


@pytest.mark.parametrize("seconds, checkpoint, rounds", [(60.0, None, 4), (0.0, None, 10), (60.0, 10, 10)])
def test_quick_rounds_are_taken_together(spark, tmp_path, monkeypatch, seconds, checkpoint, rounds):
    monkeypatch.setattr(w, "ROUND_ROWS_PER_TASK", 5)
    monkeypatch.setattr(w, "ROUND_SECONDS", seconds)
    begun, extract = [], ex.extract_reviews
    monkeypatch.setattr(w.ex, "extract_reviews", lambda *given: begun.append(1) or extract(*given))
    path = str(tmp_path / "answers")
    reviews = spark.range(100).select(F.col("id").cast("string").alias("review_id"), F.lit("t").alias("review_text"))
    w.run_extraction(reviews, path, lambda: answering, "fixture", ex.CallPolicy(pace=0, on_error=ex.STOP), checkpoint, 2)
    assert len(begun) == rounds
    done = w.stored_answers(spark, path)
    assert done.count() == done.select("review_id").distinct().count() == 100
