from __future__ import annotations

from pyspark.sql import functions as F

from opinarium import registry
from opinarium.streaming.incremental import add_new_reviews, drop_recent_repeats

SCHEMA = "review_id string, review_text string"


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def test_two_runs_add_each_review_once(spark, tmp_path):
    source, target, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    arrive(spark, source, [(str(i), "first") for i in range(20)])
    arrive(spark, source, [(f" {i} ", "again") for i in range(15, 25)])
    out = add_new_reviews(stream(spark, source), target, progress)
    assert out.count() == 25
    arrive(spark, source, [(str(i), "late") for i in range(20, 35)])
    out = add_new_reviews(stream(spark, source), target, progress)
    rows = out.groupBy("review_id").count().collect()
    assert len(rows) == 35 and all(r["count"] == 1 for r in rows)
    assert out.filter("review_text = 'late'").count() == 10


def test_processed_ids_and_transform(spark, tmp_path):
    source, target, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    arrive(spark, source, [("1", "a"), ("2", "b"), ("2", "b"), ("3", " ")])
    done = spark.createDataFrame([("1",)], "review_id string")
    out = add_new_reviews(stream(spark, source), target, progress,
                          lambda df: df.filter("trim(review_text) <> ''"), done)
    assert [r["review_id"] for r in out.collect()] == ["2"]


def test_nothing_arrived_yet(spark, tmp_path):
    (tmp_path / "in").mkdir()
    out = add_new_reviews(stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "p"))
    assert out.count() == 0
    assert out.columns == ["review_id", "review_text", "run", "batch_id"]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    """Losing the progress log replays everything; the table stays the same."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    arrive(spark, source, [(str(i), "x") for i in range(10)])
    first = add_new_reviews(stream(spark, source), target, str(tmp_path / "p1"))
    assert first.count() == 10
    again = add_new_reviews(stream(spark, source), target, str(tmp_path / "p2"))
    assert again.count() == 10


def test_repeats_within_the_delay_are_dropped(spark, tmp_path):
    source = str(tmp_path / "in")
    arrive(spark, source, [("1", "a"), ("1", "b"), ("2", "c")])
    timed = stream(spark, source).withColumn("arrived", F.current_timestamp())
    query = (drop_recent_repeats(timed, "arrived", "1 hour").writeStream.format("memory")
             .queryName("recent").trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / "p")).start())
    query.awaitTermination()
    assert spark.table("recent").count() == 2


def test_another_run_adds_and_replaces_nothing(spark, tmp_path):
    target = str(tmp_path / "out")
    for name, ids in (("a", "123"), ("b", "378")):
        arrive(spark, str(tmp_path / name), [(i, name) for i in ids])
        out = add_new_reviews(stream(spark, str(tmp_path / name)), target, str(tmp_path / f"progress-{name}"))
    assert sorted((r["review_id"], r["review_text"]) for r in out.collect()) == [
        ("1", "a"), ("2", "a"), ("3", "a"), ("7", "b"), ("8", "b")]


def test_documents_stream_from_a_file_or_a_folder_of_files(spark, tmp_path):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    documents.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    one, many = (registry.incremental_stream(spark, sf).drop("run", "batch_id").collect()
                 for sf in ("/root/testdata/sf0.001", str(tmp_path)))
    assert len(many) > 0 and sorted(many) == sorted(one)
