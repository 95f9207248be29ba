"""The index of seen ids, alone and under a stream."""

from __future__ import annotations

import numpy as np

from opinarium import registry
from opinarium.streaming.id_index import IdIndex, filter_bits, may_hold
from opinarium.streaming.incremental import add_new_reviews


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id string")


def seen(index, frame, run="r", batch=99):
    return sorted(r["id"] for r in index.seen(frame, "id", run, batch).collect())


def test_filter_holds_its_keys_and_few_others():
    rng = np.random.default_rng(1)
    for n in (0, 1, 50, 20_000):
        keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        bits = filter_bits(keys)
        assert may_hold(bits, keys).all()
        assert may_hold(bits, rng.integers(0, 1 << 63, 5000, dtype=np.uint64)).mean() < 0.02


def test_seen_ids_over_batches(spark, tmp_path):
    index = IdIndex(str(tmp_path / "index"), 8)
    assert seen(index, ids(spark, ["a", None])) == []
    index.add(ids(spark, ["a", "a", "b", None]), "id", "r", 0)
    index.add(ids(spark, [f"n{i}" for i in range(500)]), "id", "r", 1)
    index.add(ids(spark, []), "id", "r", 2)
    asked = ids(spark, ["a", "c", "n7", "n499", None, "n500"])
    assert seen(index, asked) == ["a", "n499", "n7"]
    assert seen(index, asked, batch=1) == ["a"]
    assert seen(index, asked, run="other", batch=1) == ["a", "n499", "n7"]


def test_a_repeated_batch_replaces_its_ids(spark, tmp_path):
    index = IdIndex(str(tmp_path / "index"), 4)
    index.add(ids(spark, ["a", "b"]), "id", "r", 0)
    index.add(ids(spark, ["b", "c"]), "id", "r", 0)
    assert seen(index, ids(spark, ["a", "b", "c"])) == ["b", "c"]


def test_a_batch_reads_only_files_that_a_filter_lets_through(spark, tmp_path):
    """Files of ids outside of the hits are spoiled; reading one would fail."""
    index = IdIndex(str(tmp_path / "index"), 8)
    for batch in range(6):
        index.add(ids(spark, [f"{batch}-{i}" for i in range(40)]), "id", "r", batch)
    asked = ids(spark, ["3-17", "never", "nothing"])
    hit = {(r["bucket"], r["batch_id"]) for r in index.hits(asked, "id", "r", 99).collect()}
    assert len(hit) < 4 and any(b == 3 for _, b in hit)
    spoiled = 0
    for path in (tmp_path / "index" / "ids").rglob("*.parquet"):
        bucket, batch = (int(path.parents[k].name.split("=")[1]) for k in (0, 1))
        if (bucket, batch) not in hit:
            path.write_bytes(b"spoiled")
            path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
            spoiled += 1
    assert spoiled > 30 and seen(index, asked) == ["3-17"]


SCHEMA = "review_id string, review_text string"


def test_stream_with_index_adds_each_review_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    index = IdIndex(str(tmp_path / "index"), 4)

    def arrive(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def run(progress):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        done = spark.createDataFrame([("24",)], "review_id string")
        return add_new_reviews(stream, target, str(tmp_path / progress), processed=done, index=index)

    arrive([(str(i), "first") for i in range(20)])
    arrive([(f" {i} ", "again") for i in range(15, 25)])
    arrive([(str(i), "third") for i in (1, 16, 24, 30)] + [(None, "none")])
    out = run("p1")
    assert sorted(r["review_id"] or "" for r in out.collect()) == sorted([*map(str, range(24)), "30", ""])
    arrive([(str(i), "late") for i in range(22, 33)])
    assert run("p1").filter("review_text = 'late'").count() == 7
    # A run without its progress repeats every batch; only the review without an id comes again.
    assert run("p2").filter("review_id is not null").count() == len({*range(33)} - {24})


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """The last commit of the run is lost, so its batch runs again."""
    source, target, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    index = IdIndex(str(tmp_path / "index"), 4)
    for part in range(3):
        spark.createDataFrame([(str(i), "x") for i in range(part * 5, part * 5 + 8)], SCHEMA).coalesce(1) \
            .write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        return sorted(tuple(r)[:2] for r in add_new_reviews(stream, target, progress, index=index).collect())

    before = run()
    commits = tmp_path / "progress" / "commits"
    assert sorted(p.name for p in commits.iterdir() if p.name.isdigit()) == ["0", "1", "2"]
    (commits / "2").unlink()
    (commits / ".2.crc").unlink(missing_ok=True)
    assert run() == before and len(before) == 18


def test_an_arrival_is_one_batch_of_any_number_of_files(spark, tmp_path, monkeypatch):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    documents.repartition(4).write.parquet(str(tmp_path / "in" / "documents.parquet"))
    monkeypatch.setattr(registry, "working_folder", lambda spark, purpose: str(tmp_path / purpose))
    many = registry.indexed_stream(spark, str(tmp_path / "in")).collect()
    assert len(list((tmp_path / "indexed" / "reviews").glob("run=*/batch_id=*"))) == 4
    monkeypatch.undo()
    assert len(many) > 0 and sorted(many) == sorted(registry.indexed_stream(spark, "/root/testdata/sf0.001").collect())
