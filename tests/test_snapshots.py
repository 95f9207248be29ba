"""Tables published as one version, and the store of reviews on top of them."""

from __future__ import annotations

from pathlib import Path

import pytest

from opinarium.operators import summary
from opinarium.plans.analysis import product_aspect_summary
from opinarium.sources import review_store as store
from opinarium.sources.snapshots import ConcurrentPublication, NoSnapshot, expire, publish, snapshot, versions
from opinarium.sources.tables import IntegrityError


def numbers(spark, n):
    return spark.range(n).coalesce(1)


def reviews(spark, ids, brand="b"):
    return spark.createDataFrame([(str(i), f"p{i % 2}", brand, "t", "x", "positive", "fixture") for i in ids],
                                 "review_id string, product_id string, brand_name string, product_title string, "
                                 "review_text string, overall_sentiment string, extraction_method string")


def aspects(spark, ids, sentiment="negative"):
    return spark.createDataFrame([(str(i), pos, "finish", sentiment) for i in ids for pos in range(2)],
                                 "review_id string, pos long, aspect string, aspect_sentiment string")


def content(spark, root):
    now = snapshot(spark, root)
    return tuple(sorted(r["review_id"] for r in now.table(spark, t).collect()) for t in ("reviews", "review_aspects"))


def test_readers_see_whole_versions(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(NoSnapshot):
        snapshot(spark, root)
    publish(spark, root, {"a": numbers(spark, 3), "b": numbers(spark, 0)})
    old = snapshot(spark, root)
    publish(spark, root, {"a": numbers(spark, 5), "b": numbers(spark, 1)})
    assert [old.table(spark, t).count() for t in "ab"] == [3, 0] == [old.rows(t) for t in "ab"]
    now = snapshot(spark, root)
    assert [now.table(spark, t).count() for t in "ab"] == [5, 1]
    assert snapshot(spark, root, 1).version == 1 and now.version == 2


def test_a_failure_between_the_writes_leaves_the_old_pair(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, {"a": numbers(spark, 3), "b": numbers(spark, 3)})
    broken = spark.range(3).selectExpr("raise_error('lost')")
    with pytest.raises(Exception, match="lost"):
        publish(spark, root, {"a": numbers(spark, 9), "b": broken})

    def refuse(tables):
        raise IntegrityError("no")

    with pytest.raises(IntegrityError):
        publish(spark, root, {"a": numbers(spark, 9), "b": numbers(spark, 9)}, check=refuse)
    assert versions(spark, root) == [1]
    assert [snapshot(spark, root).table(spark, t).count() for t in "ab"] == [3, 3]


def test_only_one_writer_takes_a_number(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, {"a": numbers(spark, 3)})
    publish(spark, root, {"a": numbers(spark, 4)}, based_on=1)
    with pytest.raises(ConcurrentPublication):
        publish(spark, root, {"a": numbers(spark, 5)}, based_on=1)
    assert snapshot(spark, root).rows("a") == 4


def test_old_versions_and_lost_parts_expire(spark, tmp_path):
    root = str(tmp_path)
    first = publish(spark, root, {"a": numbers(spark, 1)}, keep=9)
    for _ in range(3):
        publish(spark, root, {"a": numbers(spark, 1)}, carried=first.parts, keep=9)
    (tmp_path / "data" / "0000000002-lost").mkdir()
    (tmp_path / "data" / "0000000009-in-the-making").mkdir()
    assert expire(spark, root, 2) == [1, 2]
    left = sorted(p.name for p in (tmp_path / "data").iterdir())
    assert len(left) == 4 and left[0] in first.parts["a"] and left[-1] == "0000000009-in-the-making"
    assert snapshot(spark, root).table(spark, "a").count() == 2


def test_loads_and_deletes_keep_pair_and_summary(spark, tmp_path):
    root = str(tmp_path)
    store.load(spark, root, reviews(spark, range(6)), aspects(spark, range(4)))
    store.load(spark, root, reviews(spark, range(4, 10), "c"), aspects(spark, range(4, 10), "positive"))
    assert content(spark, root) == ([str(i) for i in range(10)], sorted(str(i) for i in [*range(4), *range(6, 10)] * 2))
    ids = spark.createDataFrame([(" 1 ",), ("7",), ("99",)], "review_id string")
    store.delete(spark, root, ids)
    now = snapshot(spark, root)
    assert sorted(set(content(spark, root)[0])) == ["0", "2", "3", "4", "5", "6", "8", "9"]
    whole = product_aspect_summary(*(now.table(spark, t) for t in ("reviews", "review_aspects")))
    kept = summary.summary_of(now.table(spark, "mention_counts")).select(*whole.columns)
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def test_only_parts_with_deleted_ids_are_written_again(spark, tmp_path):
    root = str(tmp_path)
    first = store.load(spark, root, reviews(spark, range(4)), aspects(spark, range(4)))
    second = store.load(spark, root, reviews(spark, range(4, 8)), aspects(spark, range(4, 8)))
    assert set(first.parts["reviews"]) < set(second.parts["reviews"])
    after = store.delete(spark, root, spark.createDataFrame([("5",)], "review_id string"))
    assert set(first.parts["reviews"]) < set(after.parts["reviews"]) and len(after.parts["reviews"]) == 2
    assert after.rows("reviews") == 7 and after.rows("review_aspects") == 14


def test_many_parts_become_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "MOST_PARTS", 2)
    root = str(tmp_path)
    for i in range(3):
        last = store.load(spark, root, reviews(spark, [i]), aspects(spark, [i]))
    assert len(last.parts["reviews"]) == 1 and content(spark, root)[0] == ["0", "1", "2"]


def test_an_orphan_fails_the_load(spark, tmp_path):
    root = str(tmp_path)
    store.load(spark, root, reviews(spark, [1]), aspects(spark, [1]))
    with pytest.raises(IntegrityError):
        store.load(spark, root, reviews(spark, [2]), aspects(spark, [2, 3]))
    assert content(spark, root) == (["1"], ["1", "1"]) and snapshot(spark, root).version == 1


def test_empty_loads_and_repeated_ids(spark, tmp_path):
    root = str(tmp_path)
    store.load(spark, root, reviews(spark, []), aspects(spark, []))
    store.load(spark, root, reviews(spark, [1, 1]), aspects(spark, [1]))
    assert content(spark, root) == (["1"], ["1", "1"])


def test_retracting_twice_is_refused(spark):
    counts = summary.mention_counts(reviews(spark, [1]), aspects(spark, [1]))
    gone = summary.retracted(counts)
    assert summary.changed_counts(counts, gone).count() == 0
    with pytest.raises(Exception, match="more mentions retracted"):
        summary.changed_counts(counts, gone, gone).collect()


def test_a_load_writes_its_rows_and_counts_only(spark, tmp_path):
    root = str(tmp_path / "store")
    first = store.load(spark, root, reviews(spark, range(4)), aspects(spark, range(4)))
    second = store.load(spark, root, reviews(spark, range(2, 6)), aspects(spark, range(2, 6), "positive"))
    # The counts of the first load go on as they are; the report sums the parts.
    assert set(first.parts["mention_counts"]) < set(second.parts["mention_counts"])
    now = snapshot(spark, root)
    report = summary.summary_of(now.table(spark, "mention_counts"))
    whole = product_aspect_summary(*(now.table(spark, t) for t in ("reviews", "review_aspects")))
    assert sorted(map(tuple, report.select(*whole.columns).collect())) == sorted(map(tuple, whole.collect()))


def test_counts_of_many_changes_become_one_part(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "MOST_PARTS", 3)
    root = str(tmp_path)
    store.load(spark, root, reviews(spark, range(9)), aspects(spark, range(9)))
    for i in range(3):
        last = store.delete(spark, root, spark.createDataFrame([(str(i),)], "review_id string"))
    assert len(last.parts["mention_counts"]) == 1
    assert summary.summary_of(last.table(spark, "mention_counts")).selectExpr("sum(total_mentions)").first()[0] == 12


def test_deleted_rows_leave_the_disk_though_their_counts_stay(spark, tmp_path):
    root = str(tmp_path)
    first = store.load(spark, root, reviews(spark, range(4)), aspects(spark, range(4)))
    (part,) = first.parts["reviews"]
    for i in range(3):
        store.delete(spark, root, spark.createDataFrame([(str(i),)], "review_id string"))
    assert sorted(p.name for p in (tmp_path / "data" / part).iterdir()) == ["mention_counts"]


@pytest.mark.parametrize("before", [False, True])
def test_aspects_without_any_review_fail_the_load(spark, tmp_path, before):
    root = str(tmp_path)
    if before:
        store.load(spark, root, reviews(spark, [1]), aspects(spark, [1]))
    with pytest.raises(IntegrityError, match="2 aspect rows without a review"):
        store.load(spark, root, reviews(spark, []), aspects(spark, [2]))
    nameless = aspects(spark, [1]).selectExpr("cast(null as string) as review_id", "pos", "aspect", "aspect_sentiment")
    with pytest.raises(IntegrityError, match="2 nulls in review_aspects.review_id"):
        store.load(spark, root, reviews(spark, [1]), nameless)


def test_only_rows_that_come_in_are_checked(spark, tmp_path):
    root = str(tmp_path)
    store.load(spark, root, reviews(spark, [1]), aspects(spark, [1]))
    empty = aspects(spark, [1, 2]).selectExpr("review_id", "pos", "if(review_id = '1', null, aspect) as aspect", "aspect_sentiment")
    store.load(spark, root, reviews(spark, [1, 2]), empty)
    assert content(spark, root) == (["1", "2"], ["1", "1", "2", "2"])
    with pytest.raises(IntegrityError, match="nulls in review_aspects.aspect$"):
        store.load(spark, root, reviews(spark, [3]), aspects(spark, [3]).selectExpr("review_id", "pos", "cast(null as string) as aspect", "aspect_sentiment"))
    padded = aspects(spark, [1]).selectExpr("concat(' ', review_id) as review_id", "pos", "aspect", "aspect_sentiment")
    assert store.load(spark, root, reviews(spark, []), padded).rows("review_aspects") == 4


def test_rows_are_written_once_where_they_are_published(spark, tmp_path):
    working = Path(spark.conf.get("spark.checkpoint.dir"))
    working.mkdir(exist_ok=True)
    before, root = set(working.iterdir()), str(tmp_path)
    store.load(spark, root, reviews(spark, range(9)), aspects(spark, range(9)))
    again = reviews(spark, [20] * 1000 + list(range(9)))
    assert store.load(spark, root, again, aspects(spark, [20])).rows("reviews") == 10
    store.delete(spark, root, spark.createDataFrame([("20",)], "review_id string"))
    assert set(working.iterdir()) == before


def test_aspects_are_looked_for_again_only_if_some_have_no_review(spark, tmp_path, monkeypatch):
    calls, real = [], store.assert_no_orphans
    monkeypatch.setattr(store, "assert_no_orphans", lambda *given: (calls.append(given), real(*given)))
    root = str(tmp_path)
    store.load(spark, root, reviews(spark, range(4)), aspects(spark, range(4)))
    last = store.load(spark, root, reviews(spark, range(2, 6)), aspects(spark, range(6), "positive"))
    assert not calls and last.rows("review_aspects") == 12
    padded = aspects(spark, [1, 7]).selectExpr("if(review_id = '1', ' 1 ', review_id) as review_id", "pos", "aspect", "aspect_sentiment")
    assert store.load(spark, root, reviews(spark, [7]), padded).rows("review_aspects") == 14 and len(calls) == 1
    with pytest.raises(IntegrityError, match="2 aspect rows without a review"):
        store.load(spark, root, reviews(spark, [8]), aspects(spark, [1, 8, 9]))
    assert snapshot(spark, root).version == 3


def test_a_delete_copies_only_the_reviews_that_go(spark, tmp_path, monkeypatch):
    made, real = [], store.stored_at
    monkeypatch.setattr(store, "stored_at", lambda df, purpose: (made.append(purpose), real(df, purpose))[1])
    root = str(tmp_path)
    both = spark.createDataFrame([("1", "b"), (" 1", "b"), ("2", "b"), ("11", "b")], "review_id string, brand_name string")
    store.load(spark, root, both.selectExpr("*", "'positive' as overall_sentiment", "'fixture' as extraction_method"),
               spark.createDataFrame([(i, p, "finish", "neutral") for i in ("1", " 1", "2", "11") for p in range(2)],
                                     "review_id string, pos long, aspect string, aspect_sentiment string"))
    last = store.delete(spark, root, spark.createDataFrame([("1 ",), ("1",), (None,)], "review_id string"))
    assert made == ["deleted-reviews"]
    assert content(spark, root) == (["11", "2"], ["11", "11", "2", "2"])
    assert [r["total_mentions"] for r in summary.summary_of(last.table(spark, "mention_counts")).collect()] == [4]
