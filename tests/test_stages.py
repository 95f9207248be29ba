"""Stages are built again when, and only when, something they depend on has changed."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from opinarium.sources.stages import staged


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def _chain(spark, root, least=0):
    read = staged(spark, root, "read", lambda: spark.read.parquet(f"{root}/raw"), [f"{root}/raw"])
    kept = staged(spark, root, "kept", lambda t, least: t.filter(F.col("id") >= least), params={"least": least}, after=[read])
    return [read, kept], [read.ran, kept.ran]


def test_what_runs_after_which_change(spark, root):
    spark.range(5).write.parquet(f"{root}/raw")
    assert _chain(spark, root)[1] == [True, True]
    assert _chain(spark, root)[1] == [False, False]
    assert _chain(spark, root, 3)[1] == [False, True]
    spark.range(5, 9).write.mode("append").parquet(f"{root}/raw")
    built, ran = _chain(spark, root, 3)
    assert ran == [True, True] and built[1].table(spark).count() == 6
    spark.range(2).write.mode("overwrite").parquet(f"{root}/raw")
    built, ran = _chain(spark, root, 3)
    assert ran == [True, True] and built[1].table(spark).count() == 0


def test_a_failed_build_leaves_the_stage_as_it_was(spark, root):
    spark.range(5).write.parquet(f"{root}/raw")
    before = _chain(spark, root)[0][1]

    def fail(table, least):
        raise RuntimeError("no")

    read = _chain(spark, root)[0][0]
    with pytest.raises(RuntimeError):
        staged(spark, root, "kept", fail, params={"least": 2}, after=[read])
    again = _chain(spark, root)[0][1]
    assert (again.build, again.ran, again.table(spark).count()) == (before.build, False, 5)


def test_readers_of_the_build_before_are_not_disturbed(spark, root):
    spark.range(5).write.parquet(f"{root}/raw")
    old = _chain(spark, root)[0][1].table(spark)
    _chain(spark, root, 4)
    assert old.count() == 5


def test_a_manifest_that_was_cut_off_counts_as_none(spark, root):
    spark.range(5).write.parquet(f"{root}/raw")
    _chain(spark, root)
    with open(f"{root}/kept/current.json", "r+") as f:
        f.truncate(10)
    crc = f"{root}/kept/.current.json.crc"
    if os.path.exists(crc):
        os.unlink(crc)
    assert _chain(spark, root)[1] == [False, True]


def test_absent_inputs_and_empty_tables(spark, root):
    def empty():
        return spark.range(0)

    assert staged(spark, root, "none", empty, [f"{root}/absent"]).ran
    again = staged(spark, root, "none", empty, [f"{root}/absent"])
    assert not again.ran and again.table(spark).count() == 0
