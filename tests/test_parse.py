from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from opinarium.functions import parse as p


def parsed(spark, texts, rule):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("x"))).collect()]


def test_numbers(spark):
    texts = ["1", " 2.50 ", "-3e2", ".5", "7.", "1.0d", "0x10", "abc", "", None, "nan", "1,000"]
    assert parsed(spark, texts, p.to_number) == [
        1.0, 2.5, -300.0, 0.5, 7.0, None, None, None, None, None, None, None]
    assert parsed(spark, ["inf", "-Infinity"], p.to_number) == [math.inf, -math.inf]


def test_numeric_input_loses_nan_only(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in df.select(p.to_number(F.col("x"), "double")).collect()] == [1.5, None, None]


def test_timestamps(spark):
    texts = ["2024-01-02", "2024-01-02 03:04:05", "2021-13-01", "soon", None, "12:30",
             "05/03/2021"]
    day = dt.datetime(2024, 1, 2)
    iso = [day, day.replace(hour=3, minute=4, second=5), None, None, None, None]
    assert parsed(spark, texts, p.to_timestamp) == [*iso, None]
    with_format = parsed(spark, texts, lambda c: p.to_timestamp(c, formats=["dd/MM/yyyy"]))
    assert with_format == [*iso, dt.datetime(2021, 3, 5)]


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        got = parsed(spark, ["2024-01-02", "05/03/2021"],
                     lambda c: p.to_timestamp(c, formats=["dd/MM/yyyy"]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [dt.datetime(2024, 1, 2), dt.datetime(2021, 3, 5)]


def test_booleans(spark):
    texts = ["True", "false", " YES", "0", "1.0", "maybe", None]
    assert parsed(spark, texts, p.to_boolean) == [True, False, True, False, True, None, None]
    assert parsed(spark, [None], lambda c: p.to_boolean(c, missing=True)) == [True]
