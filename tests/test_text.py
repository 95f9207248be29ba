from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from opinarium.functions import text as t

SAMPLES = [
    "plain", "  both ends  ", "\t\n\x0b\x0c\r mixed \x1c\x1d\x1e\x1f", " nbsp ",
    "in　side", " ogham ", "", "   ", None, "​zero width stays​",
    "a\x85b \x85", "line\nbreak\n",
]


def values(spark, texts, column):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_strip_matches_python(spark):
    assert values(spark, SAMPLES, t.strip) == [None if x is None else x.strip() for x in SAMPLES]


def test_normalize_whitespace_matches_python(spark):
    texts = [*SAMPLES, "\t one  two \n\n three\r\n  four "]
    expected = ["" if x is None else " ".join(x.split()) for x in texts]
    assert values(spark, texts, t.normalize_whitespace) == expected
    assert expected[-1] == "one two three four"


@pytest.mark.parametrize("raw, clean", [
    ("smooth <i>and</i> light<hr/>", "smooth and light"),
    ("nothing to remove", "nothing to remove"),
    ("<a<b>>z", "<a>z"),
    ("a < b and c > d", "a  d"),
    ("1 < 2", "1 < 2"),
    ("<>x", "<>x"),
    ("<p\nclass='x'>y</p>", "y"),
    (None, ""),
])
def test_strip_html(spark, raw, clean):
    assert values(spark, [raw], t.strip_html) == [clean]


def test_remove_tags_keeps_null(spark):
    assert values(spark, [None, " <br/> "], t.remove_tags) == [None, ""]


def test_labels(spark):
    assert values(spark, [" Shade Match", "price  value", None], t.snake_label) == [
        "shade_match", "price__value", None]
    assert values(spark, [" Positive "], t.label) == ["positive"]


def test_blank(spark):
    assert values(spark, [None, "", "  ", "x"], t.is_blank) == [True, True, True, False]


def test_id_key_is_the_stripped_text(spark):
    texts = [*SAMPLES, "7", " 7", "7 ", "!", "~", "\x7f", "é", "é ", " é", "a\u3000", "\x1ca", "a\x85", "a b", "\u200b1"]
    assert values(spark, texts, t.id_key) == [None if x is None else x.strip() for x in texts]
