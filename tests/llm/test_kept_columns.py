"""Stages that drop rows return the input's columns with the input's values, whatever their names."""

from __future__ import annotations

import pytest

from opinarium.llm import exact_dedup, langid, near_dedup

NAMES = ["text_hash", "possible", "_digest", "_possible", "_row", "_word0", "_mask1", "_bit0", "node", "number", "_id",
         "_hash", "kept", "component_id", "probability"]
TEXTS = ["the river and the house are green and old today", "another text about a house that nobody knows at all",
         "the river and the house are green and old today", "a third text that stands alone among all of these here"]


def rows(names):
    return [(i, t, "en", "s", *[f"{n}{i}" for n in names]) for i, t in enumerate(TEXTS)]


@pytest.mark.parametrize("stage", [
    lambda docs: langid.readable_documents(docs, langid.train(docs)), exact_dedup.drop_copies, near_dedup.drop_near_copies])
def test_values_stay(spark, stage):
    given = rows(NAMES)
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, "
                                 + ", ".join(f"{n} string" for n in NAMES))
    out = stage(docs)
    assert out.columns == docs.columns
    found = [tuple(r) for r in out.collect()]
    assert found and set(found) <= set(given)
