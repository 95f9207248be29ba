"""Fitting on tables in which texts repeat."""

from __future__ import annotations

import numpy as np

from opinarium.llm import langid


def test_copies_of_texts_teach_once(spark):
    distinct = [(f"{w} und {w}heit", "de") for w in ("haus", "baum", "kind")] + [("the house is here", "en")]
    docs = spark.createDataFrame(distinct, "text string, lang string")
    copied = spark.createDataFrame(distinct[:1] * 3000 + distinct * 2, "text string, lang string")
    plain, found = langid.train(docs), langid.train(copied)
    assert found.languages == plain.languages == ["de", "en"]
    np.testing.assert_array_equal(found.table, plain.table)


def test_sample_holds_texts_however_often_they_repeat(spark):
    """3 texts in 6000 rows, of which 2 are fitted: the draw is by text, and never empty."""
    texts = [f"{w}{w} {w}" for w in ("abc", "def", "ghi", "jkl", "mno", "pqr", "stu")]
    rows = [(t, lang) for lang in ("xa", "xb", "xc") for t in texts] * 300
    found = langid.train(spark.createDataFrame(rows, "text string, lang string"), sample_texts=2)
    least = found.table.min(axis=1, keepdims=True)
    own = {t: set(langid._sequences(langid.blocks(langid.pa.array([t])).__iter__().__next__())[1].tolist()) for t in texts}
    for row in found.table > least:
        assert sum(slots <= set(np.flatnonzero(row).tolist()) for slots in own.values()) == 2
