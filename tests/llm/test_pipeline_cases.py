"""The whole pipeline on nulls, ties, repeated rows, clashing columns and an empty table."""

from __future__ import annotations

import corpus_pipeline

WORDS = "the old river ran past the green house where nobody had lived for many years until the summer came"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, possible string, node string"
ROWS = [(1, WORDS, "en", "a"), (2, WORDS.upper(), "en", "a"), (2, WORDS.upper(), "en", "a"), (3, None, None, None),
        (4, "", "en", "a"), (5, WORDS + " again", "en", "b"), (6, "password=abcdef12 is in this short note", "en", "b"),
        (None, "a row without an id that says something else", "en", "b"), (7, "12 34 !!", "en", "b")]


def kept(spark, rows):
    docs = spark.createDataFrame([(*r, len(r[1] or ""), f"p{i}", f"n{i}") for i, r in enumerate(rows)], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
    return docs, corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()


def test_cases(spark):
    docs, pieces = kept(spark, ROWS)
    rows = {r["doc_id"]: r for r in docs.collect()}
    assert docs.count() == len(rows) and set(rows) == {2, 6, None}
    assert rows[2]["text"] == WORDS.upper() and (rows[2]["possible"], rows[2]["node"]) == ("p2", "n2")
    assert rows[6]["text"] == "[secret] is in this short note" and rows[6]["n_chars"] == len(rows[6]["text"])
    assert {p["doc_id"] for p in pieces} == set(rows) and len({p["sequence_id"] for p in pieces}) == 1


def test_empty_table(spark):
    docs, pieces = kept(spark, [])
    assert docs.collect() == [] and pieces == []
