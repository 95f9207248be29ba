"""Every operator on empty tables, nulls, empty and long texts, repeated rows and odd columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from opinarium.llm import (bpe, exact_dedup, langid, licenses, near_dedup, neighbours, packing, queries, secrets,
                           sharding, toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_hash long, node string, shard int"
LONG = "many words of a very long text " * 20_000
ROWS = [
    (1, "the same words stand here twice and once more", "en", "a"), (2, "The same words stand here twice and once more", "en", "a"),
    (3, None, None, None), (4, "", "en", "a"), (None, "a row without an id", "en", None),
    (5, LONG, "en", "a"), (6, "repeated row", "fr", "b"), (6, "repeated row", "fr", "b"), (7, "éß中\U0001f600", "de", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, len(r[1] or ""), 0, "x", 1) for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None), (99, 1), (5, 0)], "doc_id long, toxic int")


def operators(labels):
    path = queries.ranks_path()
    return {
        "toxicity": lambda d: toxicity.toxicity(d, labels),
        "langid": lambda d: langid.document_languages(d, langid.train(d)),
        "bpe": lambda d: bpe.encoding_digests(d, path),
        "packing": lambda d: packing.pack_documents(d, path, 1 << 20),
        "licenses": licenses.find_licenses,
        "sharding": sharding.shard_documents,
        "exact": exact_dedup.copy_groups,
        "near": near_dedup.near_groups,
        "secrets": secrets.find_secrets,
    }


NAMES = ["toxicity", "langid", "bpe", "packing", "licenses", "sharding", "exact", "near", "secrets"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_per_document(docs, labels, name):
    assert sorted(str(r[0]) for r in operators(labels)[name](docs).collect()) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(docs, labels, name):
    assert operators(labels)[name](docs.filter("false")).collect() == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_return_the_columns_of_documents(spark, docs, name, stage):
    assert stage(spark, docs, "").columns == docs.columns
    assert stage(spark, docs.filter("false"), "").collect() == []


def test_copies_leave_one_row_of_each_text(docs):
    kept = exact_dedup.drop_copies(docs)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["2", "4", "5", "6", "7", "None"])


def test_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [2.0, 0.0]),
            (6, [2.0, 0.0]), (None, [1.0, 1.0]), (8, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    out = neighbours.nearest_neighbours(df, F.col("id") % 2 == 1).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out] == [(1, 1, 6, 1.0)]
    assert neighbours.nearest_neighbours(df.filter("false"), F.lit(True)).collect() == []
