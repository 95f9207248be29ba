"""The operators of this subpackage as registered queries over the generated tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinarium.llm import (bpe, collocations, exact_dedup, langid, licenses, merkle, near_dedup, neighbours, oracles, packing,
                           pii, secrets, sharding, toxicity)

RANKS = "byte_bpe_50k.tiktoken"
SHARDS = 16
CONTRACT_SHINGLE = 4
NEAREST, QUERY_EVERY = 5, 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ranks_path() -> str:
    """The file of token ranks, installed with the tokenizers on every machine."""
    return public_tokenizers.path(RANKS)


def score_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def identify_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = langid.train(table(spark, sf_dir, "documents"))
    return langid.page_languages(table(spark, sf_dir, "pages"), profiles)


def encode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, sf_dir, "documents"), ranks_path())


def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), ranks_path())


def scan_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


def search_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return neighbours.nearest_neighbours(vectors, F.col("id") % QUERY_EVERY == 0, NEAREST)


def shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)


def group_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_groups(table(spark, sf_dir, "documents"))


def group_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_dedup.near_groups(table(spark, sf_dir, "documents"), CONTRACT_SHINGLE)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


def scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def mine_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def find_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def verify_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(table(spark, sf_dir, "documents"))


def run_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_toxicity": score_toxicity,
    "op2_language": identify_languages,
    "op3_byte_bpe": encode_documents,
    "op4_packing": pack,
    "op5_licenses": scan_licenses,
    "op6_neighbours": search_neighbours,
    "op7_sharding": shard,
    "op8_exact_dedup": group_copies,
    "op9_near_dedup": group_near_copies,
    "op10_secrets": scan_secrets,
    "op11_collocations": mine_collocations,
    "op12_pii": find_personal_data,
    "op13_merkle": verify_manifest,
    "pipeline": run_pipeline,
}

ORACLES = {
    "op8_exact_dedup": oracles.EXACT_DEDUP,
    "op11_collocations": oracles.COLLOCATIONS,
    "op13_merkle": oracles.MERKLE,
}
