"""The operators bound to the given tables: one query each, over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.llm import (
    bond_search, boosted_quality, exact_packing, importance_resample, lempel_ziv, line_quality, odd_sketch, poisson_mix, simhash, table_clusters,
    token_planes, tree_sharding, warc_chunks,
)
from hearthline.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as byte planes and read back."""
    manifest = token_planes.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_planes.read_ids(manifest)


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of all documents, after the lines that more than 20 documents of a source share, near copies counted as one."""
    limits = line_quality.Limits(share=0.0)
    return line_quality.judge(table(spark, sf_dir, "documents"), limits=limits, near_once=True).select("doc_id", *line_quality.STATISTICS)


def op3_exact_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 ids."""
    pieces = exact_packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return exact_packing.pack(pieces.drop("file", "at"))


def op4_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archive records and read back as chunks; the last chunk of each has the payload's digest."""
    chunks = warc_chunks.read_archives(warc_chunks.archive(table(spark, sf_dir, "pages")), with_data=False)
    return chunks.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all documents, the words in factors of 20 words or more that lie earlier in the corpus."""
    found = lempel_ziv.parse(table(spark, sf_dir, "documents"), 20, with_text=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents repeated towards source weights of the square root of their size, in random order."""
    return poisson_mix.mix(table(spark, sf_dir, "documents"), temperature=2.0, epochs=1.0, seed=17)


def op7_bond_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest inner products of every hundredth vector among all others."""
    return bond_search.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, 10)


def op8_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return boosted_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of all documents."""
    found = simhash.grouped(table(spark, sf_dir, "documents"), shingle=3, k=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal size, equal texts together."""
    return tree_sharding.shard(table(spark, sf_dir, "documents"), 16, payload=[])


def op11_table_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of 64 components in 16 clusters after three rounds."""
    return table_clusters.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64, seed=1)


def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their weight towards the benchmark's texts, and the ranks of the tenth that is drawn."""
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance_resample.resample(documents, benchmark, share=10, runs=1, buckets=10_000, min_words=20, seed=2024)


def op13_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents by sets of two-word shingles."""
    return odd_sketch.grouped(table(spark, sf_dir, "documents"), shingle=2, percent=80)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_planes, op2_line_quality, op3_exact_packing, op4_warc_chunks, op5_lempel_ziv,
        op6_poisson_mix, op7_bond_search, op8_boosted_quality, op9_simhash, op10_tree_sharding,
        op11_table_clusters, op12_importance_resample, op13_odd_sketch,
    )
}
