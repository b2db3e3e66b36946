"""From raw documents to packed sequences, in five stages.

Every stage takes the documents that the stage before has kept (columns doc_id, text,
lang, source, n_chars) and returns documents; the last one returns packed pieces.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.llm import exact_packing, lempel_ziv, line_quality, poisson_mix, simhash
from hearthline.session import settle, ship_package

LINES = line_quality.Limits(share=0.0)  # a fixed number of documents, whatever their source's size
SHINGLE, MAX_BITS = 3, 2
SPAN_WORDS = 20
TEMPERATURE, EPOCHS, SEED = 2.0, 1.0, 17
SEQUENCE = 1024


def counted(docs: DataFrame) -> DataFrame:
    """The documents with the length of their present text."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that more than 20 documents of their source share."""
    ship_package(spark)
    return counted(line_quality.accepted(docs, limits=LINES, near_once=True))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship_package(spark)
    return simhash.one_of_each(docs, SHINGLE, MAX_BITS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that lie earlier in the corpus."""
    ship_package(spark)
    return counted(lempel_ziv.without_duplicates(docs, SPAN_WORDS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards the sources' target weights, in random order."""
    mixed = poisson_mix.mix(docs, temperature=TEMPERATURE, epochs=EPOCHS, seed=SEED)
    return mixed.select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of all documents, dealt to sequences in random order: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset."""
    ship_package(spark)
    return exact_packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE, seed=SEED, special=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mix", source_mix),
    ("packing", packing),
]

# Tokenizers and XXH64 are beyond SQL; tests/llm/test_pipeline.py follows the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settle(docs, name)
    return docs
