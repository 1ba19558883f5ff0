"""From documents to packed sequences: quality, exact copies, near copies, mixing, packing.

Each stage takes the rows that the stage before wrote and returns the columns of documents, the last one
the pieces of its sequences. Nulls count as empty texts; an empty table goes through empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from verdigris.llm import exact_dedup, jaccard, mixing, packing, quality
from verdigris.sources.storage import scratch_path

# Near copies: shingles of five words, similarity 0.8. Packing: sequences of 2048 ids, 0 ends a text.
NEAR_WORDS, NEAR_PERCENT = 5, 80
VOCABULARY, END_ID, SEQUENCE = "byte_bpe_50k.json", 0, 2048


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the rules or the model reject; the model is fitted on the labelled rows of ``docs``."""
    model = quality.train_quality_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.drop_low_quality(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of each component of near copies."""
    return jaccard.drop_near_duplicates(docs, NEAR_WORDS, NEAR_PERCENT)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that sources meet their target weights, in global random order."""
    return mixing.mix(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place; a repeated document is packed each time."""
    pieces = packing.token_pieces(docs, public_tokenizers.path(VOCABULARY), END_ID, SEQUENCE)
    return packing.pack(pieces.withColumnRenamed("id", "doc_id"), SEQUENCE)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("jaccard_join", near_copies),
    ("mixing", mixed_sources),
    ("best_fit_packing", packed_sequences),
]
# The first stage is a trained model, the last a packing: SQL expresses neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
