"""The corpus pipeline: toxicity, exact dedup, near-duplicate join, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldguard.llm import bpe, exact_dedup, jaccard, mixing, toxicity
from fieldguard.llm.common import discard, load, materialize


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from labelled rows that aren't held out."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the owner stays; of rows repeated as a whole, one."""
    return exact_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents the one with the smallest doc_id stays; rows without a doc_id or without words stay."""
    classes = jaccard.near_duplicates(docs)
    gone = classes.where("doc_id != component_id").select(F.col("doc_id").alias("fg_id")).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("fg_id"), "left_anti")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document, written by shard and in each shard in its shuffled order."""
    return mixing.mixed_shards(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the mixed documents' ids."""
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_jaccard", near_dedup_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", bpe_stage),
]

#: Learned scores and token merges are beyond SQL; the tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between them goes through the shared folder and is removed once it is read."""
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir))
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
