"""The corpus pipeline: each stage reads what the one before it kept, as a written table.

Quality rules drop documents, the n-gram Jaccard join leaves one document of each group of near
copies, the mixture draws documents of domains, languages and sources to their target weights
(a document drawn in two epochs is two rows), and the rest is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from healthmart.llm import bpe, jaccard, mixing, quality
from healthmart.llm.common import table, written
from healthmart.llm.queries import BYTE_RANKS, MIX_EPOCHS, MIX_SEED, MIX_SHARE, MIX_WEIGHTS, mix_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and score like trusted ones."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each component of near copies."""
    return jaccard.first_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights, a row for each epoch they are drawn in."""
    return mixing.remix(docs, mix_path(), MIX_WEIGHTS, share=MIX_SHARE, max_epochs=MIX_EPOCHS, seed=MIX_SEED)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document that is left, with their round trip's digests."""
    return bpe.encode(docs, BYTE_RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE encoding and decoding", encode_stage),
]

#: Hashed weights, shingle components and token ids are not expressible in SQL; the tests compare
#: the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{i}")
    return docs
