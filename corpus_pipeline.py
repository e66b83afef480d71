"""From raw documents to packed training sequences, in five stages.

Quality, exact dedup and near dedup drop rows; mixing repeats or drops rows so that sources reach their
weights; packing places what is left. Each stage is written and read again, so a lost executor
repeats part of one stage at most, and every stage works on all that the one before kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.llm import exact, mixing, packing, quality, simhash
from tagwright.llm.common import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, by ``labels``."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that of the largest doc_id."""
    return exact.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash fingerprints within 2 bits, that of the smallest doc_id."""
    return simhash.first_of_groups(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixing.repeated(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and copy with their place in a sequence."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Compression, fingerprints and packing are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
