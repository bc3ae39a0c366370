"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from affinis.llm import language_id, mixing, near_dup, packing, pii
from affinis.llm.common import table
from affinis.llm.queries import tokenizer_path
from affinis.session import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents of no language go."""
    return language_id.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one document of each group stays."""
    return near_dup.keep_one(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: personal data and what reveals it is replaced."""
    return pii.sanitise(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents of each source up to its target, some twice, shuffled."""
    return mixing.mix(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: pieces in sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("pii", private),
          ("mixture", mixture), ("pack", pack)]

# language ID and packing learn and choose in ways that SQL cannot express; the tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
