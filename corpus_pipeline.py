"""A corpus pipeline of four stages over ``documents``.

Low quality goes first, then documents that fail the quality rules, then all
but one of each group of near duplicates; what stays is packed into training
sequences.  Each stage reads what its predecessor wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import near_dedup, packing, quality_classifier, quality_rules
from strata.llm.common import table, written


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-neighbour classifier does not reject."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood-ratio threshold."""
    return quality_rules.keep_passing(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of least id, of each group linked by shingles of five words at similarity 0.8."""
    return near_dedup.keep_one(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, each with its sequence and place."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", drop_low_quality),
    ("quality_rules", apply_rules),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack_sequences),
]

#: Stages learn from hashed samples, hash shingles and call a tokenizer, which
#: SQL cannot express; tests/llm holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
