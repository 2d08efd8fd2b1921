"""The corpus pipeline: five stages from raw documents to token ids, each of which reads what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kenning.llm import decontam, pii, quality, simhash, unigram
from kenning.llm.common import materialise, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above their host's limit go from those that stay."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies stays."""
    return simhash.drop_near_copies(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind in brackets."""
    return pii.redact(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids, checked by decoding."""
    return unigram.with_pieces(docs, unigram.load())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("redact_pii", redact_pii),
    ("sentencepiece", sentencepiece),
]

#: Fingerprints, banded alignment and Viterbi decoding can't be expressed in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; what each keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
