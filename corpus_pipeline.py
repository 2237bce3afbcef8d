"""Corpus pipeline: four stages from ``documents`` to packed sequences.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage
before it kept and, but for the last, returns the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import jaccard_join, knn_quality, packing, quality_rules
from cohortlens.llm.common import documents, tokenizer_path, written


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the risk-controlled rules."""
    return quality_rules.keep(docs, documents(spark, sf_dir, "labels"))


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbour vote predicts to be good."""
    return knn_quality.keep(docs, documents(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its 5-word shingles."""
    return jaccard_join.keep_one(docs, n=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents, placed in sequences."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", rules),
    ("quality_classifier", classifier),
    ("ngram_jaccard_join", near_duplicates),
    ("best_fit_packing", pack),
]

#: Tokenising and fitting cannot be written in SQL; tests/llm holds the
#: stages against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written
    to the shared checkpoint folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
