"""The corpus pipeline: STAGES of (name, function), applied to ``documents`` one after another.

Each function takes (spark, docs, sf_dir) and works on all rows of ``docs``, the Parquet that its
predecessor left; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ragstone.llm import packing, pii, quality, set_join
from ragstone.llm.common import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their group's fences reject go."""
    return quality.keep_good(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that with the smallest doc_id."""
    return set_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by the names of its kinds; every document stays."""
    return pii.redact(docs)


def harmonic_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 1024 tokens."""
    return packing.packed(docs)


STAGES = [("quality", quality_rules), ("jaccard", jaccard_join), ("pii", personal_data), ("packing", harmonic_packing)]

#: No SQL expresses the tokenizing and packing stage; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the ``documents`` of ``sf_dir``, each stage written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
