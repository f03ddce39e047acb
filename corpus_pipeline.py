"""The corpus pipeline: stages that each apply one operator to what the stage before kept.

Each stage takes documents and returns documents with the same columns, the last one token counts and digests of
the whole texts. Results are written as Parquet and read again by the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import bpe, decontamination, line_dedup, near_dedup, quality
from llm.common import store, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail a rule go, then documents that fail or lost too much."""
    return quality.clean_documents(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, but for their first occurrence."""
    kept = line_dedup.dedup_lines(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8) stays."""
    return near_dedup.drop_near_copies(docs, k=5, percent=80).select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item go."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return bpe.digests(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("bpe", token_stage),
]

# Byte-pair encoding has no SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = store(docs, name.replace(" ", "-"))
    return docs
