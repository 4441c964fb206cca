"""From raw documents to packed sequences: the stages of the corpus pipeline.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet
and reads again as the next stage's documents. Labels and benchmark come from ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parvis.llm import decontaminate, line_dedup, near_copies, packing, quality
from parvis.llm.common import store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the risk-controlled rules reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops common lines but for one holder; ``n_chars`` follows the kept text."""
    return line_dedup.keep_columns(docs, line_dedup.dedup_lines(docs))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every component of near copies (5-word shingles, Jaccard 0.8)."""
    return near_copies.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs, capacity=2048)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("SimHash near-dedup", near_deduplication),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

# Fitted cutoffs, XXH64 fingerprints, tiling and a tokenizer have no SQL form; tests/llm checks
# the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), "stage")
    return docs
