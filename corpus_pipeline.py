"""Raw documents to packed training sequences, in five stages.

Each stage is written as Parquet in the shared folder and read again by the
next. All but the last return the columns of the documents they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm import decontaminate, jaccard, linefreq, packing, suffixes
from shelfcast.llm.texts import checkpointed


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that are frequent at their source."""
    return linefreq.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return jaccard.keep_one_per_class(docs, percent=80, size=5)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words or more that an earlier document holds."""
    return suffixes.drop_repeats(docs, min_words=50)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of 4096 tokens."""
    return packing.packed_pieces(docs)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark decontamination", benchmark_free),
    ("packing", packed),
]

# Shingle components, spans and token ids have no SQL form; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = checkpointed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
