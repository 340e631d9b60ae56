"""The thirteen operators and the pipeline as registered queries, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    bytepairs,
    decontaminate,
    hardneg,
    infill,
    jaccard,
    linear,
    linefreq,
    packing,
    pagetree,
    sharding,
    suffixes,
    tokencount,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark, sf_dir):
    return packing.packed_pieces(table(spark, sf_dir, "documents"))


def op2_suffix_array_dedup(spark, sf_dir):
    """One row per repeated passage and document, with its words' places; later occurrences are marked."""
    spans = suffixes.repeated_spans(table(spark, sf_dir, "documents"))
    return spans.select("doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"), "later")


def op3_extendible_sharding(spark, sf_dir):
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark, sf_dir):
    pages = pagetree.extracted(table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def scores(spark, sf_dir, scored, modulus: int, remainder: int, least: float, **how):
    """Scores of all documents by a model that learns from the rows that are not held out."""
    out = linear.held_out(modulus, remainder)
    rows = scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), out=out, **how)
    return rows.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op5_toxicity(spark, sf_dir):
    return scores(spark, sf_dir, toxicity.scored, 5, 0, 0.5, target="toxic")


def op10_quality_classifier(spark, sf_dir):
    return scores(spark, sf_dir, linear.scored, 4, 2, 0.7, target="quality")


def op6_benchmark_decontamination(spark, sf_dir):
    """One row per document and benchmark item found in it, with the place and the edits."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


def op7_token_counts(spark, sf_dir):
    counts = tokencount.token_counts(table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op8_quality_rules(spark, sf_dir):
    return linefreq.line_verdicts(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents"), percent=85, size=4)


def op11_hard_negatives(spark, sf_dir):
    """Hard negatives of every fiftieth vector; every seventh row's label is moved on by one first."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 50 == 0)


def op12_byte_bpe(spark, sf_dir):
    return bytepairs.digests(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark, sf_dir):
    return infill.digests(table(spark, sf_dir, "documents"))


REGISTRY: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_extendible_sharding": op3_extendible_sharding,
    "op4_html_extraction": op4_html_extraction,
    "op5_toxicity": op5_toxicity,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_token_counts": op7_token_counts,
    "op8_quality_rules": op8_quality_rules,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_fill_in_middle": op13_fill_in_middle,
}
ORACLE: dict[str, str] = {
    "op3_extendible_sharding": sharding.ORACLE,
    "op8_quality_rules": linefreq.ORACLE,
    "op11_hard_negatives": hardneg.ORACLE,
    "op13_fill_in_middle": infill.ORACLE,
}
