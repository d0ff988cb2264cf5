"""Corpus pipeline: quality classifier, line dedup, n-gram Jaccard join, secret scan, best-fit packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the last
return the columns of documents; where a stage changes texts it sets n_chars anew.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from erpspark.llm import jaccard_join, line_dedup, packing, quality_pu, secret_scan
from erpspark.llm.scratch import ship, stored


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    ship(spark)
    return quality_pu.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines of five documents or more stay in their last holder only."""
    ship(spark)
    return _with_text(line_dedup.dedup_lines(docs).withColumn("text", F.when(F.col("__n_lines").isNotNull(), F.col("__kept"))), docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, similarity 0.8."""
    ship(spark)
    return jaccard_join.keep_first(docs)


def secret_scan_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by the name of their kind."""
    return _with_text(secret_scan.redact(docs), docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 4096 tokens."""
    ship(spark)
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("secret scans", secret_scan_stage),
    ("best-fit packing", best_fit_packing),
]

#: Scores and token ids come from a trained classifier and a tokenizer file, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written and read again."""
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
