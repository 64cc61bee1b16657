"""The training-data pipeline: five stages over ``documents``, each written before the next one reads it.

A stage takes (spark, docs, sf_dir) and returns the rows it keeps with the columns of ``documents``; the
last adds ``copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlattice.llm import contamination, mixing, near_copies, quality_classifier, secret_scan
from medlattice.llm.common import cut_lineage, read_table

#: shingles of the near-duplicate stage, and the least similarity of two shingle sets that links them
WORDS, SIMILAR = 5, 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It is trained on the labelled documents of ``docs``."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    stats = quality_classifier.measured(docs.select("doc_id", "text"))
    return quality_classifier.accepted(docs, quality_classifier.train(stats, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near-duplicates."""
    return near_copies.deduplicated(docs, WORDS, SIMILAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return contamination.clean(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind; ``n_chars`` follows the text."""
    out = secret_scan.redacted(docs)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the number of their copies."""
    return mixing.with_copies(docs)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secrets),
    ("source_mixing", mixture),
]

#: boosting and hash searches have no counterpart in SQL; tests/llm compares the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
