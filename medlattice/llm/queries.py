"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlattice.llm import ball_codes, contamination, context_tree, conversation_trie, html_extract, license_scan, mixing, overlap_join, quality_classifier, quality_rules, repeats, secret_scan, simhash
from medlattice.llm.common import documents, read_table, remainder


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir, "doc_id", "text"))


def op2_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read_table(spark, sf_dir, "benchmark").select("item_id", "text")
    return contamination.matches(documents(spark, sf_dir, "doc_id", "text"), items)


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removed(documents(spark, sf_dir, "doc_id", "text"))


def op4_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.scores(documents(spark, sf_dir, "doc_id", "text"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.spans(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_rules.ledger(documents(spark, sf_dir, "doc_id", "text"))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes("base")).alias("base_failed"), quality_rules.passes("v1").alias("kept"), "fail_bits",
    )


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality_classifier.measured(documents(spark, sf_dir, "doc_id", "text"))
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = quality_classifier.scored(stats, quality_classifier.train(stats, labels))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mixed(documents(spark, sf_dir, "doc_id", "text", "source"))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op11_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_join.components(documents(spark, sf_dir, "doc_id", "text"))


def op12_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_codes.codes(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_license_scan, op2_contamination, op3_repeats, op4_context_tree, op5_secret_scan, op6_simhash, op7_quality_rules,
        op8_quality_classifier, op9_mixing, op10_html_extract, op11_overlap_join,
        op12_ball_codes, op13_conversation_trie,
    )
    return {f.__name__: f for f in found}
