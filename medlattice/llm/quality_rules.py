"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger row keeps the measurements and one bit per
failed rule. A policy is a versioned set of rules: whether a document passes is one bitwise AND, so
policies can be changed, compared and ablated without reading a text again.

Main path: column expressions only, no shuffle. The ledger is a written table: a filter on its bits would otherwise be
pushed below the measurements and have them taken again, text by text. Ablation: counts per bit pattern (combined
before they move), then bitwise tests on the patterns.

Defined cases: a null or empty text has no words and fails ``few_words``; a null ``doc_id`` is kept;
repeated rows give repeated ledger rows; an empty table gives an empty ledger; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import cut_lineage, words

SYMBOLS = r"[^#*$%&|<>]+"

#: measurements in the order of the ledger's columns
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks",
)


@dataclass(frozen=True)
class Rule:
    """A document fails when ``sql`` over the measurements is true."""

    name: str
    sql: str


#: the position of a rule is its bit; new rules are appended, none is ever moved
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 60 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("capitals", "2 * n_upper > word_chars"),
    Rule("many_marks", "4 * n_marks > n_words"),
)
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(BIT[name] for name in names)


#: policies by version; a published version never changes
POLICIES = {
    "base": mask("few_words", "repeated_windows"),
    "v1": mask(*BIT),
}


def _measured(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    stage = docs.select("doc_id", text.alias("text")).select("doc_id", "text", words(F.col("text")).alias("words"))
    # One hash per window tells most texts from those with an equal pair. For these, sorted numbers
    # (a prefix of the hash above the window's position) bring equal windows together; these few
    # candidates are compared by their words in the end, so no hash decides.
    stage = stage.withColumn("h", F.expr("transform(words, w -> xxhash64(w))")).withColumn("n", F.size("words"))
    stage = stage.withColumn("h", F.expr("transform(slice(h, 1, greatest(n - 2, 0)), (x, i) -> xxhash64(x, h[i + 1], h[i + 2]))"))
    stage = stage.withColumn("wide", F.expr("length(bin(n))")).withColumn("low", F.expr("shiftleft(1L, wide) - 1"))
    stage = stage.withColumn(
        "packed",
        F.expr(
            "CASE WHEN size(array_distinct(h)) = size(h) THEN array()"
            " ELSE sort_array(transform(h, (x, i) -> (x & ~low) | i)) END"
        ),
    )
    stage = stage.withColumn(
        "candidates",
        F.expr(
            "transform(filter(packed, (p, i) -> (i > 0 AND shiftrightunsigned(p ^ packed[i - 1], wide) = 0)"
            " OR (i < size(packed) - 1 AND shiftrightunsigned(p ^ packed[i + 1], wide) = 0)), p -> int(p & low))"
        ),
    )
    stage = stage.withColumn(
        "named",
        F.expr("sort_array(transform(candidates, i -> struct(concat_ws(' ', words[i], words[i + 1], words[i + 2]) AS w, i AS i)))"),
    )
    stage = stage.withColumn(
        "at",
        F.expr(
            "sort_array(transform(filter(named, (p, i) -> (i > 0 AND p.w = named[i - 1].w)"
            " OR (i < size(named) - 1 AND p.w = named[i + 1].w)), p -> p.i))"
        ),
    )
    lines = F.expr(r"filter(split(text, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')")
    return stage.select(
        "doc_id", "text", "at", F.col("n").cast("long").alias("n_words"), lines.alias("lines"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
    ).select(
        "doc_id", "n_words", "word_chars",
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        # words covered by windows that start at the sorted positions ``at``
        F.expr(
            "aggregate(at, struct(0L AS n, -3 AS last),"
            " (s, p) -> struct(s.n + least(3, p - s.last) AS n, p AS last), s -> s.n)"
        ).alias("n_repeat_words"),
        F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace("text", "[^!?]+", "")).cast("long").alias("n_marks"),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measurements and ``fail_bits`` (long) of every row of ``docs``, written and read back."""
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(rule.sql), F.lit(BIT[rule.name]).cast("long")).otherwise(F.lit(0).cast("long")))
    return cut_lineage(_measured(docs).select("doc_id", *MEASURES, bits.alias("fail_bits")), "rule-ledger")


def passes(policy: str, bits: Column | str = "fail_bits") -> Column:
    """True where no rule of the policy failed."""
    bits = F.col(bits) if isinstance(bits, str) else bits
    return bits.bitwiseAND(F.lit(POLICIES[policy]).cast("long")) == 0


def ablation(book: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: ``n_failed`` documents and ``n_only``, those that only this rule rejects.

    There are at most 2**rules bit patterns, counted before anything moves.
    """
    patterns = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(POLICIES[policy]).cast("long")).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rules = F.array(
        *[F.struct(F.lit(r.name).alias("rule"), F.lit(BIT[r.name]).cast("long").alias("bit")) for r in RULES if BIT[r.name] & POLICIES[policy]]
    )
    failed = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (
        patterns.select("bits", "n", F.explode(rules).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(failed, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        )
    )
