from __future__ import annotations

import re
import time
import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from llm_fixtures import awkward, nothing, small, small_docs  # noqa: F401
from medlattice.llm import quality_classifier as q
from medlattice.llm import quality_rules as r

SF = "/root/testdata/sf0.001"


def measured(text: str | None):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + j for i, w in enumerate(windows) if w in often for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered),
        sum(unicodedata.category(c) == "Lu" for c in text), len(re.findall("[!?]", text)),
    )


def test_ledger_equals_brute_force(spark, small, small_docs, awkward):
    more = spark.createDataFrame([(900, "a b c a b c a b c d"), (901, "x y z\nx y z"), (902, "a a a a"), (903, "é é é | é é é")], "doc_id long, text string")
    for docs in (small_docs, awkward, more):
        texts = [row["text"] for row in docs.collect()]
        got = sorted(tuple(x[m] for m in r.MEASURES) for x in r.ledger(docs).collect())
        assert got == sorted(map(measured, texts))


def test_policies_and_ablation(small_docs):
    book = r.ledger(small_docs)
    bits = [x["fail_bits"] for x in book.collect()]
    for policy, mask in r.POLICIES.items():
        assert book.where(r.passes(policy)).count() == sum(not b & mask for b in bits)
        got = {x["rule"]: (x["n_failed"], x["n_only"]) for x in r.ablation(book, policy).collect()}
        assert got == {n: (sum(bool(b & v) for b in bits), sum(b & mask == v for b in bits)) for n, v in r.BIT.items() if v & mask}


def test_applying_policies_takes_no_measurement_again(spark):
    """Filter, ablation and join read the stored ledger: together they take less time than the ledger itself."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    started = time.perf_counter()
    book = r.ledger(docs)
    made = time.perf_counter() - started
    started = time.perf_counter()
    kept = book.where(r.passes("v1"))
    assert docs.join(kept, "doc_id", "left_semi").count() == kept.count()
    assert r.ablation(book, "v1").count() == len(r.RULES)
    assert time.perf_counter() - started < max(20.0, 3 * made)
    assert not any("split(" in x for x in kept._jdf.queryExecution().executedPlan().toString().splitlines())


def test_empty_ledger(nothing):
    assert r.ledger(nothing).count() == 0 and r.ablation(r.ledger(nothing), "v1").count() == 0


def test_boosting_learns_and_flat_trees_agree():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(3000, 5))
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 2] < -0.2)).astype(float)
    trees = q.boost(rows[:2000], labels[:2000], trees=30)
    assert ((trees.probability(rows[2000:]) > 0.5) == labels[2000:]).mean() > 0.97

    def walk(x):
        margin = trees.base
        for feature, limit, value in zip(trees.feature, trees.limit, trees.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if x[feature[node]] > limit[node] else 1)
            margin += value[node - len(feature)]
        return margin

    assert np.allclose(trees.margin(rows[:100]), [walk(x) for x in rows[:100]])


def test_held_out_quality(spark, small_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    stats = q.measured(docs)
    trees = q.train(stats, labels)
    scored = q.scored(stats, trees).join(labels, "doc_id").where(q.remainder(F.col("doc_id"), 5) == 0).collect()
    assert len(scored) > 50 and sum(x["predicted"] == x["quality"] for x in scored) >= 0.95 * len(scored)
    again = q.train(q.measured(docs.repartition(7)), labels)
    assert np.array_equal(trees.value, again.value)
    assert q.accepted(docs, trees).count() == q.scored(stats, trees).where("predicted = 1").count()


def test_without_labels(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    stats = q.measured(awkward)
    rows = q.scored(stats, q.train(stats, none)).collect()
    assert len(rows) == awkward.count() and {x["score"] for x in rows} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(11)] + [(None, 0), (3, None)], "doc_id long, quality int")
    assert {x["predicted"] for x in q.scored(stats, q.train(stats, one)).collect()} == {1}
    assert q.scored(q.measured(nothing), q.train(stats, one)).count() == 0
    assert q.accepted(awkward, q.train(stats, one)).columns == awkward.columns
