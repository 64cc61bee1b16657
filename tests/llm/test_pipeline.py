from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from llm_fixtures import awkward, nothing  # noqa: F401
from medlattice.llm import contamination, mixing, secret_scan
from test_near_copies import survivors
from test_secret_scan import brute as secret_brute

import corpus_pipeline as p

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first and after each stage, written and reread as the driver does."""
    root, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for i, (_name, stage) in enumerate(p.STAGES):
        stage(spark, docs, SF).write.parquet(str(root / str(i)))
        docs = spark.read.parquet(str(root / str(i)))
        out.append(docs)
    return out


def test_columns(stages):
    assert all(d.columns == stages[0].columns for d in stages[:-1])
    assert stages[-1].columns == [*stages[0].columns, "copies"]


def test_quality_keeps_the_labelled_good_and_drops_the_bad(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet").join(stages[0], "doc_id").select("doc_id", "quality")
    kept = {r["doc_id"] for r in stages[1].collect()}
    rows = labels.collect()
    right = sum((r["doc_id"] in kept) == (r["quality"] == 1) for r in rows)
    assert right >= 0.95 * len(rows)


def test_one_of_each_group_stays(stages):
    """Groups are those of all pairs with an exact similarity of 0.8 or more of their five-word shingles."""
    before = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    want = survivors(before)
    assert {r["doc_id"] for r in stages[2].collect()} == want and len(want) < len(before)


def test_no_item_is_left(spark, stages):
    items = [contamination.tokens(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def leaks(text):
        words = contamination.tokens(text)
        for item in items:
            k = min(5, len(item))
            wanted = {tuple(item[i : i + k]) for i in range(len(item) - k + 1)}
            held = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
            if len(wanted & held) >= 0.8 * len(wanted):
                return True
        return False

    before, after = stages[2].collect(), {r["doc_id"] for r in stages[3].collect()}
    assert after == {r["doc_id"] for r in before if not leaks(r["text"])}


def test_secrets_are_gone_and_nothing_else(stages):
    before = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    after = {r["doc_id"]: r for r in stages[4].collect()}
    assert set(before) == set(after)
    for i, text in before.items():
        assert secret_brute(after[i]["text"]) == "" and after[i]["n_chars"] == len(after[i]["text"])
        assert secret_brute(text) or after[i]["text"] == text
    kinds = "|".join(rule.kind for rule in secret_scan.RULES)
    assert all(re.sub(rf"\[({kinds})\]", "", r["text"]) is not None for r in after.values())


def test_mix(stages):
    taken = {r["doc_id"]: r["copies"] for r in stages[5].collect()}
    want = {r["doc_id"]: r["copies"] for r in mixing.mixed(stages[4]).collect() if r["copies"]}
    assert taken == want and max(taken.values()) <= 2


def test_run_equals_the_stages(spark, stages):
    got = contract.queries()["pipeline"](spark, SF)
    assert sorted(map(str, got.collect())) == sorted(map(str, stages[-1].collect()))


def test_awkward_and_empty(spark, awkward, nothing):
    docs = awkward
    for _, stage in p.STAGES:
        out = stage(spark, docs, SF)
        assert set(docs.columns) <= set(out.columns) and out.count() <= docs.count()
        assert stage(spark, nothing, SF).count() == 0
    assert p.secrets(spark, docs, SF).where(F.col("text").isNull()).count() == 2
