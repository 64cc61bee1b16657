from __future__ import annotations

import re
import time

import pytest
from pyspark.sql import functions as F

from llm_fixtures import awkward, nothing, small, small_docs  # noqa: F401
from medlattice.llm import secret_scan as s

TEXTS = [
    'token=secret: "abcdefghijklmnop" x', "password=abcdefghijkl", "PassWord' : 'abcdefghijklmnop", "api_key=0123456789abcdef0123", "AKIA" + "A" * 13,
    "AKIA" + "B" * 14 + "é AKIAAKIA" + "C" * 20, "deadbeef" * 3 + "g" + "0" * 15 + "h" + "f" * 16, "é😀 token = \"" + "a1" * 12 + "\" end",
    "secret=short secret=longenoughvalue", "ghp_" + "a" * 36, "xoxb-1234567890-abc", "-----BEGIN RSA PRIVATE KEY-----", "nothing here", "apikey:   abcabcabcabc.",
    "eyJabcdefghij0.eyJabcdefghij0.sig", "", None, "password=\n0123456789abc", "apiKey=" + "z" * 12 + "\ntoken:" + "9" * 12,
]


def brute(text: str | None):
    found = []
    for number, rule in enumerate(s.RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), number, rule.kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def base_brute(text: str | None):
    """The base scan as worded: match runs in full, then drop the short ones."""
    found = []
    for number, (kind, pattern, group, least) in enumerate((
        ("assign", s.RULES[0].pattern, 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16)
    )):
        found += [(m.start(), number, kind, m.end()) for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(0, "x " + TEXTS[1])], "doc_id long, text string")


def test_spans_equal_brute_force(docs):
    got = sorted((r["doc_id"], r["base_spans"], r["spans"]) for r in s.spans(docs).collect())
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, "x " + TEXTS[1])]
    assert got == sorted((i, base_brute(t), brute(t)) for i, t in rows)
    assert any("hex" in b for _, b, _ in got) and any("repository_token" in x for _, _, x in got)


def test_without_broadcast(docs, monkeypatch):
    monkeypatch.setattr(s, "BROADCAST_ROWS", 0)
    assert sorted(r["spans"] for r in s.spans(docs).collect()) == sorted(brute(t) for t in [*TEXTS, "x " + TEXTS[1]])


def test_supplied_texts(small, small_docs):
    got = {r["doc_id"]: (r["base_spans"], r["spans"]) for r in s.spans(small_docs).collect()}
    assert got == {i: (base_brute(t), brute(t)) for i, t, _ in small}


def test_queries_are_mandatory():
    import random

    rng = random.Random(3)
    assert s.trigram_query("[0-9a-f]{16,}") == ()
    assert s.trigram_query("AKIA[A-Z0-9]{14,}") == ((frozenset(("aki", "kia")),),)
    samples = {"assign": ["PASSWORD: x", "api_KEY=1", "apikey = 'q"], "chat_token": ["xoxp-aaaaaaaaaaaa"], "signed_token": [TEXTS[14]]}
    for rule in s.RULES:
        for text in samples.get(rule.kind, []):
            low = ("".join(rng.choices("abc ", k=5)) + text).lower()
            assert re.search(rule.pattern, text)
            assert all(any(all(g in low for g in grams) for grams in clause) for clause in s.trigram_query(rule.pattern))


def test_redacted(docs):
    got = {r["doc_id"]: r["text"] for r in s.redacted(docs.where("doc_id > 0")).collect()}
    assert got[1] == "[assign]" and got[12] == "nothing here" and got[16] is None
    assert not any(re.search("[0-9a-f]{16}", t or "") for t in got.values())


def test_awkward_and_empty(awkward, nothing):
    assert s.spans(awkward).count() == awkward.count() and s.spans(nothing).count() == 0
    assert s.redacted(awkward).columns == awkward.columns
    assert s.redacted(awkward).where(F.col("text").isNull()).count() == 2


def test_many_matches_take_time_in_proportion(spark):
    text = "".join(f"password = abcdefghijklmnop{i}\n" for i in range(20_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    started = time.perf_counter()
    found, clean = s.spans(docs).first(), s.redacted(docs).first()["text"]
    assert found["n_assign"] == 20_000 and clean == "[assign]\n" * 20_000
    first, last = found["spans"].split(",")[0], found["spans"].split(",")[-1]
    assert first == "assign:0:28" and last.endswith(f":{len(text) - 1}")
    assert time.perf_counter() - started < 90
