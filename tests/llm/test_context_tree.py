from __future__ import annotations

import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from llm_fixtures import awkward, nothing, small, small_docs  # noqa: F401
from medlattice.llm import context_tree as c


def sequential(train: list[bytes], test: list[bytes], depth: int) -> list[float]:
    """Textbook context-tree weighting: every node's block probabilities by recursion over its counts."""
    counts: Counter = Counter()

    def decisions(data: bytes):
        symbols = [c.END] * depth + list(data) + [c.END]
        for i in range(depth, len(symbols)):
            for t in range(8):
                prefix, bit = (1 << t) | (symbols[i] >> (8 - t)), (symbols[i] >> (7 - t)) & 1
                yield prefix, bit, tuple(symbols[i - d] for d in range(1, depth + 1))

    for data in train:
        for prefix, bit, context in decisions(data):
            for d in range(depth + 1):
                counts[prefix, context[:d], bit] += 1
    children: dict = {}
    for prefix, context, _ in counts:
        if context:
            children.setdefault((prefix, context[:-1]), set()).add(context)

    def estimate(a: int, b: int) -> float:
        p = 1.0
        for i in range(a):
            p *= (i + 0.5) / (i + 1)
        for i in range(b):
            p *= (i + 0.5) / (a + i + 1)
        return p

    memo: dict = {}

    def weighted(prefix: int, context: tuple, extra: tuple | None = None) -> float:
        """P_w of a node, with one more decision (bit, path) if ``extra`` is given."""
        key = (prefix, context)
        if extra is None and key in memo:
            return memo[key]
        a, b = counts[prefix, context, 0], counts[prefix, context, 1]
        if extra:
            a, b = a + (extra[0] == 0), b + (extra[0] == 1)
        out = estimate(a, b)
        if len(context) < depth:
            kids = set(children.get(key, ()))
            path = extra[1][: len(context) + 1] if extra else None
            rest = 1.0
            for kid in kids | ({path} if path else set()):
                rest *= weighted(prefix, kid, extra if kid == path else None)
            out = 0.5 * out + 0.5 * rest
        if extra is None:
            memo[key] = out
        return out

    return [sum(log10(weighted(p, (), (bit, path)) / weighted(p, ())) for p, bit, path in decisions(data)) for data in test]


TRAIN = ["abab abba", "abc", "", "b", "aab"]
TEST = ["abab", "", "zq", "ba b", "é"]


@pytest.mark.parametrize("block", [c.BLOCK, 12])
def test_scores_equal_the_sequential_definition(spark, monkeypatch, block):
    monkeypatch.setattr(c, "BLOCK", block)
    ids = [i for i in range(400)]
    train_ids = [i for i in ids if zlib.crc32(str(i).encode()) % 10]
    test_ids = [i for i in ids if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = list(zip(train_ids, TRAIN, strict=False)) + list(zip(test_ids, TEST, strict=False))
    got = {r["doc_id"]: r for r in c.scores(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), depth=3).collect()}
    want = sequential([t.encode() for t in TRAIN], [t.encode() for _, t in rows], 3)
    assert [got[i]["held_out"] for i, _ in rows] == [i in test_ids for i, _ in rows]
    np.testing.assert_allclose([got[i]["score"] for i, _ in rows], want, rtol=2e-6)


@pytest.mark.parametrize("frequent", [c.FREQUENT, 50])
def test_unigram_base(monkeypatch, small, small_docs, frequent):
    monkeypatch.setattr(c, "FREQUENT", frequent)
    tokens = {i: [*t.encode().lower().split(), b""] for i, t, _ in small}
    counts = Counter(w for i in tokens if zlib.crc32(str(i).encode()) % 10 for w in tokens[i])
    n, v = sum(counts.values()), len(counts)
    for r in c.scores(small_docs, depth=2).collect():
        own = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(w in counts for w in own), n)
        assert r["base_score"] == pytest.approx(sum(log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), rel=1e-9)


def test_held_out_texts_are_coded_better_than_by_bytes_alone(small_docs):
    rows = [r for r in c.scores(small_docs).collect() if r["held_out"]]
    assert rows and sum(r["bits_per_byte"] for r in rows) / len(rows) < 4


def test_awkward_and_empty(awkward, nothing):
    rows = c.scores(awkward).collect()
    assert len(rows) == awkward.count() and all(r["score"] < 0 for r in rows)
    assert all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (2, 3, 4))
    assert c.scores(nothing).count() == 0
    alone = c.scores(awkward.where("doc_id IS NULL")).collect()
    assert [r["base_score"] for r in alone] == pytest.approx([0.0] * 2) and all(r["n_known"] == 0 for r in alone)
