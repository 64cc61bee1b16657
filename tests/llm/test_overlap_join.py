from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import awkward, nothing, small, small_docs  # noqa: F401
from medlattice.llm import overlap_join as o


def shingles(text: str | None, k: int = 5) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def brute(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) by comparison of all pairs of rows."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= 80 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    first: dict = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            first[find(i)] = min(doc_id, first.get(find(i), doc_id))
    return ordered((doc_id, len(sets[i]), first.get(find(i))) for i, (doc_id, _) in enumerate(rows))


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


def got(df):
    return ordered((r["doc_id"], r["n_shingles"], r["component_id"]) for r in o.components(df).collect())


def check(spark, rows, partitions=6):
    want = brute(rows)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)) == want
    return want


def edited(words, share, rng):
    n = round(share * len(words))
    at = rng.randrange(len(words) - n)
    return words[:at] + [f"new{rng.randrange(10**9)}" for _ in range(n)] + words[at + n :]


def test_near_copies_of_many_degrees(spark):
    rng, rows = random.Random(3), []
    for base in range(40):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(5, 400))]
        rows.append((100 * base, " ".join(words)))
        for j, share in enumerate((0.01, 0.04, 0.08, 0.09, 0.11, 0.13, 0.2), 1):
            rows.append((100 * base + j, " ".join(edited(words, share, rng))))
    want = check(spark, rows)
    assert 80 < len({r[2] for r in want}) < 280


def test_chains_families_and_a_common_passage(spark):
    """Families around one shared passage, members too far from each other for a link, and chains of links: the
    first hub of a list settles none of them."""
    rng, rows = random.Random(5), []
    passage = [f"s{i}" for i in range(150)]
    for family in range(12):
        own = [f"f{family}x{i}" for i in range(45)]
        rows += [(10 * family + j, " ".join(edited(passage + own, 0.01 * j, rng))) for j in range(5)]
    base = [f"b{i}" for i in range(200)]
    rows += [(1000 + i, " ".join(base[: 10 * i] + [f"c{i}y{j}" for j in range(18)] + base[10 * i + 18 :])) for i in range(18)]
    text = [f"d{i}" for i in range(300)]
    rows += [(2000 + i, " ".join(text[12 * i : 12 * i + 120])) for i in range(15)]
    rows += [(3000 + i, " ".join(passage)) for i in range(20)]
    check(spark, rows)


def test_crowd_of_copies(spark):
    """One group of near copies holds most rows: linear in its nodes, over more than one block of a query."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(edited(base, 0.02 * (i % 4), rng))) for i in range(400)] + [(900 + i, " ".join(base)) for i in range(50)]
    before = o.BLOCK
    o.BLOCK = 64
    try:
        want = check(spark, rows)
    finally:
        o.BLOCK = before
    assert len({r[2] for r in want}) < 200


def test_smallest_sets_at_the_threshold(spark):
    texts = ["a b c d e f g h", "a b c d e f g h i", "a b c d", "A B c d", "a b c", "a b c d e f g", "x y z", "x", "X", "a b c d e f g h i j"]
    check(spark, [(i, t) for i, t in enumerate(texts)], 2)


def test_long_lists_are_passed_on(spark):
    """Lists over the limit arrive in several batches and are not held."""
    before = o.LONG
    o.LONG = 8
    try:
        rng = random.Random(2)
        base = [f"w{i}" for i in range(40)]
        check(spark, [(i, " ".join(edited(base, 0.05 * (i % 3), rng))) for i in range(120)])
    finally:
        o.LONG = before


def test_supplied_texts(spark, small, small_docs):
    want = brute([(i, t) for i, t, _ in small])
    assert got(small_docs) == want and len({r[2] for r in want}) < len(want)


def test_awkward_and_empty(awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert got(awkward) == brute(rows)
    assert o.components(nothing).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), min_size=4, max_size=30, unique=True), min_size=1, max_size=25), st.lists(st.integers(0, 40), min_size=4, max_size=30, unique=True))
def test_divide_skip_equals_counting(others, query):
    query = np.array(sorted(query))
    sets = [(len(x), np.array(sorted(x))) for x in others]
    want = [(i, len(set(x) & set(query.tolist()))) for i, x in enumerate(others)]
    want = [(i, c) for i, c in want if 180 * c >= 80 * (len(others[i]) + len(query))]
    assert sorted(o.divide_skip(query, len(query), sets)) == want


@pytest.mark.parametrize("text", ["", "  ", "one", "A b\tC\nd  e f", "é É ß x y z w", "a" * 3000 + " b c d e f " + "a" * 3000])
def test_hashes_follow_the_words(text):
    raw = np.frombuffer((text + "b b" + text).encode(), np.uint8)
    n = len(text.encode())
    sets = o.shingle_sets(raw, np.array([0, n, n + 3, len(raw)]), 5)
    assert [len(s) for s in sets] == [len(shingles(text)), 1, len(shingles(text))] and (sets[0] == sets[2]).all()
