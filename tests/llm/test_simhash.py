from __future__ import annotations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_fixtures import awkward, nothing, small, small_docs  # noqa: F401
from medlattice.llm import simhash as s


def slow_fingerprint(text: str | None, k: int = 4) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(points: list[int], radius: int) -> dict[int, int]:
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(points):
        for b in points[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in points}


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints(small, small_docs, awkward):
    got = {r["doc_id"]: r["fp"] for r in s.with_fingerprint(small_docs).collect()}
    assert got == {i: signed(slow_fingerprint(t)) for i, t, _ in small}
    rows = awkward.select("doc_id", "text").collect()
    assert sorted(r["fp"] for r in s.with_fingerprint(awkward).collect()) == sorted(signed(slow_fingerprint(r["text"])) for r in rows)


def test_same_hash_as_the_engine(spark):
    row = spark.createDataFrame([("a b c d",), ("é",)], "t string").select(F.xxhash64("t").alias("h")).collect()
    assert [r["h"] for r in row] == [signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t in ("a b c d", "é")]


@pytest.fixture(scope="module")
def crowd():
    """Chains and balls of fingerprints around a few centres, and random ones."""
    rng = np.random.default_rng(5)
    out = {int(x) for x in rng.integers(0, 1 << 63, 60)}
    for _ in range(3):
        p = int(rng.integers(0, 1 << 63))
        for _ in range(60):
            q = p
            for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
                q ^= 1 << int(b)
            out.add(q)
            p = q if rng.random() < 0.3 else p
    return sorted(out | {0, 1, (1 << 64) - 1, 15, 31})


@pytest.mark.parametrize("limit", [s.CELL, 3])
def test_links_connect_exactly(spark, crowd, limit):
    points = spark.createDataFrame([(signed(p),) for p in crowd], "fp long")
    got = {r["node"]: r["root"] for r in s.roots(s.links(points, limit=limit)).collect()}
    want = slow_components(crowd, 4)
    ours: dict[int, set[int]] = {}
    theirs: dict[int, set[int]] = {}
    for p in crowd:
        ours.setdefault(got.get(signed(p), signed(p)), set()).add(p)
        theirs.setdefault(want[p], set()).add(p)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


@pytest.mark.parametrize("limit", [s.CELL, 3])
@pytest.mark.parametrize(("radius", "groups"), [(4, 8), (1, 2)])
def test_bands_do_not_meet(spark, crowd, limit, radius, groups):
    near = sorted({p ^ 1 << b for p in crowd for b in (0, 33)} | set(crowd))
    bands = [near[::2], near[1::2], crowd]
    rows = [(band, signed(p)) for band, points in enumerate(bands) for p in points]
    got: dict[int, set[int]] = {}
    for edge in s.links(spark.createDataFrame(rows, "band int, fp long"), radius, limit, groups).collect():
        got.setdefault(edge["a"], set()).add(edge["b"])
    # each class of a band is connected by its own edges, and no edge leaves a band
    of = [{signed(p) for p in points} for points in bands]
    assert all(any(a in b and x in b for b in of) for a, found in got.items() for x in found)
    for points in bands:
        rooted = {r["node"]: r["root"] for r in s.roots(s.links(spark.createDataFrame([(signed(p),) for p in points], "fp long"), radius, limit, groups)).collect()}
        ours: dict[int, set[int]] = {}
        theirs: dict[int, set[int]] = {}
        for p, root in slow_components(points, radius).items():
            ours.setdefault(rooted.get(signed(p), signed(p)), set()).add(p)
            theirs.setdefault(root, set()).add(p)
        assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_manhattan_is_a_lower_bound(crowd):
    many = np.array(crowd, np.uint64)
    for one in many[:50]:
        near = np.flatnonzero(np.bitwise_count(many ^ one) <= 4)
        assert list(s._linked(one, many, 4)) == list(near)


def test_components(small, small_docs):
    prints = {i: slow_fingerprint(t) for i, t, _ in small}
    root = slow_components(sorted(set(prints.values())), 4)
    first: dict[int, int] = {}
    for i, p in prints.items():
        first[root[p]] = min(i, first.get(root[p], i))
    got = {r["doc_id"]: r["component_id"] for r in s.components(small_docs).collect()}
    assert got == {i: first[root[p]] for i, p in prints.items()}
    kept = {r["doc_id"] for r in s.deduplicated(small_docs, k=4).collect()}
    assert kept == set(got.values())


def test_awkward_and_empty(awkward, nothing):
    got = {(r["doc_id"], r["component_id"]) for r in s.components(awkward).collect()}
    assert {(1, 1), (10, 1), (None, 1), (2, 2), (3, 2), (4, 2), (None, 2), (5, 5), (6, 5)} <= got
    assert s.components(awkward).count() == awkward.count() and s.components(nothing).count() == 0
    once = s.deduplicated(awkward, k=4)
    assert once.columns == awkward.columns
    assert sorted(r["doc_id"] for r in once.collect()) == sorted({c for _, c in got})
    lost = awkward.where("doc_id IS NULL").select("doc_id", "text")
    assert s.deduplicated(lost).count() == 2 and s.deduplicated(nothing).count() == 0
