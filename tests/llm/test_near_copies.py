from __future__ import annotations

import random

from llm_fixtures import awkward, nothing, small, small_docs  # noqa: F401
from medlattice.llm import near_copies
from test_simhash import slow_fingerprint

import corpus_pipeline as p


def shingles(text: str | None, k: int = 5) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def similarity(a: frozenset, b: frozenset) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def survivors(rows: list[tuple[int, str]]) -> set[int]:
    """Smallest id of each component of the pairs at 0.8 or more, by comparison of all pairs."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * min(len(a), len(sets[j])) >= 4 * max(len(a), len(sets[j])) and similarity(a, sets[j]) >= 0.8:
                root[find(i)] = find(j)
    first: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(rows):
        first[find(i)] = min(doc_id, first.get(find(i), doc_id))
    return set(first.values())


def edited(words: list[str], share: float, rng: random.Random) -> list[str]:
    """One passage of the words replaced."""
    n = round(share * len(words))
    at = rng.randrange(len(words) - n)
    return words[:at] + [f"new{rng.randrange(10**9)}" for _ in range(n)] + words[at + n :]


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"] for r in p.near_duplicates(spark, docs, "").collect()}


def test_exact_similarity_decides(spark):
    rng, rows = random.Random(3), []
    for base in range(40):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(150, 400))]
        rows.append((100 * base, " ".join(words)))
        for j, share in enumerate((0.01, 0.04, 0.08, 0.09, 0.11, 0.13, 0.2), 1):
            rows.append((100 * base + j, " ".join(edited(words, share, rng))))
    want = survivors(rows)
    assert kept(spark, rows) == want and len(want) > 80
    # most pairs that have to link are beyond four bits of one fingerprint
    near = [(rows[i][1], rows[i + 2][1]) for i in range(0, len(rows), 8)]
    assert all(similarity(shingles(a), shingles(b)) >= 0.8 for a, b in near)
    far = sum((slow_fingerprint(a, 5) ^ slow_fingerprint(b, 5)).bit_count() > 4 for a, b in near)
    assert far > len(near) // 2


def test_chain_and_close_pair_below_the_threshold(spark):
    words = [f"w{i}" for i in range(104)]
    # 100 shingles each; 88 in common: 0.786. 89 in common: 0.802
    below = words[:92] + [f"x{i}" for i in range(12)]
    above = words[:93] + [f"y{i}" for i in range(11)]
    assert similarity(shingles(" ".join(words)), shingles(" ".join(below))) < 0.8 < similarity(shingles(" ".join(words)), shingles(" ".join(above)))
    assert kept(spark, [(1, " ".join(words)), (2, " ".join(below))]) == {1, 2}
    assert kept(spark, [(1, " ".join(words)), (2, " ".join(above))]) == {1}


def test_one_hub_does_not_settle_a_cell(spark):
    """Families around one shared passage: below 0.8 between them, so cells hold several components."""
    rng, rows = random.Random(5), []
    shared = [f"s{i}" for i in range(150)]
    for family in range(12):
        own = [f"f{family}x{i}" for i in range(45)]
        rows += [(10 * family + j, " ".join(edited(shared + own, 0.01 * j, rng))) for j in range(5)]
    assert kept(spark, rows) == survivors(rows)


def test_candidates_come_through_manhattan_bound_and_exact_distance(spark):
    """Prints of whole texts meet at 4 bits, those of a band at 1; equal popcounts of other bits are no candidates."""
    base = 0x1234567812345678
    whole = {1: base, 2: base ^ 0xF0, 3: base ^ 0xFF0, 4: base ^ 0x1F << 40, 5: 0x5555555555555555, 6: 0x55555555555555AA}
    first = {1: 7, 2: 6, 3: 4 << 30, 4: 7 << 40, 5: 0x5555, 6: 0x555A}
    second = {1: 6, 2: 9 << 50, 3: 9 << 40, 4: 8 << 30, 5: 9 << 20, 6: 9 << 10}
    rows = [(node, 10, band, fp) for band, prints in enumerate((whole, first, second)) for node, fp in prints.items()]
    got: dict[int, set[int]] = {}
    for r in near_copies.classes(spark.createDataFrame(rows, "node long, n long, band int, fp long")).collect():
        got.setdefault(r["token"], set()).add(r["node"])
    # 1 and 3 are connected by 2; 4 is five bits from 1; 5 and 6 have the same counts at eight and four bits
    assert sorted(map(sorted, got.values())) == sorted([[1, 2, 3], [4], [5], [6], [1, 2], [3], [4], [5], [6], *([i] for i in range(1, 7))])


def test_supplied_texts(spark, small, small_docs):
    want = survivors([(i, t) for i, t, _ in small])
    assert {r["doc_id"] for r in p.near_duplicates(spark, small_docs, "").collect()} == want and len(want) < len(small)


def test_awkward_and_empty(spark, awkward, nothing):
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in near_copies.components(awkward, 5).collect())
    assert got == [(0, 1), (0, 2), (1, 1), (1, 1), (2, 2), (3, 2), (4, 2), (5, 5), (6, 5), (7, 7), (8, 8), (9, 9), (10, 1)]
    assert sorted(r["doc_id"] for r in near_copies.deduplicated(awkward, 5).collect()) == [1, 2, 5, 7, 8, 9]
    assert near_copies.deduplicated(nothing, 5).count() == 0
