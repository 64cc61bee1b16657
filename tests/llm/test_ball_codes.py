from __future__ import annotations

import math
from hashlib import sha256

import numpy as np
import pytest

from medlattice.llm import ball_codes as b

VEC = "vec_id long, embedding array<float>, label int"
COLUMNS = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


def brute(rows, rounds=4, entries=256):
    """Plain k-means with Python integers, all entries compared for every part in every round."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    w = len(kept[0][1]) // 4
    books = [np.array([v[p * w : (p + 1) * w] for _, v, _ in kept[:entries]], dtype=np.int64) for p in range(4)]
    points = [np.array([v[p * w : (p + 1) * w] for _, v, _ in kept], dtype=np.int64) for p in range(4)]

    def assign():
        out = [((points[p][:, None, :] - books[p][None]) ** 2).sum(axis=2) for p in range(4)]
        return [(d.argmin(axis=1), d.min(axis=1)) for d in out]

    for _ in range(rounds):
        for p, (code, _) in enumerate(assign()):
            for e in set(code.tolist()):
                members = points[p][code == e]
                books[p][e] = [math.floor(int(s) / len(members)) if abs(int(s)) < 2**50 else int(s) // len(members) for s in members.sum(axis=0)]
    last = assign()
    error = [sum(int(last[p][1][i]) for p in range(4)) for i in range(len(kept))]
    by_label: dict = {}
    for (_, _, label), e in zip(kept, error, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    digest = sha256(",".join(str(x) for p in range(4) for x in books[p].ravel().tolist()).encode()).hexdigest()
    return [(r[0], "".join(f"{last[p][0][i]:02x}" for p in range(4)), error[i], by_label[r[2]], digest) for i, r in enumerate(kept)]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def got(df):
    return ordered(tuple(r[c] for c in COLUMNS) for r in b.codes(df).collect())


def test_supplied_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in docs.collect()]
    assert got(docs) == ordered(brute(rows))
    assert got(docs.repartition(13)) == ordered(brute(rows))


def test_clusters_ties_and_copies(spark):
    """Tight clusters (stable balls, cores), coordinates on a coarse grid (ties), and a third of all rows equal."""
    rng = np.random.default_rng(3)
    near = (rng.integers(-8, 8, (40, 8))[rng.integers(0, 40, 900)] + rng.normal(scale=0.05, size=(900, 8))).astype(np.float32)
    grid = rng.integers(-3, 4, (600, 8)).astype(np.float32) / 4
    rows = [(i, [float(x) for x in v], int(i % 3) if i % 7 else None) for i, v in enumerate([*near, *grid])]
    rows += [(2000 + i, [0.25] * 8, 1) for i in range(700)]
    assert got(spark.createDataFrame(rows, VEC).repartition(7)) == ordered(brute(rows))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2, 3, 4], 5), (1, [1.0, 2, 3, 4], 5), (2, None, 1), (3, [], 1), (4, [1.0, None, 2, 3], 1), (5, [nan, 1, 1, 1], 1), (6, [inf, 0, 0, 0], None),
            (None, [0.0, -0.0001, 0, 7], None), (7, [1.0, 2, 3], 2), (8, [1.0, 2, 3, 4, 5, 6, 7, 8], 2), (9, [-5.5, 2, -3, 4], None), (1, [0.5, 2, 3, 4], 6)]
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], label) for i, v, label in rows]
    docs = spark.createDataFrame([(*r, 3, [1], "x") for r in rows], VEC + ", v int, code array<int>, dist string")
    want = brute([r for r in rows if r[0] not in (7, 8)])
    assert got(docs) == ordered(want) and len(want) == 5
    assert b.codes(docs.where("vec_id = 2")).count() == 0 and b.codes(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        b.codes(docs.where("vec_id = 7"))


def test_exact_for_large_components():
    rng = np.random.default_rng(1)
    one, many = (rng.integers(-(b.LIMIT - 1), b.LIMIT, (n, 16)) for n in (20, 30))
    want = [[sum((int(x) - int(y)) ** 2 for x, y in zip(p, q, strict=True)) for q in many] for p in one]
    assert b.squared(one, many).tolist() == want
    small = one % 100, many % 100
    assert b.squared(*small).tolist() == [[int(((p - q) ** 2).sum()) for q in small[1]] for p in small[0]]


def test_balls_skip_most_of_the_work():
    """On separated clusters most points meet no other entry, and none is lost."""
    rng = np.random.default_rng(2)
    centers = rng.integers(-4000, 4000, (60, 4))
    points = centers[rng.integers(0, 60, 5000)] + rng.integers(-40, 40, (5000, 4))
    code, dist = b.nearest(points, centers, np.arange(60))
    moved = centers + rng.integers(-5, 6, centers.shape)
    moved[:20] = centers[:20]
    radius = np.array([dist[code == i].max(initial=-1) for i in range(60)])
    space = b.balls(moved, centers, radius)
    assert 0 < space.stable.sum() < 60 and np.mean([len(n) for n in space.near]) < 5
    want = b.nearest(points, moved, np.arange(60))
    have = b.reassigned(points, code, dist, space)
    assert (want[0] == have[0]).all() and (want[1] == have[1]).all()
