from __future__ import annotations

from collections import defaultdict

import pytest

from llm_fixtures import awkward, nothing, small, small_docs  # noqa: F401
from medlattice.llm import mixing as m


def test_targets():
    got = m.targets({"b": 1000, "a": 100, None: 50, "c": 850})
    # a (weight 5), b (2), c (1) and null (5) share 3000; a and null stop at 200 and 100, then b at 2000
    assert got == pytest.approx({"a": 200.0, None: 100.0, "b": 2 * (3000 - 300) / 3, "c": (3000 - 300) / 3})
    assert m.targets({}) == {} and m.targets({"a": 0, "b": 10}) == pytest.approx({"a": 0.0, "b": 15.0})


def slow_pivot(rows):
    """The exchange, worded plainly: exact fractions, one pair after another."""
    from fractions import Fraction

    rows = sorted(rows, key=lambda r: (-r[1], r[0]))
    values = {h: Fraction(f) for h, _, f in rows}
    size = {h: s for h, s, _ in rows}
    held = None
    for h, _, _ in rows:
        if not 0 < values[h] < 1:
            continue
        if held is None:
            held = h
            continue
        ratio = Fraction(size[h], size[held])
        up, down = min(1 - values[held], values[h] * ratio), min(values[held], (1 - values[h]) * ratio)
        draw = Fraction(m.draw(0, held, h))
        move = up if draw * (up + down) < down else -down
        values[held] += move
        values[h] -= move / ratio
        if values[held] in (0, 1):
            held = h if 0 < values[h] < 1 else None
    return values


def test_pivot_keeps_the_sum_and_leaves_one_open():
    rows = sorted([(1 + 7919 * i, 3 + (i * i) % 50, 0.3) for i in range(200)], key=lambda r: (-r[1], r[0]))
    h, size, fraction = (list(c) for c in zip(*rows, strict=True))
    out = m.pivot(size, h, fraction, 0, last=False)
    assert sum(f * s for f, s in zip(out, size, strict=True)) == pytest.approx(sum(s * f for _, s, f in rows))
    assert sum(0 < f < 1 for f in out) <= 1
    assert dict(zip(h, out, strict=True)) == pytest.approx({k: float(v) for k, v in slow_pivot(rows).items()})
    assert set(m.pivot(size, h, fraction, 0, last=True)) == {0.0, 1.0}


def test_rounding_keeps_expectations():
    share = [0.5, 0.25, 0.75, 0.4]
    runs = [m.pivot([5, 4, 3, 2], [seed * 977 + i * 131 for i in range(4)], share, 0, last=True) for seed in range(4000)]
    assert [sum(c) / len(runs) for c in zip(*runs, strict=True)] == pytest.approx(share, abs=0.04)


@pytest.mark.parametrize("bucket,fan_in", [(m.BUCKET, m.FAN_IN), (10, 2)])
def test_sources_meet_their_targets(small, small_docs, monkeypatch, bucket, fan_in):
    monkeypatch.setattr(m, "BUCKET", bucket)
    monkeypatch.setattr(m, "FAN_IN", fan_in)
    rows = m.mixed(small_docs).collect()
    sizes = defaultdict(int)
    for _, text, source in small:
        sizes[source] += len(text.encode().split())
    target = m.targets(dict(sizes))
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]]) and 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert len(rows) == len(small)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)
    again = m.mixed(small_docs.repartition(5)).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_awkward_and_empty(awkward, nothing):
    rows = m.mixed(awkward).collect()
    assert len(rows) == awkward.count() and all(r["copies"] * r["size"] == 0 for r in rows if r["size"] == 0)
    assert m.mixed(nothing).count() == 0 and m.with_copies(nothing).count() == 0
    taken = m.with_copies(awkward)
    assert taken.columns == [c for c in awkward.columns if c != "copies"] + ["copies"]
    assert taken.agg({"copies": "sum"}).first()[0] == sum(r["copies"] for r in rows)
