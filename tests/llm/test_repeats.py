from __future__ import annotations

import random
from collections import Counter
from hashlib import sha256

import pytest

from llm_fixtures import awkward, nothing, small, small_docs  # noqa: F401
from medlattice.llm import repeats as r

L = r.LENGTH


def brute(texts: list[str | None]):
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + L] for d in data for i in range(len(d) - L + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - L + 1):
            if counts[d[i : i + L]] > 1:
                gone[i : i + L] = b"\1" * L
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, sha256(bytes(b for b, g in zip(d, gone, strict=True) if not g)).hexdigest()))
    return out


def got(docs):
    return sorted(tuple(x) for x in r.removed(docs).select("n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


def noise(rng, n: int, letters: str = "abcdefgh é") -> str:
    return "".join(rng.choices(letters, k=n))


@pytest.fixture(scope="module")
def hard():
    """Passages of lengths around the limit, at varied places, nested, chained, overlapping themselves, and periodic."""
    rng = random.Random(4)
    passage = noise(rng, 2500)
    texts: list[str | None] = [None, "", "short", "a" * 399, "a" * 400, "b" * 401, "ab" * 700, "xyz" * 450 + noise(rng, 300), noise(rng, 3000)]
    for n in (350, 380, 398, 399, 400, 401, 402, 450, 599, 600, 601, 799, 1200):
        for _ in range(2):
            at = rng.randrange(0, len(passage) - n)
            texts.append(noise(rng, rng.randrange(0, 700)) + passage[at : at + n] + noise(rng, rng.randrange(0, 700)))
    for n in (395, 400, 405):
        piece = noise(rng, n, "pqrstuvw")
        texts += [piece + noise(rng, 100), noise(rng, 100) + piece, noise(rng, 50) + piece + noise(rng, 50)]
    piece = noise(rng, 520, "ABCDEFG")
    texts += [piece + "1" + piece[:450], noise(rng, 10) + piece[40:] + "2", piece[60:500]]
    texts += [texts[8], texts[8][:2000], texts[8][1000:]]
    shared = noise(rng, 700, "mnopqr")
    texts += [noise(rng, 300) + shared + noise(rng, 300) for _ in range(40)]
    return texts


@pytest.mark.parametrize("limit", [r.CLASS, 1, 3])
def test_equals_brute_force(spark, hard, limit, monkeypatch):
    # from few contexts on, cores go down the path of crowded ones
    monkeypatch.setattr(r, "CLASS", limit)
    docs = spark.createDataFrame(list(enumerate(hard)), "doc_id long, text string")
    assert got(docs) == sorted(brute(hard))


@pytest.mark.parametrize("limit", [r.CLASS, 3])
def test_groups_hold_all_occurrences(spark, hard, limit, monkeypatch):
    monkeypatch.setattr(r, "CLASS", limit)
    data = [(t or "").encode() for t in hard]
    groups: dict[int, set[tuple[int, int, int]]] = {}
    for row in r.groups(spark.createDataFrame(list(enumerate(hard)), "doc_id long, text string")).collect():
        groups.setdefault(row["grp"], set()).add((row["doc_id"], row["lo"], row["hi"]))
    for places in groups.values():
        assert len(places) > 1 and len({data[d][lo:hi] for d, lo, hi in places}) == 1
    # each repeated window has a group that covers every place of it at the same offset
    where: dict[bytes, set[tuple[int, int]]] = {}
    for d, text in enumerate(data):
        for i in range(len(text) - L + 1):
            where.setdefault(text[i : i + L], set()).add((d, i))
    covered: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for name, places in groups.items():
        for d, lo, hi in places:
            for i in range(lo, hi - L + 1):
                covered.setdefault((d, i), []).append((name, i - lo))
    for places in where.values():
        if len(places) > 1:
            shared = set.intersection(*[set(covered.get(p, [])) for p in places])
            assert shared


def test_supplied_texts(small, small_docs):
    assert got(small_docs) == sorted(brute([t for _, t, _ in small]))


def test_intervals_and_groups():
    words = sorted([b"banana", b"banner", b"ban", b"bandana", b"apple", b"appl"])
    lcp = [r.common_prefix(a, b) for a, b in zip(words, words[1:], strict=False)]
    found = set(r.intervals(lcp))
    for length, first, last in found:
        assert min(lcp[first:last]) == length
        assert (first == 0 or lcp[first - 1] < length) and (last == len(words) - 1 or lcp[last] < length)
    assert (4, 0, 1) in found and (3, 2, 5) in found and len(found) == 3
    rng = random.Random(1)
    core, right, left = noise(rng, 200, "ab").encode(), noise(rng, 150, "ab").encode(), noise(rng, 150, "ab").encode()
    contexts = [(b"x" + left, core + right + b"1"), (b"y" + left, core + right + b"2"), (b"z" + left[100:], core + right + b"3"), (b"w", core + b"4")]
    groups = {(a, b, tuple(sorted(m))) for a, b, m in r.maximal_groups(contexts)}
    assert groups == {(150, 350, (0, 1)), (50, 350, (0, 1, 2))}


def test_awkward_and_empty(awkward, nothing):
    rows = awkward.select("text").collect()
    assert got(awkward) == sorted(brute([x["text"] for x in rows]))
    assert r.removed(nothing).count() == 0
    twice = awkward.where("doc_id = 5").unionByName(awkward.where("doc_id = 5"))
    assert all(x["n_removed"] == x["n_bytes"] for x in r.removed(twice).collect())


def test_kept_texts_and_spans(spark):
    """What is left comes back as text, with the spans that were cut, also where a span begins or ends inside a character."""
    rng = random.Random(8)
    shared = noise(rng, 500, "mnopqr é")
    # é (c3 a9) and è (c3 a8) share their first byte, which the repeat takes along
    texts = ["own words " + shared + "é tail", "other words " + shared + "è tail", "before\x82" + shared, None, "", "kept as it is, é 😀", shared[:150]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept, spans = {}, {}
    for row in r.without_repeats(docs).collect():
        data = (texts[row["doc_id"]] or "").encode()
        gone = {i for lo, hi in row["spans"] for i in range(lo, hi)}
        kept[row["doc_id"]], spans[row["doc_id"]] = bytes(row["kept"]), row["spans"]
        assert bytes(b for i, b in enumerate(data) if i not in gone) == row["kept"] and len(data) == row["n_bytes"]
    assert sorted((len((texts[d] or "").encode()), sum(hi - lo for lo, hi in spans[d]), len(spans[d]), sha256(kept[d]).hexdigest()) for d in kept) == sorted(brute(texts))
    found = {x["doc_id"]: x["kept_text"] for x in r.removed(docs).collect()}
    assert found == {d: k.decode(errors="replace") for d, k in kept.items()}
    assert [found[d] for d in (3, 4, 5, 6)] == ["", "", texts[5], texts[6]]
    assert "\ufffd" in found[0] and "\ufffd" in found[1] and found[2] == "before\x82"
