from __future__ import annotations

import random

from llm_fixtures import awkward, nothing, small_docs  # noqa: F401
from medlattice.llm import contamination as c


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        words = c.tokens(text)
        for item_id, item in items:
            w = c.tokens(item)
            k = min(5, len(w))
            wanted = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
            held = wanted & {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
            if wanted and len(held) >= 0.8 * len(wanted):
                out.append((doc_id, item_id, len(held), len(wanted)))
    return sorted(out, key=str)


def made():
    rng = random.Random(8)

    def prose(n):
        return " ".join("".join(rng.choices("aeioulmnrst", k=rng.randint(2, 7))) for _ in range(n))

    items = [(i, prose(n)) for i, n in enumerate((1, 2, 4, 5, 6, 9, 14, 20, 21, 36, 37, 68, 69, 70, 150, 400))] + [(99, None), (98, ""), (None, prose(30))]
    items.append((50, items[9][1]))
    docs = []
    for i, (_, item) in enumerate(items):
        words = (item or "").split()
        for cut in (0, 1, len(words) // 8, len(words) // 2):
            part = words[cut:] if i % 2 else words[: len(words) - cut]
            body = [*prose(rng.randint(0, 3000)).split(), *part, *prose(rng.randint(0, 900)).split()]
            docs.append((len(docs), " ".join(body).upper() if i % 3 == 0 else " , ".join(body)))
        if len(words) > 30:
            docs.append((len(docs), prose(40) + " " + " ".join(words[:15] + [prose(1)] + words[15:]) + " " + prose(40)))
    return docs + [(None, items[7][1]), (7000, None), (7001, "")], items


def test_equals_brute_force(spark):
    docs, items = made()
    got = c.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = brute(docs, items)
    assert sorted(map(tuple, got.collect()), key=str) == want and len(want) > 40


def test_blocks(spark, monkeypatch):
    docs, items = made()
    monkeypatch.setattr(c, "BLOCK", 800)
    got = c.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_supplied_texts(spark, small_docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = [(r["doc_id"], r["text"]) for r in small_docs.collect()]
    want = brute(docs, [(r["item_id"], r["text"]) for r in items.collect()])
    assert sorted(map(tuple, c.matches(small_docs, items).collect()), key=str) == want
    kept = {r["doc_id"] for r in c.clean(small_docs, items).collect()}
    assert kept == {i for i, _ in docs} - {w[0] for w in want}


def test_awkward_and_empty(spark, awkward, nothing):
    items = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, None), (3, "ß")], "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    want = brute(rows, [(1, "alpha beta gamma delta"), (3, "ß")])
    assert sorted(map(tuple, c.matches(awkward, items).collect()), key=str) == want
    out = c.clean(awkward, items)
    assert out.columns == awkward.columns and out.count() == awkward.count() - len({(w[0], i) for i, w in enumerate(want)})
    assert c.matches(nothing, items).count() == 0 and c.matches(awkward, items.limit(0)).count() == 0
    assert c.clean(awkward, items.limit(0)).count() == awkward.count()
