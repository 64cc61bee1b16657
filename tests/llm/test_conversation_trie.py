from __future__ import annotations

import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import duckdb
import pytest
from pyspark.sql import functions as F

from medlattice.llm import conversation_trie as t

CONV = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))] for c, v in own.items()}
    nodes, ends = defaultdict(set), defaultdict(list)
    for c in own:
        h = crc32(str(c).encode()) % 6
        host = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        whole = own.get(host, [])[:h] + own[c][h:]
        for d in range(len(whole) + 1):
            nodes[tuple(whole[:d])].add(c)
        ends[tuple(whole)].append(c)
    kids = defaultdict(list)
    for n in nodes:
        if n:
            kids[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(nodes, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in kids[n]) if kids[n] else 1
        saved[n] = sum(saved[k] for k in kids[n]) + (len(nodes[n]) - 1) * (len(n[-1][1]) if n else 0)
    return sorted(
        (min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n], sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, m in nodes.items()
    )


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=lambda r: tuple((x is not None, x) if i == 2 else x for i, x in enumerate(r)))


def check(spark, rows, schema=CONV, wrap=lambda d: d):
    want = brute([r[:4] for r in rows])
    assert got(t.trie(wrap(spark.createDataFrame(rows, schema)))) == sorted(want, key=lambda r: tuple((x is not None, x) if i == 2 else x for i, x in enumerate(r)))


def test_supplied_table(spark):
    rows = duckdb.sql("SELECT conv_id, turn, role, text FROM '/root/testdata/sf0.01/conversations.parquet'").fetchall()
    check(spark, rows)


def test_ties_nulls_repeats_and_clashing_names(spark):
    rng, rows = random.Random(1), []
    for c in [*range(40), 100, 101, 205, -3, -100, -101, 7000, 7001, None]:
        for _ in range(rng.randrange(1, 12)):
            rows.append((c, rng.choice([None, 0, 1, 1, 2, 3]), rng.choice([None, "", "user", "é"]), rng.choice([None, "", "a", "b", "😀é"])))
    extra = [(*r, 1, 2, 3, "x") for r in rows + rows[:30]]
    check(spark, extra, CONV + ", a int, b int, at int, heads string")


def test_long_chains_over_partitions(spark):
    """Chains far longer than the rounds, shared prefixes deep inside, and one conversation with most of the rows."""
    rows = [(c, i, "user", f"t{i if i < 60 + c else c * 1000 + i}") for c in (0, 100, 200, 300) for i in range(150)]
    rows += [(7, i, "user", f"hot{i % 5}") for i in range(900)]
    check(spark, rows, wrap=lambda d: d.repartition(16))


def test_contraction_of_a_path_and_a_star(spark):
    path = [(i, 0, i - 1 if i else None, 0 if i else None, 1) for i in range(300)]
    star = [(1000 + i, 1, 1000 if i else None, 1 if i else None, i) for i in range(200)]
    tree = spark.createDataFrame(path + star, "a long, b long, pa long, pb long, v long")
    totals = {(r["a"], r["b"]): r["v"] for r in t.subtree_totals(tree, ["v"]).collect()}
    assert totals == {**{(i, 0): 300 - i for i in range(300)}, **{(1000 + i, 1): i if i else sum(range(200)) for i in range(200)}}


@pytest.mark.parametrize("partitions", [1, 5])
def test_numbering_does_not_depend_on_partitions(spark, partitions):
    rows = [(c, i // 2, "r", f"{c}-{i}") for c in (3, 4) for i in range(40)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        out = t.numbered_turns(spark.createDataFrame(rows, CONV)).groupBy("conv_id").agg(F.count("at").alias("n"), F.min("at"), F.max("at"), F.count_distinct("s0").alias("d")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, out)) == [(3, 40, 1, 40, 40), (4, 40, 1, 40, 40)]


def test_empty(spark):
    assert t.trie(spark.createDataFrame([], CONV)).count() == 0
    assert t.trie(spark.createDataFrame([(None, 1, "a", "b")], CONV)).count() == 0
