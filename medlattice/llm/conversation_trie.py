"""Prefix trie of rebuilt conversations, its subtree totals by parallel tree contraction.

Rebuilding: conversation c starts with the first h turns of its host, ``c - c % 100``, and goes on with its own
turns after its first h; h is the unsigned crc32 of the decimal id, modulo ``HEADS``.

* Turns are numbered without gathering a conversation: one range sort by (conversation, turn) numbers the rows of
  each partition, and the few conversations that span partitions get their offsets from one row per partition.
* A node is named by its depth and a polynomial hash of its turns modulo four primes (124 bits): such a hash can be
  cut and joined, so the prefix of a host and the rest of a conversation combine by arithmetic per row.
* Members of a node are counted with partial aggregation; a node that every conversation shares is one key of sums.
* Subtree totals: each round *rakes* the leaves into their parents and *compresses* unary chains, whose nodes double
  their reach in each join until they know the node below the chain; that node then hangs below what was above the
  chain. Rounds grow with the logarithm of the nodes, joins of a round with that of its longest chain. The contracted
  nodes are logged and re-expanded in reverse order of the rounds, so every node gets its total. Each step is a
  written table.
* Ids that end at one node are joined in runs of ``RUN`` ids before they meet, then hashed as a stream.

Defined cases: a null ``conv_id`` names no conversation, its rows are left out; null role or text is empty; null turns
come first; turns of equal number are ordered by role, then text, so repeated rows are repeated turns; a missing host
has no turns, a short one gives what it has; negative ids follow ``%`` of SQL; an empty table gives an empty trie;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import cut_lineage
from medlattice.session import broadcast_if_small

#: conversations that share a host, and the bound of the turns taken from it
GROUP, HEADS = 100, 6
#: ids joined into one piece before hashing, conversations broadcast to their turns at most
RUN, BROADCAST_ROWS = 4096, 200_000
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1103515245, 1664525011, 1812433253, 1566083941)
_LANES = range(len(PRIMES))
_KEY = ["a", "b"]
_TURN = "conv_id long, pid int, at long, chars long, " + ", ".join(f"t{k} long, w{k} long" for k in _LANES)


# ---- numbered turns ----------------------------------------------------------------------------


class _Run:
    """Numbers and hash sums of the rows of one partition, conversation by conversation."""

    def __init__(self) -> None:
        self.conv, self.count, self.sums = None, 0, [0] * len(PRIMES)
        self.powers = [np.ones(1, np.int64) for _ in _LANES]

    def _power(self, lane: int, n: int) -> np.ndarray:
        have = self.powers[lane]
        while len(have) < n:
            step = have[-1] * BASES[lane] % PRIMES[lane]
            have = np.concatenate([have, have * step % PRIMES[lane]])
        self.powers[lane] = have
        return have

    def numbered(self, conv: np.ndarray, weights: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """(place of each row in its conversation from 1, its term and the sum of the terms up to it, per lane)."""
        n = len(conv)
        starts = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
        sizes = np.diff(np.append(starts, n))
        carried = self.conv is not None and conv[0] == self.conv
        first = np.repeat(starts, sizes)
        at = np.arange(n) - first + 1
        if carried:
            at[: sizes[0]] += self.count
        terms, totals = [], []
        for k in _LANES:
            term = weights[k] * self._power(k, int(at.max()) + 1)[at] % PRIMES[k]
            run = np.cumsum(term)
            before = run[first] - term[first]
            total = (run - before) % PRIMES[k]
            if carried:
                total[: sizes[0]] = (total[: sizes[0]] + self.sums[k]) % PRIMES[k]
            terms.append(term), totals.append(total)
        self.conv, self.count, self.sums = conv[-1], int(at[-1]), [int(t[-1]) for t in totals]
        return at, terms, totals


def _numbered(conversations: DataFrame) -> DataFrame:
    """Written rows (conv_id, pid, at, chars, t*, w*): the place in the part of the conversation that partition
    ``pid`` holds, the term of the row and the sum of terms so far."""
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    # short prefixes bound the ranges; a text only counts where its role is whole, so ranges follow the order of rows
    long_role = F.char_length("role") > 16
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.substring("role", 1, 16), long_role, F.when(~long_role, F.substring("text", 1, 32))]
    weights = [F.pmod(F.xxhash64(F.lit(k), "role", "text"), F.lit(PRIMES[k])).cast("long").alias(f"w{k}") for k in _LANES]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    rows = dealt.select("conv_id", F.spark_partition_id().alias("pid"), F.char_length("text").cast("long").alias("chars"), *weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Run()
        for batch in batches:
            if not batch.num_rows:
                continue
            at, terms, totals = state.numbered(batch.column("conv_id").to_numpy(), [batch.column(f"w{k}").to_numpy() for k in _LANES])
            lanes = [pa.array(x[k]) for k in _LANES for x in (terms, totals)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("pid"), pa.array(at), batch.column("chars"), *lanes],
                names=["conv_id", "pid", "at", "chars", *[f"{x}{k}" for k in _LANES for x in "tw"]],
            )

    return cut_lineage(rows.mapInArrow(run, _TURN), "trie-turns")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, chars, s*, q*) of every turn: its place from 1, code points of its text, the hash sums of the
    turns up to it and of those before it."""
    rows = _numbered(conversations)
    parts = rows.groupBy("conv_id", "pid").agg(F.max("at").alias("n"), F.max_by(F.array(*[f"w{k}" for k in _LANES]), "at").alias("sums"))
    spread = parts.groupBy("conv_id").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1").select("conv_id")
    # two conversations of a partition at most go on in another one
    spans = sorted(map(tuple, parts.join(spread, "conv_id").select("conv_id", "pid", "n", "sums").collect()))
    carry, last, count, sums = [], None, 0, [0] * len(PRIMES)
    for conv, pid, n, own in spans:
        if conv != last:
            last, count, sums = conv, 0, [0] * len(PRIMES)
        factors = [pow(BASES[k], count, PRIMES[k]) for k in _LANES]
        carry.append((conv, pid, count, factors, list(sums)))
        sums = [(sums[k] + factors[k] * own[k]) % PRIMES[k] for k in _LANES]
        count += n
    offsets = rows.sparkSession.createDataFrame(carry, "conv_id long, pid int, ahead long, factors array<long>, sums array<long>")
    joined = rows.join(F.broadcast(offsets), ["conv_id", "pid"], "left")

    def lane(k: int) -> list[Column]:
        factor = F.coalesce(F.get("factors", F.lit(k)), F.lit(1))
        before = F.coalesce(F.get("sums", F.lit(k)), F.lit(0))
        upto = (before + factor * F.col(f"w{k}")) % PRIMES[k]
        return [upto.alias(f"s{k}"), F.pmod(upto - factor * F.col(f"t{k}") % PRIMES[k], F.lit(PRIMES[k])).alias(f"q{k}")]

    return joined.select("conv_id", (F.col("at") + F.coalesce("ahead", F.lit(0))).alias("at"), "chars", *[c for k in _LANES for c in lane(k)])


# ---- rebuilt conversations ---------------------------------------------------------------------


def _key(depth: Column, lanes: list[Column], names: tuple[str, str]) -> list[Column]:
    return [F.xxhash64(F.lit(i), depth.cast("long"), *lanes).alias(n) for i, n in enumerate(names)]


def members(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, pa, pb, chars, ends) of every prefix of every rebuilt conversation, the empty one
    included: (a, b) names the node, (pa, pb) its parent, ``ends`` tells the whole conversation."""
    turns = cut_lineage(numbered_turns(conversations), "trie-numbered")
    head = F.when(F.col("at") < HEADS, F.struct("at", "chars", F.array(*[f"s{k}" for k in _LANES]).alias("s"), F.array(*[f"q{k}" for k in _LANES]).alias("q")))
    # at most HEADS - 1 turns of each conversation are kept
    heads = turns.groupBy("conv_id").agg(F.max("at").alias("n"), F.array_sort(F.collect_list(head)).alias("heads"))
    heads = cut_lineage(heads, "trie-heads")
    host = heads.select(F.col("conv_id").alias("host"), F.col("heads").alias("lent"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)).cast("int")
    convs = heads.select("conv_id", "n", "heads", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("host"))
    convs = convs.join(host, "host", "left").withColumn("lent", F.coalesce(F.slice("lent", 1, F.col("h")), F.expr("slice(heads, 1, 0)")))
    zero = F.array(*[F.lit(0).cast("long") for _ in _LANES])

    def sums(of: str, at: str) -> Column:
        return F.coalesce(F.get(of, F.expr(f"{at} - 1"))["s"], zero)

    convs = convs.withColumn("l", F.size("lent")).select(
        "conv_id", "h", "l", "lent", (F.col("l") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size"),
        sums("lent", "l").alias("start"), sums("heads", "h").alias("cut"),
    )
    convs = cut_lineage(convs, "trie-conversations")

    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), *_key(F.lit(0), [F.lit(0).cast("long")] * 4, ("a", "b")),
                        F.lit(None).cast("long").alias("pa"), F.lit(None).cast("long").alias("pb"), F.lit(0).cast("long").alias("chars"), (F.col("size") == 0).alias("ends"))
    lent = convs.select("conv_id", "size", F.explode("lent").alias("e")).select("conv_id", "size", "e.*")
    lent = lent.select(
        "conv_id", F.col("at").alias("depth"), *_key(F.col("at"), [F.get("s", F.lit(k)) for k in _LANES], ("a", "b")),
        *_key(F.col("at") - 1, [F.get("q", F.lit(k)) for k in _LANES], ("pa", "pb")), "chars", (F.col("size") == F.col("at")).alias("ends"),
    )
    # own turns stand h - l places further ahead than they did: each term is divided by that power of the base
    shift = [F.array(*[F.lit(pow(BASES[k], -i, PRIMES[k])).cast("long") for i in range(HEADS)]) for k in _LANES]
    known, _ = broadcast_if_small(convs.where("size > l").select("conv_id", "h", "l", "size", "start", "cut"), "trie-known", BROADCAST_ROWS)
    own = turns.join(known, "conv_id").where("at > h")
    depth = F.col("at") - F.col("h") + F.col("l")

    def moved(name: str) -> list[Column]:
        return [
            (F.get("start", F.lit(k)) + F.pmod(F.col(f"{name}{k}") - F.get("cut", F.lit(k)), F.lit(PRIMES[k])) * F.get(shift[k], F.col("h") - F.col("l"))) % PRIMES[k]
            for k in _LANES
        ]

    own = own.select("conv_id", depth.alias("depth"), *_key(depth, moved("s"), ("a", "b")), *_key(depth - 1, moved("q"), ("pa", "pb")), "chars", (depth == F.col("size")).alias("ends"))
    return root.unionByName(lent).unionByName(own)


# ---- contraction -------------------------------------------------------------------------------


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """(a, b, *values) of every node of ``tree`` (a, b, pa, pb, *values): the values summed over its subtree.

    ``tree`` is a forest; a root's parent is null. A live node may carry ``edge_*``: the values of the contracted
    chain between it and its parent.
    """
    up, edges = ["pa", "pb"], [f"edge_{v}" for v in values]

    def some(df: DataFrame) -> bool:
        return bool(df.limit(1).count())

    live = cut_lineage(tree.select(*_KEY, *up, *values, *[F.lit(0).cast("long").alias(e) for e in edges]), "trie-live")
    done: DataFrame | None = None
    logs: list[DataFrame] = []
    while some(live):
        kids = live.where("pa IS NOT NULL").groupBy(*up).agg(F.count(F.lit(1)).alias("kids")).withColumnsRenamed({"pa": "a", "pb": "b"})
        marked = cut_lineage(live.join(kids, _KEY, "left").withColumn("kids", F.coalesce("kids", F.lit(0))), "trie-marked")
        # rake: what has no child is final, and its parent takes its sums
        leaves = marked.where("kids = 0")
        totals = leaves.select(*_KEY, *values)
        done = totals if done is None else done.unionByName(totals)
        given = leaves.where("pa IS NOT NULL").groupBy(*up).agg(F.count(F.lit(1)).alias("gone"), *[F.sum(F.col(v) + F.col(e)).alias(f"more_{v}") for v, e in zip(values, edges, strict=True)])
        rest = marked.where("kids > 0").join(given.withColumnsRenamed({"pa": "a", "pb": "b"}), _KEY, "left")
        rest = cut_lineage(rest.select(
            *_KEY, *up, *[(F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values], *edges,
            (F.col("kids") - F.coalesce("gone", F.lit(0))).alias("kids"),
        ), "trie-rest")
        # compress: (node, next, sums, open) of every unary node; open chains double their reach in each step
        unary = rest.where("kids = 1").withColumnsRenamed({e: f"own_{e}" for e in edges})
        below = rest.select(F.col("a").alias("next_a"), F.col("b").alias("next_b"), *[F.col(c).alias(f"of_{c}") for c in up], *edges, (F.col("kids") == 1).alias("open"))
        chain = unary.join(below, (F.col("a") == F.col("of_pa")) & (F.col("b") == F.col("of_pb")))
        chain = cut_lineage(chain.select(*_KEY, "next_a", "next_b", *[(F.col(v) + F.col(e)).alias(v) for v, e in zip(values, edges, strict=True)], "open"), "trie-chain")
        if not some(chain):
            live = rest.drop("kids")
            continue
        while some(chain.where("open")):
            ahead = chain.select(F.col("a").alias("next_a"), F.col("b").alias("next_b"), F.col("next_a").alias("to_a"), F.col("next_b").alias("to_b"), *[F.col(v).alias(f"more_{v}") for v in values], F.col("open").alias("still"))
            far = chain.where("open").join(ahead, ["next_a", "next_b"]).select(
                *_KEY, F.col("to_a").alias("next_a"), F.col("to_b").alias("next_b"), *[(F.col(v) + F.col(f"more_{v}")).alias(v) for v in values], F.col("still").alias("open")
            )
            chain = cut_lineage(chain.where("NOT open").unionByName(far), "trie-chain")
        logs.append(chain.drop("open"))
        # the end of a chain hangs below what was above the chain's first node
        inner = unary.select(F.col("a").alias("pa"), F.col("b").alias("pb"))
        first = unary.join(inner, up, "left_anti").select(*_KEY, *up, *[f"own_{e}" for e in edges]).join(chain, _KEY)
        first = first.select(
            F.col("next_a").alias("a"), F.col("next_b").alias("b"), F.col("pa").alias("to_a"), F.col("pb").alias("to_b"), F.lit(True).alias("moved"),
            *[(F.col(f"own_{e}") + F.col(v)).alias(f"new_{e}") for v, e in zip(values, edges, strict=True)],
        )
        kept = rest.where("kids != 1").join(first, _KEY, "left")
        live = cut_lineage(kept.select(
            *_KEY, *[F.when(F.col("moved"), F.col(t)).otherwise(F.col(u)).alias(u) for t, u in (("to_a", "pa"), ("to_b", "pb"))], *values,
            *[F.coalesce(f"new_{e}", e).alias(e) for e in edges],
        ), "trie-live")

    # re-expansion: a contracted node has the sums of its chain and all that the node below the chain has
    for log in reversed(logs):
        below = done.select(F.col("a").alias("next_a"), F.col("b").alias("next_b"), *[F.col(v).alias(f"more_{v}") for v in values])
        back = log.join(below, ["next_a", "next_b"]).select(*_KEY, *[(F.col(v) + F.col(f"more_{v}")).alias(v) for v in values])
        done = done.unionByName(cut_lineage(back, "trie-expanded"))
    return tree.select(*_KEY, *values) if done is None else done


# ---- the trie ----------------------------------------------------------------------------------


def end_digests(found: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of every node at which conversations end."""
    pieces = found.where("ends").groupBy(*_KEY, F.floor(F.col("conv_id") / RUN).alias("run")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select(*_KEY, "run", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        out: list[tuple[int, int, str]] = []

        def batch_of(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
            a, b, digest = zip(*rows, strict=True) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(digest, pa.string())], names=["a", "b", "ends_sha256"])

        for batch in batches:
            for a, b, ids in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "ids")], strict=True):
                if (a, b) == key:
                    state.update(b"," + ids.encode())
                    continue
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = (a, b), sha256(ids.encode())
            yield batch_of(out)
            out = []
        yield batch_of([(*key, state.hexdigest())] if key else [])

    return pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "run").select(*_KEY, "ids").mapInArrow(digests, "a long, b long, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``."""
    found = cut_lineage(members(conversations), "trie-members")
    nodes = found.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
        F.max("chars").alias("chars"), F.count(F.lit(1)).alias("n_convs"),
    )
    nodes = cut_lineage(nodes, "trie-nodes")
    kids = nodes.where("pa IS NOT NULL").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut_lineage(nodes.join(kids, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "trie-children")
    own = nodes.select(*_KEY, "pa", "pb", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    totals = subtree_totals(own, ["n_leaves", "saved_tokens"])
    above = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals, _KEY).join(end_digests(found), _KEY, "left").join(above, ["pa", "pb"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(sha256().hexdigest())).alias("ends_sha256"),
    )
