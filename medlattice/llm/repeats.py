"""Exact removal of repeated passages: maximal repeats from a sampled enhanced suffix array.

A byte is repeated when it lies in a string of ``LENGTH`` bytes that also starts anywhere else. The
suffixes that matter are found without sorting all of them:

* Anchors are the smallest of every ``LENGTH - CORE + 1`` neighbouring 16-byte hashes. Every string of
  ``LENGTH`` bytes holds an anchor with its whole core (the ``CORE`` bytes from it on) inside, and equal
  strings hold it at the same place. Only about one position in a hundred is an anchor.
* Anchors are counted by the hash of their core and of their whole context (``CORE`` bytes before,
  ``LENGTH`` bytes after), with partial counts, so frequent passages shrink before they move. A context
  that occurs twice is repeated as far as it can be; a core that occurs once is no repeat. What is left are the
  contexts at the edges of repeats: equal cores, different surroundings.
* For these, the suffixes of one core are sorted and scanned with a stack: every interval of common
  prefixes is split by common left extensions, scanned the same way. A pair (left, right) that no
  member can extend, neither to the left nor to the right, is a maximal repeat group with all its occurrences.
* A core with more than ``CLASS`` different contexts is not scanned, nor gathered. How far each of its contexts can agree with
  another is bounded by counting hashes of prefixes of doubling length; each then lists its windows of ``LENGTH`` bytes
  within that reach, which are counted by hash. Both counts are partial before they move.

Texts are found again by (doc_id, hash of the text). Rows equal in both are copies of each other, so
whatever is said of one holds for all. Core and context hashes together have 128 bits.

Defined cases: null texts are empty; texts under ``LENGTH`` bytes lose nothing; a null ``doc_id`` is kept;
repeated rows of ``LENGTH`` bytes or more are removed whole, each of them; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import cut_lineage, in_small_batches

LENGTH, CORE, GRAM, CLASS = 400, 200, 16, 512
#: lengths at which the reach of a context is counted
STEPS = (1, 2, 4, 8, 16, 32, 64, 128, CORE)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))
_ID = "doc_id long, th long"


# ---- anchors -----------------------------------------------------------------------------------


def _sliding_least(v: np.ndarray, w: int) -> np.ndarray:
    """Least of every ``w`` neighbours: running minima of blocks from both sides."""
    n = len(v) - w + 1
    padded = np.concatenate((v, np.full(-len(v) % w, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, w)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def anchors(data: bytes) -> np.ndarray:
    """Positions of the anchors of one text, ascending. Ties go to the leftmost position."""
    last = len(data) - LENGTH
    if last < 0:
        return np.zeros(0, np.int64)
    n = len(data) - CORE + 1
    eight = np.ndarray((n + 8,), "<u8", data, strides=(1,))
    x = (eight[:n] * _MIX[0]) ^ ((eight[8 : n + 8] ^ _MIX[2]) * _MIX[1])
    x = (x ^ (x >> np.uint64(29))) * _MIX[2]
    # the hash's upper half above the position: the least value names its place
    keyed = (x & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    at = (_sliding_least(keyed, LENGTH - CORE + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return at[np.concatenate(([True], at[1:] != at[:-1]))]


def _context(data: bytes, at: int) -> tuple[bytes, bytes]:
    return data[max(0, at - CORE) : at], data[at : at + LENGTH]


def _text(value: pa.Scalar) -> bytes:
    return (value.as_py() or "").encode()


def _identified(docs: DataFrame) -> DataFrame:
    return in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")


def anchored(docs: DataFrame) -> DataFrame:
    """(core, context, doc_id, th, at, lo, hi) of every anchor; (lo, hi) is what its context reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            core, whole, lo, hi, at_all, row = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                data = _text(text)
                for at in anchors(data).tolist():
                    left, right = max(0, at - CORE), min(len(data), at + LENGTH)
                    core.append(digest(data[at : at + CORE]))
                    whole.append(digest(data[left:right], at - left))
                    lo.append(left), hi.append(right), at_all.append(at), row.append(i)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(core, np.uint64).view(np.int64)), pa.array(np.array(whole, np.uint64).view(np.int64)), batch.column("doc_id").take(take),
                    batch.column("th").take(take), pa.array(at_all, pa.int64()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()),
                ],
                names=["core", "context", "doc_id", "th", "at", "lo", "hi"],
            )

    return cut_lineage(_identified(docs).mapInArrow(run, f"core long, context long, {_ID}, at long, lo long, hi long"), "repeat-anchors")


# ---- common-prefix intervals -------------------------------------------------------------------


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "little") ^ int.from_bytes(b[:n], "little")
    return ((x & -x).bit_length() - 1) // 8 if x else n


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of every interval of two or more sorted strings, by one stack scan;
    ``lcp[i]`` is the common prefix of strings i and i + 1."""
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > value:
            length, first = stack.pop()
            yield length, first, i
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def maximal_groups(contexts: list[tuple[bytes, bytes]]) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members) of the maximal repeats of at least ``LENGTH`` bytes around one anchor.

    ``contexts`` are (bytes before, bytes from the anchor on). Members agree in ``left`` bytes before and ``right``
    bytes from the anchor on, and in no more on either side.
    """
    order = sorted(range(len(contexts)), key=lambda i: contexts[i][1])
    rights = [contexts[i][1] for i in order]
    lcp = [common_prefix(a, b) for a, b in zip(rights, rights[1:], strict=False)]
    backwards = [contexts[i][0][::-1] for i in order]
    for right, first, last in intervals(lcp):
        if right + CORE < LENGTH:
            continue
        by_left = sorted(range(first, last + 1), key=lambda i: backwards[i])
        left_lcp = [common_prefix(backwards[a], backwards[b]) for a, b in zip(by_left, by_left[1:], strict=False)]
        for left, a, b in intervals(left_lcp):
            if left + right < LENGTH:
                continue
            members = sorted(by_left[a : b + 1])
            # the members' own common prefix: longer than the interval's if all come from one child
            if min(lcp[members[0] : members[-1]]) == right:
                yield left, right, [order[i] for i in members]


_RUNS = f"core long, {_ID}, lo long, hi long"
_GROUPS = "core long, context long, grp long, left long, right long"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _resolved(contexts: DataFrame, groups: bool = False) -> DataFrame:
    """The scan of the contexts of each core, at most ``CLASS`` of them. Rows are the members of maximal groups with the
    run (lo, hi) that all their groups cover, or with ``groups`` every maximal group with each of its contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _GROUPS if groups else _RUNS
        key, held, out = None, [], []

        def close() -> None:
            if len(held) < 2:
                return
            found = maximal_groups([(h[5], h[6]) for h in held])
            if groups:
                for left, right, members in found:
                    names = sorted(held[i][1] for i in members)
                    name = int.from_bytes(xxhash.xxh3_64_digest(np.array([key, left, right, *names], np.int64).tobytes()), "little", signed=True)
                    out.extend((key, context, name, left, right) for context in names)
                return
            # groups nest, so each member is passed on once, with the union of its runs: all hold the anchor
            reach: dict[int, tuple[int, int]] = {}
            for left, right, members in found:
                for i in members:
                    a, b = reach.get(i, (0, 0))
                    reach[i] = (left if left > a else a, right if right > b else b)
            for i, (left, right) in reach.items():
                core, _, doc_id, th, at, _, _ = held[i]
                out.append((core, doc_id, th, at - left, at + right))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("core", "context", "doc_id", "th", "at", "before", "after")]
            for r in zip(*columns, strict=True):
                if r[0] != key:
                    close()
                    key, held = r[0], []
                held.append(r)
            if len(out) > 20_000:
                yield _batch(out, schema)
                out.clear()
        close()
        yield _batch(out, schema)

    ordered = contexts.repartition("core").sortWithinPartitions("core")
    return cut_lineage(ordered.mapInArrow(run, _GROUPS if groups else _RUNS), "repeat-groups")


def _reaches(big: DataFrame) -> DataFrame:
    """(n, left, right): bytes before and after the core of context ``n`` that no other context of its core can
    share more of; off by less than a factor of two, since prefixes are counted at the lengths ``STEPS`` only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            index, side, length, hashes = [], [], [], []
            for i, (before, after) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("before", "after")], strict=True)):
                backwards = before[::-1]
                for which, text in ((0, backwards), (1, after[CORE:])):
                    for step in STEPS:
                        if step <= len(text):
                            index.append(i), side.append(which), length.append(step), hashes.append(digest(text[:step], which))
            take = pa.array(index, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("core").take(take), batch.column("n").take(take), pa.array(side, pa.int32()), pa.array(length, pa.int32()), pa.array(np.array(hashes, np.uint64).view(np.int64))],
                names=["core", "n", "side", "length", "part"],
            )

    keys = ["core", "side", "length", "part"]
    listed = cut_lineage(big.select("core", "n", "before", "after").mapInArrow(run, "core long, n long, side int, length int, part long"), "repeat-parts")
    shared = listed.groupBy(*keys).agg(F.min("n").alias("a"), F.max("n").alias("b")).where("a < b").select(*keys)
    longest = listed.join(cut_lineage(shared, "repeat-shared"), keys).groupBy("n").agg(
        *[F.coalesce(F.max(F.when(F.col("side") == which, F.col("length"))), F.lit(0)).alias(name) for which, name in ((0, "left"), (1, "right"))]
    )

    def below_next(found: str):
        out = F.lit(CORE)
        for step in reversed(STEPS):
            out = F.when(F.col(found) < step, F.lit(step - 1)).otherwise(out)
        return out.alias(found)

    return longest.select("n", below_next("left"), below_next("right"))


def _windows(big: DataFrame) -> DataFrame:
    """Repeated windows of crowded cores: (core, window, doc_id, th, lo, hi). Only windows within reach of another context are
    listed."""
    big = cut_lineage(big.withColumn("n", F.monotonically_increasing_id()), "repeat-crowded")
    reach = big.join(cut_lineage(_reaches(big), "repeat-reaches"), "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            index, hashes, starts = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("at", "before", "after", "left", "right")]
            for i, (at, before, after, left, right) in enumerate(zip(*columns, strict=True)):
                text = before + after
                # a window starts ``ahead`` bytes before the anchor and ends inside the text
                for ahead in range(max(0, LENGTH - CORE - right, LENGTH - len(after)), min(left, len(before)) + 1):
                    s = len(before) - ahead
                    index.append(i), hashes.append(digest(text[s : s + LENGTH])), starts.append(at - ahead)
            take = pa.array(index, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("core").take(take), pa.array(np.array(hashes, np.uint64).view(np.int64)), batch.column("doc_id").take(take), batch.column("th").take(take), pa.array(starts, pa.int64())],
                names=["core", "window", "doc_id", "th", "lo"],
            )

    wanted = reach.select("core", "at", "before", "after", "doc_id", "th", "left", "right")
    listed = cut_lineage(wanted.mapInArrow(run, f"core long, window long, {_ID}, lo long"), "repeat-windows")
    # one place may be listed by several anchors, so places are told apart rather than counted
    place = F.struct("doc_id", "th", "lo")
    often = listed.groupBy("core", "window").agg(F.min(place).alias("a"), F.max(place).alias("b"))
    often = cut_lineage(often.where(~F.col("a").eqNullSafe(F.col("b"))).select("core", "window"), "repeat-often")
    return listed.join(often, ["core", "window"]).select("core", "window", "doc_id", "th", "lo", (F.col("lo") + LENGTH).alias("hi"))


def _edges(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(all anchors of repeated cores, their contexts with counts, contexts to scan, contexts of crowded cores). Contexts
    are counted per core first, so a crowded core is never gathered."""
    found = anchored(docs)
    often = cut_lineage(found.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core"), "repeat-cores")
    members = cut_lineage(found.join(often, "core"), "repeat-members")
    kinds = members.groupBy("core", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "th", "at")).alias("one"))
    kinds = cut_lineage(kinds, "repeat-contexts")
    return members, kinds, *_read_contexts(docs, kinds)


def _read_contexts(docs: DataFrame, kinds: DataFrame, all_kinds: bool = False) -> tuple[DataFrame, DataFrame]:
    """(contexts of cores with at most ``CLASS`` of them, those of the others), read from the texts. A core whose contexts all
    occur twice has nothing to scan for its runs: they are repeated as far as they reach."""
    mixed = kinds.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    mixed = mixed.where("kinds > 1" if all_kinds else "kinds > 1 AND least = 1").select("core", (F.col("kinds") > CLASS).alias("crowded"))
    edge = kinds.join(cut_lineage(mixed, "repeat-mixed"), "core").select("core", "context", "crowded", "one.*")
    wanted = edge.groupBy("doc_id", "th").agg(F.collect_list(F.struct("core", "context", "at", "crowded")).alias("wanted"))
    wanted = wanted.select(F.col("doc_id").alias("wanted_id"), F.col("th").alias("wanted_h"), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, th, text, listed in zip(batch.column("doc_id").to_pylist(), batch.column("th").to_pylist(), batch.column("text"), batch.column("wanted").to_pylist(), strict=True):
                data = _text(text)
                rows += [(w["core"], w["context"], doc_id, th, w["at"], w["crowded"], *_context(data, w["at"])) for w in listed]
            columns = list(zip(*rows, strict=True)) or [()] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_()] + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["core", "context", "doc_id", "th", "at", "crowded", "before", "after"])

    texts = _identified(docs)
    same = texts.doc_id.eqNullSafe(F.col("wanted_id")) & (texts.th == F.col("wanted_h"))
    contexts = texts.join(cut_lineage(wanted, "repeat-wanted"), same).select("doc_id", "th", "text", "wanted")
    contexts = cut_lineage(contexts.mapInArrow(run, f"core long, context long, {_ID}, at long, crowded boolean, before binary, after binary"), "repeat-edges")
    return contexts.where("NOT crowded"), contexts.where("crowded")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, th, lo, hi): runs whose every window of ``LENGTH`` bytes starts elsewhere too, together all such windows."""
    members, kinds, plain, crowded = _edges(docs)
    whole = members.join(kinds.where("n > 1").select("core", "context"), ["core", "context"]).where(f"hi - lo >= {LENGTH}").select("doc_id", "th", "lo", "hi")
    runs = whole.unionByName(_resolved(plain).select("doc_id", "th", "lo", "hi"))
    return runs.unionByName(_windows(crowded).select("doc_id", "th", "lo", "hi")) if crowded.limit(1).count() else runs


def groups(docs: DataFrame) -> DataFrame:
    """Maximal repeat groups with all occurrences: (grp, doc_id, th, lo, hi), a row for each place of a group.

    The members of a group are equal in (lo, hi), and no longer run around their anchor is shared by all of them.
    What repeats beyond the context of an anchor, ``CORE`` bytes before and ``LENGTH`` bytes from it on, shows up as several
    groups, one for each anchor. Groups of cores with more than ``CLASS`` contexts are the repeated windows of ``LENGTH``
    bytes instead of maximal runs. A place is listed once for each of its groups.
    """
    members, kinds, _, _ = _edges(docs)
    plain, crowded = _read_contexts(docs, kinds, all_kinds=True)
    scanned = _resolved(plain, groups=True).join(members, ["core", "context"])
    scanned = scanned.select("grp", "doc_id", "th", (F.col("at") - F.col("left")).alias("lo"), (F.col("at") + F.col("right")).alias("hi"))
    equal = members.join(kinds.where("n > 1").select("core", "context"), ["core", "context"]).where(f"hi - lo >= {LENGTH}")
    equal = equal.select(F.xxhash64("core", "context").alias("grp"), "doc_id", "th", "lo", "hi")
    out = scanned.unionByName(equal)
    if crowded.limit(1).count():
        windows = _windows(crowded).select(F.xxhash64("core", "window").alias("grp"), "core", "doc_id", "th", "lo", "hi")
        # a context that occurs more than once was listed at one place: the others repeat its windows
        one = kinds.select("core", "context", F.col("one.doc_id").alias("doc_id"), F.col("one.th").alias("th"), F.col("one.at").alias("one_at"))
        same = (windows.core == one.core) & windows.doc_id.eqNullSafe(one.doc_id) & (windows.th == one.th) & (windows.lo >= F.col("one_at") - CORE) & (windows.hi <= F.col("one_at") + LENGTH)
        placed = windows.join(one, same).select("grp", one.core, "context", (windows.lo - F.col("one_at")).alias("lo_off"))
        spread = placed.join(members.select("core", "context", "doc_id", "th", "at"), ["core", "context"])
        lo = F.col("at") + F.col("lo_off")
        out = out.unionByName(spread.select("grp", "doc_id", "th", lo.alias("lo"), (lo + LENGTH).alias("hi")).distinct())
    return out


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, the removed ``spans`` (lo, hi) in bytes, ascending, and ``kept``, the remaining bytes."""
    runs = repeated_runs(docs).groupBy("doc_id", "th").agg(F.collect_set(F.struct("lo", "hi")).alias("runs"))
    runs = cut_lineage(runs.select(F.col("doc_id").alias("run_id"), F.col("th").alias("run_h"), "runs"), "repeat-runs")
    texts = _identified(docs)
    same = texts.doc_id.eqNullSafe(F.col("run_id")) & texts.th.eqNullSafe(F.col("run_h"))
    place = pa.struct([("lo", pa.int64()), ("hi", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, found in zip(batch.column("text"), batch.column("runs").to_pylist(), strict=True):
                data = _text(text)
                pieces, end, all_runs = [], 0, merged((r["lo"], r["hi"]) for r in found or ())
                for lo, hi in all_runs:
                    pieces.append(data[end:lo])
                    end = hi
                pieces.append(data[end:])
                sizes.append(len(data)), spans.append([{"lo": lo, "hi": hi} for lo, hi in all_runs]), kept.append(b"".join(pieces))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(place)), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    return texts.join(runs, same, "left").select("doc_id", "text", "runs").mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<lo: long, hi: long>>, kept binary")


def removed(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept_text``. Spans are cut at
    bytes: what is left of a character that one cuts through is U+FFFD in ``kept_text``, while the digest is of the bytes."""
    return without_repeats(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"),
    )


def merged(runs) -> list[tuple[int, int]]:
    """Runs in order, those that overlap or touch joined."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(runs):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out
