"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A test item is short and a document long, so the item's share of the document's shingles says
nothing. Documents are therefore cut into overlapping windows: items are partitioned by size into
classes of at most 2**c shingles, and for each class in use a document has windows of 2 * 2**c
shingles every 2**c shingles, so an item's passage lies whole in one window and is a fair share of it.
Items and windows have MinHash signatures of ``SLOTS`` values. A window that agrees with an item in
any slot makes the document a candidate for the item: with one agreement enough, a passage that
holds ``CONTAINED`` of an item is missed with a probability of about 1e-6. Each candidate is verified
by exact containment of the item's shingles, as text, in those of the whole document.

The documents are the searched side and are read in one narrow pass per block of items; a block is at
most ``BLOCK`` bytes of items, which bounds what is sent to the tasks. All items are searched, in as
many blocks as it takes. Signatures are computed once per block and sent with it (about ten times its size).

Words are runs of letters, digits and other non-ASCII characters, lower-cased. Shingles are five words;
an item of fewer words is one shingle of all its words.

Defined cases: null and empty items are never found; null and empty documents hold nothing; a null id
is reported as null; repeated items or documents are reported each; empty tables give an empty result;
other columns are ignored by ``matches`` and kept by ``clean``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import cut_lineage, in_small_batches, packed

WORDS, CONTAINED, SLOTS, BLOCK = 5, 0.8, 64, 2 << 20
_WORD = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_SEED = np.random.default_rng(11)
_MULTIPLY = _SEED.integers(1, 1 << 63, SLOTS, dtype=np.uint64) | np.uint64(1)
_ADD = _SEED.integers(0, 1 << 63, SLOTS, dtype=np.uint64)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
#: shingles whose slot values are computed at once
_CHUNK = 1 << 12


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[1]
    return x ^ (x >> np.uint64(29))


def shingle_hashes(words: list[str], k: int) -> np.ndarray:
    """One 64-bit hash per k-word window."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out + h[i : i + n]) * _MIX[0]
        out ^= out >> np.uint64(32)
    return _mixed(out)


def _block_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """(blocks, SLOTS) minima of the slot functions over consecutive runs of ``width`` hashes."""
    parts = []
    step = max(1, _CHUNK // width) * width
    for at in range(0, len(hashes), step):
        piece = hashes[at : at + step]
        parts.append(np.minimum.reduceat(piece[:, None] * _MULTIPLY + _ADD, np.arange(0, len(piece), width), axis=0))
    return np.concatenate(parts)


class _Block:
    """The items of one block with their signatures, by shingle length and size class."""

    def __init__(self, items: list[tuple[int | None, str | None]]) -> None:
        self.items = []
        signed: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
        for item_id, text in items:
            words = tokens(text)
            if not words:
                continue
            k = min(WORDS, len(words))
            shingles = {" ".join(words[i : i + k]) for i in range(len(words) - k + 1)}
            size_class = (len(words) - k).bit_length()
            signature = _block_minima(shingle_hashes(words, k), len(words))[0]
            signed.setdefault((k, size_class), []).append((len(self.items), signature))
            self.items.append((item_id, k, shingles))
        self.tables = {}
        for key, rows in signed.items():
            values = np.concatenate([s for _, s in rows])
            numbers = np.repeat([i for i, _ in rows], SLOTS)
            order = np.argsort(values, kind="stable")
            self.tables[key] = (values[order], numbers[order])

    def candidates(self, words: list[str]) -> set[int]:
        found: set[int] = set()
        for k in sorted({k for k, _ in self.tables}):
            hashes = shingle_hashes(words, k)
            if not len(hashes):
                continue
            classes = sorted(c for kk, c in self.tables if kk == k)
            width = 1 << classes[0]
            minima = _block_minima(hashes, width)
            for c in classes:
                while width < 1 << c:
                    if len(minima) % 2:
                        minima = np.concatenate([minima, minima[-1:]])
                    minima = np.minimum(minima[0::2], minima[1::2])
                    width *= 2
                windows = np.minimum(minima[:-1], minima[1:]) if len(minima) > 1 else minima
                values, numbers = self.tables[k, c]
                # values of different slots are equal only by chance, which verification rejects
                wanted = windows.ravel()
                left = np.searchsorted(values, wanted, side="left")
                for at in np.flatnonzero(values[np.minimum(left, len(values) - 1)] == wanted):
                    to = np.searchsorted(values, wanted[at], side="right")
                    found.update(numbers[left[at] : to].tolist())
        return found

    def verified(self, text: str | None) -> list[tuple[int | None, int, int]]:
        """(item_id, shingles of the item in the text, shingles of the item) at ``CONTAINED`` or more."""
        words = tokens(text)
        out, shingled = [], {}
        for number in sorted(self.candidates(words)):
            item_id, k, wanted = self.items[number]
            if k not in shingled:
                shingled[k] = {" ".join(words[i : i + k]) for i in range(len(words) - k + 1)}
            held = len(wanted & shingled[k])
            if held >= CONTAINED * len(wanted):
                out.append((item_id, held, len(wanted)))
        return out


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """All items, in blocks of about ``BLOCK`` bytes, the same ones on every run."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-int(size) // BLOCK)
    for block in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block) if n > 1 else items
        yield [(r["item_id"], r["text"]) for r in part.collect()]


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``shared`` and ``n_shingles`` of every contained item."""
    schema = "doc_id long, item_id long, shared long, n_shingles long"
    spark = docs.sparkSession
    found: DataFrame | None = None
    for block in _blocks(items):
        shared = spark.sparkContext.broadcast(_Block(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            search = shared.value
            for batch in batches:
                rows = [
                    (doc_id, *hit)
                    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True)
                    for hit in search.verified(text.as_py())
                ]
                columns = list(zip(*rows, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "shared", "n_shingles"])

        part = cut_lineage(in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema), "benchmark-matches")
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without those that contain a test item. A document without an id is kept or dropped with
    the others that have none and the same text."""
    keyed = packed(docs, F.xxhash64("text").alias("h"), "text")
    leaked = matches(keyed.select(F.col("h").alias("doc_id"), "text"), items).select(F.col("doc_id").alias("leaked_h")).distinct()
    return keyed.join(leaked, F.col("h") == F.col("leaked_h"), "left_anti").select("row.*")
