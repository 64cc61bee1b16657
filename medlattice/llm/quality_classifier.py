"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of every text are computed where the text lies (Arrow batches, numpy). Boosting runs on a
bounded sample of labelled rows (``max_rows``, smallest hash of the id first); the trees are complete
binary trees flattened into three arrays, walked for a whole batch at a time.

Defined cases: a null or empty text has all statistics 0 and gets a score like any other; rows with a
null label do not train, repeated labels of one id count once (the mean); without labelled rows, or
with one class only, every score is the smoothed share of label 1; repeated rows are scored each;
empty tables give empty results; other columns of ``docs`` are kept by ``accepted``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from medlattice.llm.common import cut_lineage, in_small_batches, remainder

#: rows, trees, depth, bins and step of the production model
MAX_ROWS, TREES, DEPTH, BINS, RATE, SMOOTH = 40_000, 60, 4, 64, 0.15, 1.0
ACCEPT = 0.3

STATISTICS = (
    "log_words", "word_length", "upper", "digits", "marks", "bars", "symbols", "stops", "commas", "lines_per_word",
    "distinct_words", "top_word", "same_as_previous", "distinct_lines", "distinct_pairs", "symbol_words", "high_bytes", "alpha_words",
)

_CLASSES = np.zeros((256, 10))
for _i, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?", b"|", b"#*$%&<>~^=+_@\\{}[]", b".", b",;:")):
    _CLASSES[list(_chars), _i] = 1
_CLASSES[list(b"abcdefghijklmnopqrstuvwxyz"), 7] = 1
_CLASSES[0x80:, 8] = 1
_CLASSES[list(b" \t\n\x0b\x0c\r"), 9] = 1


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text, in the order of ``STATISTICS``."""
    data = (text or "").encode("utf-8", "replace")
    found = data.split()
    n = len(found)
    if not n:
        return [0.0] * len(STATISTICS)
    upper, digits, marks, bars, symbols, stops, commas, lower, high, space = np.bincount(
        np.frombuffer(data, np.uint8), minlength=256
    ) @ _CLASSES
    letters = max(1.0, upper + lower + high)
    chars = max(1.0, len(data) - space)
    counts = Counter(found)
    lines = [line for line in data.split(b"\n") if line.strip()]
    pairs = len(set(zip(found, found[1:], strict=False)))
    same = sum(map(bytes.__eq__, found, found[1:]))
    alpha = sum(map(bytes.isalpha, found))
    symbol_words = sum(1 for w in counts if w.rstrip(b"*$%&#!|") != w)
    return [
        float(np.log1p(n)), chars / n, upper / letters, digits / chars, marks / n, bars / n, symbols / n, stops / n, commas / n,
        len(lines) / n, len(counts) / n, max(counts.values()) / n, same / n, len(set(lines)) / max(1, len(lines)),
        pairs / max(1, n - 1), symbol_words / len(counts), high / chars, alpha / n,
    ]


@dataclass(frozen=True)
class Trees:
    """``feature`` and ``limit`` hold the inner nodes of each tree by level, ``value`` its leaves."""

    base: float
    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray

    def margin(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.base)
        at_row = np.arange(len(rows))
        for feature, limit, value in zip(self.feature, self.limit, self.value, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(int(np.log2(len(value)))):
                node = 2 * node + 1 + (rows[at_row, feature[node]] > limit[node])
            out += value[node - len(feature)]
        return out

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(rows)))


def boost(rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Trees:
    """Second-order boosting of the logistic loss on bin counts."""
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    none = Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if len(labels) == 0 or labels.min() == labels.max():
        return none
    n, width = rows.shape
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], rows[:, j], side="left") for j in range(width)], axis=1)
    all_feature, all_limit, all_value = [], [], []
    margin = np.full(n, base)
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        slope, curve = labels - p, np.maximum(p * (1 - p), 1e-9)
        feature, limit, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            local = node - first
            best = np.zeros(many)
            for j in range(width):
                cell = local * bins + binned[:, j]
                g = np.bincount(cell, slope, many * bins).reshape(many, bins).cumsum(axis=1)
                h = np.bincount(cell, curve, many * bins).reshape(many, bins).cumsum(axis=1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + SMOOTH) + (g_all - g) ** 2 / (h_all - h + SMOOTH) - g_all**2 / (h_all + SMOOTH)
                gain[(h < 1.0) | (h_all - h < 1.0)] = 0
                gain = gain[:, : len(edges[j])]
                if gain.shape[1]:
                    at = gain.argmax(axis=1)
                    top = gain[np.arange(many), at]
                    better = top > best + 1e-9
                    best[better] = top[better]
                    feature[first : first + many][better] = j
                    limit[first : first + many][better] = edges[j][at[better]]
            node = 2 * node + 1 + (rows[np.arange(n), feature[node]] > limit[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, slope, leaves) / (np.bincount(leaf, curve, leaves) + SMOOTH)
        margin += value[leaf]
        all_feature.append(feature), all_limit.append(limit), all_value.append(value)
    return Trees(base, np.array(all_feature), np.array(all_limit), np.array(all_value))


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every row: one narrow pass over the texts, stored once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.array([statistics(t.as_py()) for t in batch.column("text")], dtype=np.float64).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(table[:, j]) for j in range(len(STATISTICS))]], names=["doc_id", *STATISTICS]
            )

    schema = "doc_id long, " + ", ".join(f"{name} double" for name in STATISTICS)
    return cut_lineage(in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema), "quality-statistics")


def _share_of_hashes(share: float) -> int:
    """The signed 64-bit value that about this share of all hashes lie at or below."""
    return min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))


def train(stats: DataFrame, labels: DataFrame, held_out_divisor: int = 5, max_rows: int = MAX_ROWS) -> Trees:
    """Fit on labelled rows outside the held-out remainder; at most ``max_rows`` of them reach the driver."""
    known = (
        labels.where(F.col("quality").isNotNull() & (remainder(F.col("doc_id"), held_out_divisor) != 0))
        .groupBy("doc_id").agg(F.avg("quality").alias("label"))
    )
    rows = cut_lineage(stats.join(known, "doc_id").withColumn("order", F.xxhash64("doc_id")), "quality-known")
    n, share = rows.count(), 1.0
    if n > max_rows:
        # only about as many rows as wanted are sorted and sent: those of the smallest hashes
        share = min(1.0, 1.1 * max_rows / n)
        while rows.where(F.col("order") <= _share_of_hashes(share)).count() < max_rows:
            share = min(1.0, 2 * share)
    sample = rows.where(F.col("order") <= _share_of_hashes(share)).orderBy("order", "doc_id", *STATISTICS).limit(max_rows).toPandas()
    return boost(sample[list(STATISTICS)].to_numpy(np.float64), (sample["label"].to_numpy(np.float64) >= 0.5).astype(float))


def scored(stats: DataFrame, trees: Trees) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` from stored statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = trees.probability(np.stack([batch.column(name).to_numpy() for name in STATISTICS], axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= ACCEPT).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return stats.mapInArrow(run, "doc_id long, score double, predicted int")


def accepted(docs: DataFrame, trees: Trees, least: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``least``, with the columns of ``docs``."""

    @pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        rows = np.array([statistics(t) for t in text], dtype=np.float64).reshape(-1, len(STATISTICS))
        return pd.Series(trees.probability(rows))

    return docs.where(score("text") >= least)
