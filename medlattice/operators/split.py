"""Splits, folds and shuffles that depend on keys, never on partitioning."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlattice.functions.hashing import MODULUS, key_hash
from medlattice.session import broadcast_if_small, cut_lineage

#: ranges the hash space is cut into; a hot label is spread over all of them
HASH_RANGES = 4096

#: labels whose cut points are held by the driver and broadcast; more labels are joined instead
BROADCAST_LABELS = 10_000


def hash_split(df: DataFrame, key: str = "patient_id", train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """Append ``is_train``: a narrow step, each row decided by its own key."""
    bound = round(train_share * 10000)
    return df.withColumn("is_train", key_hash(key, seed) % 10000 < bound)


def _hash_range(hashed: Column) -> Column:
    return F.floor(hashed * HASH_RANGES / MODULUS).cast("int")


@dataclass(frozen=True)
class HashCuts:
    """Per label, the (hash, key) points that part its rows into exact shares.

    ``transform`` only compares each row with its label's points: no rows move.
    """

    points: DataFrame
    cuts: int
    small: bool
    label: str
    key: str
    seed: int

    def transform(self, df: DataFrame) -> DataFrame:
        """Append ``part``: how many of the cuts lie before the row. A cut that leaves no row
        before it has no point, so cuts not yet reached are counted instead."""
        joined = df.join(self.points, F.col(self.label).eqNullSafe(F.col("_label")), "left")
        at = F.struct(key_hash(self.key, self.seed).alias("hash"), F.col(self.key).cast("bigint").alias("key"))
        ahead = F.filter("_cuts", lambda c: at <= F.struct(c["hash"].alias("hash"), c["key"].alias("key")))
        part = F.lit(self.cuts) - F.coalesce(F.size(ahead), F.lit(0))
        return joined.withColumn("part", part).drop("_label", "_cuts")


def fit_cuts(
    df: DataFrame, label: str, last_rank: Callable[[Column], Sequence[Column]], key: str = "patient_id", seed: int = 42
) -> HashCuts:
    """Find the cut points of every label.

    ``last_rank`` maps the label's row count to the rank of the last row before each cut. Rows
    are counted per (label, hash range); only the ranges that hold a cut, a few thousandths of
    a label, are ranked. A label with a third of all rows costs no task more than that.
    """
    keyed = df.select(
        F.col(label).alias("_label"), F.col(key).cast("bigint").alias("_key"), key_hash(key, seed).alias("_hash")
    ).withColumn("_range", _hash_range(F.col("_hash")))
    counts = keyed.groupBy("_label", "_range").agg(F.count(F.lit(1)).alias("_n"))
    per_label = Window.partitionBy("_label")
    upto = per_label.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    located = counts.select(
        "_label", "_range", "_n", F.sum("_n").over(upto).alias("_end"), F.sum("_n").over(per_label).alias("_total")
    )
    cut_ranks = last_rank(F.col("_total"))
    ranks = F.array(*[r.cast("bigint") for r in cut_ranks])
    wanted = (
        located.select("_label", "_range", "_n", "_end", F.posexplode(ranks).alias("_cut", "_rank"))
        .filter((F.col("_rank") <= F.col("_end")) & (F.col("_rank") > F.col("_end") - F.col("_n")))
        .select(
            F.col("_label").alias("_w_label"), F.col("_range").alias("_w_range"), "_cut",
            (F.col("_rank") - F.col("_end") + F.col("_n")).alias("_local"),
        )
    )
    wanted, _ = broadcast_if_small(wanted, "cut-ranges", BROADCAST_LABELS * len(cut_ranks))
    near = keyed.join(
        wanted, F.col("_label").eqNullSafe(F.col("_w_label")) & (F.col("_range") == F.col("_w_range"))
    )
    order = Window.partitionBy("_label", "_range", "_cut").orderBy("_hash", "_key")
    cuts = (
        near.withColumn("_rn", F.row_number().over(order))
        .filter(F.col("_rn") == F.col("_local"))
        .groupBy("_label")
        .agg(F.collect_list(F.struct(F.col("_hash").alias("hash"), F.col("_key").alias("key"))).alias("_cuts"))
    )
    points, small = broadcast_if_small(cuts, "cuts", BROADCAST_LABELS)
    return HashCuts(points, len(cut_ranks), small, label, key, seed)


def stratified_split(
    df: DataFrame, label: str, key: str = "patient_id", train_share: float = 0.8, seed: int = 42
) -> DataFrame:
    """Append ``is_train``: in hash order, the first share of every label's rows, to the row."""
    share = round(train_share * 10000)
    cuts = fit_cuts(df, label, lambda n: [F.floor(n * share / 10000)], key, seed)
    return cuts.transform(df).withColumn("is_train", F.col("part") == 0).drop("part")


def stratified_folds(
    df: DataFrame, label: str, folds: int = 3, key: str = "patient_id", seed: int = 42
) -> DataFrame:
    """Append ``fold`` 0..folds-1: consecutive equal shares of every label in hash order."""
    cuts = fit_cuts(df, label, lambda n: [F.floor(n * i / folds) for i in range(1, folds)], key, seed)
    return cuts.transform(df).withColumnRenamed("part", "fold")


def rank_by_hash(df: DataFrame, key: str = "patient_id", seed: int = 42) -> DataFrame:
    """Append ``position``: the 1-based place of every row in hash order; rows are written in that order.

    One exchange: rows are ranged by sampled bounds of (hash, key) and sorted in their range; how many rows the ranges
    before hold is one number per partition. The number of ranges is the session's, not a constant.
    """
    hashed = df.withColumn("_hash", key_hash(key, seed)).repartitionByRange("_hash", key).sortWithinPartitions("_hash", key)
    # partition number above the row's place in it
    placed = cut_lineage(hashed.withColumn("_at", F.monotonically_increasing_id()), "hash-order").drop("_hash")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition reaches this window and is broadcast
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = placed.join(F.broadcast(starts), part == F.col("_part"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1).cast("long"))
    return joined.withColumn("position", F.col("_before") + place + 1).drop("_at", "_part", "_before")


def seeded_shuffle(df: DataFrame, key: str = "patient_id", seed: int = 42) -> DataFrame:
    """Rows with their position in hash order, in the partitions and the order they were written in."""
    return rank_by_hash(df, key, seed)
