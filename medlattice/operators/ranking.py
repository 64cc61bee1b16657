"""Top classes and top contributions inside one row's array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlattice.functions.scalar import as_column


def confidence(probability: Column | str, prediction: Column | str) -> Column:
    """Probability of the predicted class."""
    return F.get(as_column(probability), as_column(prediction).cast("int"))


def arg_max(probability: Column | str) -> Column:
    """Most probable class as double; ties go to the smaller class."""
    probability = as_column(probability)
    return (F.array_position(probability, F.array_max(probability)) - 1).cast("double")


def top_classes(probability: Column | str, n: int = 3) -> Column:
    """The ``n`` most probable classes as (class, probability), ties by smaller class."""
    entries = F.transform(
        as_column(probability), lambda p, i: F.struct((-p).alias("neg"), i.alias("class"), p.alias("probability"))
    )
    best = F.slice(F.array_sort(entries), 1, n)
    return F.transform(best, lambda e: F.struct(e["class"].alias("class"), e["probability"].alias("probability")))


def top_contributions(contributions: Column | str, n: int | None = 5) -> Column:
    """Contributions by falling magnitude, ties by feature name; all of them if ``n`` is None."""
    entries = F.transform(
        as_column(contributions),
        lambda e: F.struct(
            (-F.abs(e["value"])).alias("neg"), e["feature"].alias("feature"), e["value"].alias("value")
        ),
    )
    ordered = F.array_sort(entries)
    best = ordered if n is None else F.slice(ordered, 1, n)
    return F.transform(best, lambda e: F.struct(e["feature"].alias("feature"), e["value"].alias("value")))


def explode_ranked(df: DataFrame, keys: list[str], array: str) -> DataFrame:
    """One row per array entry with its 1-based ``rank``."""
    return (
        df.select(*keys, F.posexplode(array).alias("pos", "entry"))
        .select(*keys, (F.col("pos") + 1).cast("bigint").alias("rank"), "entry.*")
    )

