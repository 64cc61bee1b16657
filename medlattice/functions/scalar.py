"""Small scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clip(value: Column | str, low, high) -> Column:
    """``value`` limited to ``[low, high]``; null stays null (``least`` alone would skip it)."""
    value = as_column(value)
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def literal_array(values: Sequence) -> Column:
    """Array literal built in one call, however many values it has."""
    def text(value) -> str:
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"{value!r}D" if isinstance(value, float) else repr(value)

    return F.expr(f"array({', '.join(text(v) for v in values)})")


def pick(values: Sequence, index: Column) -> Column:
    """Element of a literal list at a 0-based index: a lookup without a join."""
    return F.element_at(literal_array(values), (index + F.lit(1)).cast("int"))


def decode(labels: Sequence[str], code: Column | str, unknown: str = "Unknown") -> Column:
    """Class name for an integer code, ``unknown`` outside the label list or for null."""
    code = as_column(code)
    known = (code >= 0) & (code < len(labels))
    safe = F.when(known, code).otherwise(F.lit(0))
    return F.when(known, pick(labels, safe)).otherwise(F.lit(unknown))


def rounded(value: Column | str, digits: int = 6) -> Column:
    """Rounded double without negative zero, so that text comparisons are stable."""
    return F.round(as_column(value), digits) + F.lit(0.0)


def cumulative_pick(percent: Column, labels: Sequence[str], weights: Sequence[Column | int]) -> Column:
    """Weighted choice: the first label whose running weight exceeds ``percent`` (0-99)."""
    bound: Column = F.lit(0)
    chain: Column | None = None
    for label, weight in zip(labels[:-1], weights[:-1], strict=True):
        bound = bound + weight
        hit = percent < bound
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return F.lit(labels[-1]) if chain is None else chain.otherwise(F.lit(labels[-1]))
