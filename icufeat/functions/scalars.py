"""Scalar and aggregate expressions shared by the operators.

ANSI mode stays on, so casts and divisions go through their `try_` forms.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: str | Column) -> Column:
    """Text to double; text that is no number, and NaN, become null."""
    x = as_col(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def whole(c: str | Column) -> Column:
    return as_col(c).try_cast("bigint")


def ratio(a: str | Column, b: str | Column) -> Column:
    return F.try_divide(as_col(a), as_col(b))


def years_between(later: str | Column, earlier: str | Column) -> Column:
    """Number of calendar-year boundaries crossed."""
    return F.year(as_col(later)) - F.year(as_col(earlier))


def hours_between(later: str | Column, earlier: str | Column) -> Column:
    """Number of clock-hour boundaries crossed, not elapsed hours."""
    start, end = F.date_trunc("HOUR", as_col(earlier)), F.date_trunc("HOUR", as_col(later))
    return F.timestamp_diff("HOUR", start, end)


def epoch_seconds(ts: str | Column) -> Column:
    return F.unix_seconds(as_col(ts).cast("timestamp"))


def epoch_micros(ts: str | Column) -> Column:
    return F.unix_micros(as_col(ts).cast("timestamp"))


def minutes_to_hours(c: str | Column) -> Column:
    x = as_col(c)
    return F.when(x > 0, x / F.lit(60.0))


def right_closed_bins(
    c: str | Column, edges: Sequence[float], labels: Sequence[str], outside: str | None = None
) -> Column:
    """Label of the bin (edges[i], edges[i+1]] that holds the value."""
    x = as_col(c)
    binned = F.when(F.lit(False), F.lit(None).cast("string"))
    for (low, high), label in zip(pairwise(edges), labels, strict=True):
        binned = binned.when((x > low) & (x <= high), F.lit(label))
    return binned.otherwise(F.lit(outside).cast("string"))


def left_closed_bins(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin [edges[i], edges[i+1]) that holds the value."""
    x = as_col(c)
    binned = F.when(F.lit(False), F.lit(None).cast("string"))
    for (low, high), label in zip(pairwise(edges), labels, strict=True):
        binned = binned.when((x >= low) & (x < high), F.lit(label))
    return binned


def contains_any(c: str | Column, words: Sequence[str]) -> Column:
    """Case-blind test for any of some literal words."""
    text = F.lower(as_col(c))
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is null."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def sum_present(cols: Sequence[str]) -> Column:
    """Row-wise sum that counts null as zero."""
    total = F.lit(0)
    for c in cols:
        total = total + F.coalesce(F.col(c), F.lit(0))
    return total


def correlation(x: str | Column, y: str | Column) -> Column:
    """Pearson over rows that have both values; null when one of them never varies."""
    x, y = as_col(x), as_col(y)
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def percent(condition: Column) -> Column:
    """Share of rows, in percent, for which the condition holds; null rows do not count."""
    return F.avg(F.when(condition, F.lit(100.0)).when(~condition, F.lit(0.0)))
