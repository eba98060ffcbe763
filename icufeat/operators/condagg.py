"""One row per key from long or wide measurements, driven by feature specs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icufeat.functions.scalars import contains_any


@dataclass(frozen=True)
class Feature:
    """`agg` of SQL expression `value` over the rows where SQL predicate `when` holds.

    agg: avg, std, min, max, range, cv, count (non-null values), rows (matching
    rows), flag (1 when any row matches) or distinct.
    """

    name: str
    agg: str
    value: str | None = None
    when: str | None = None

    def column(self) -> Column:
        held = F.expr(self.when) if self.when else None
        if self.agg == "rows":
            return F.count_if(held if held is not None else F.lit(True)).alias(self.name)
        if self.agg == "flag":
            return F.max(F.when(held, 1).otherwise(0)).alias(self.name)
        x = F.expr(self.value)
        if held is not None:
            x = F.when(held, x)
        aggregated = {
            "avg": lambda: F.avg(x),
            "std": lambda: F.stddev_samp(x),
            "min": lambda: F.min(x),
            "max": lambda: F.max(x),
            "range": lambda: F.max(x) - F.min(x),
            "cv": lambda: F.try_divide(F.stddev_samp(x), F.avg(x)),
            "count": lambda: F.count(x),
            "distinct": lambda: F.count_distinct(x),
        }[self.agg]()
        return aggregated.alias(self.name)


def conditional_agg(
    df: DataFrame,
    key: str | Sequence[str],
    features: Sequence[Feature],
    *,
    where: str | Column | None = None,
    once_per: Sequence[str] = (),
    having: str | Column | None = None,
) -> DataFrame:
    """All features in a single grouped aggregate.

    `once_per` reduces the rows to the distinct (key, those columns) beforehand: a
    distinct count then becomes a row count and hot keys shrink before they meet.
    `having` filters the aggregated rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if where is not None:
        df = df.where(where)
    if once_per:
        df = df.select(*keys, *once_per).distinct()
    out = df.groupBy(*keys).agg(*[f.column() for f in features])
    return out.where(having) if having is not None else out


@dataclass(frozen=True)
class NamedMean:
    """Mean of the values whose name contains one of `words`, within [low, high] if given."""

    name: str
    words: tuple[str, ...]
    low: float | None = None
    high: float | None = None
    count_names_as: str | None = None


def named_means(
    df: DataFrame, key: str, name_col: str, value_col: str, specs: Sequence[NamedMean]
) -> DataFrame:
    """Means by substring of a measurement name.

    Sums per (key, name) come first, so the text tests run once per name instead of
    once per row and a hot key is spread over its names.
    """
    x = F.col(value_col).cast("double")
    sums = [F.sum(x).alias("__s"), F.count(x).alias("__n")]
    bounded = [i for i, s in enumerate(specs) if s.low is not None]
    for i in bounded:
        kept = F.when(x.between(specs[i].low, specs[i].high), x)
        sums += [F.sum(kept).alias(f"__s{i}"), F.count(kept).alias(f"__n{i}")]
    per_name = df.groupBy(key, name_col).agg(*sums)
    out = []
    for i, spec in enumerate(specs):
        hit = contains_any(name_col, spec.words)
        s, n = (f"__s{i}", f"__n{i}") if i in bounded else ("__s", "__n")
        out.append(
            F.try_divide(F.sum(F.when(hit, F.col(s))), F.sum(F.when(hit, F.col(n)))).alias(spec.name)
        )
    for spec in specs:
        if spec.count_names_as:
            out.append(F.count_if(contains_any(name_col, spec.words)).alias(spec.count_names_as))
    return per_name.groupBy(key).agg(*out)


def keep_keys(df: DataFrame, cohort: DataFrame | None, key: str) -> DataFrame:
    """Rows whose key is in the cohort; all rows without one.

    Apply after aggregation: one row per key moves. A family that is joined to the
    cohort anyway needs no cohort here.
    """
    if cohort is None:
        return df
    return df.join(cohort.select(key), key, "left_semi")
