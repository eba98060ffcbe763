"""Running sums and neighbour lookups that survive a hot key.

A plain window puts a whole key into one task. Here each key is cut into buckets
that follow the sort order; the window runs inside a bucket, and one summary row
per bucket carries the state of the earlier buckets across.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _attach(df: DataFrame, carry: DataFrame, keys: Sequence[str], plain: Sequence[str] = ()) -> DataFrame:
    """Left join of a row per key. Keys in `plain` are never null: equality keeps the partitioning that the window made."""
    carry = carry.withColumnsRenamed({k: f"__c_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        same = df[k] == carry[f"__c_{k}"] if k in plain else df[k].eqNullSafe(carry[f"__c_{k}"])
        condition = condition & same
    return df.join(carry, condition, "left").drop(*[f"__c_{k}" for k in keys])


def running_sums(
    df: DataFrame, parts: Sequence[str], bucket: str, order: Sequence[Column], sums: Mapping[str, Column]
) -> DataFrame:
    """Adds inclusive running sums per `parts`, in `order`; buckets must be in that order too."""
    keys = [*parts, bucket]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*parts).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumns({name: F.sum(e).over(inside) for name, e in sums.items()})
    carry = (
        df.groupBy(*keys)
        .agg(*[F.sum(e).alias(f"__t_{n}") for n, e in sums.items()])
        .select(*keys, *[F.sum(f"__t_{n}").over(earlier).alias(f"__p_{n}") for n in sums])
    )
    joined = _attach(local, carry, keys)
    total = {
        n: F.coalesce(F.col(n), F.lit(0)) + F.coalesce(F.col(f"__p_{n}"), F.lit(0)) for n in sums
    }
    return joined.withColumns(total).drop(*[f"__p_{n}" for n in sums])


def previous_values(
    df: DataFrame,
    key: str,
    bucket: str,
    order: Sequence[str],
    columns: Mapping[str, str],
    *,
    skip_nulls: bool = False,
) -> DataFrame:
    """Adds, for each `new: source` of `columns`, the source value of the preceding row.

    `skip_nulls` looks back to the last row that has a value instead. `order` must
    be unique within the key for a repeatable result. Rows without a key, or without a
    bucket, have no place on a time line and get null.
    """
    keys = [key, bucket]
    inside = Window.partitionBy(*keys).orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    by_bucket = Window.partitionBy(key).orderBy(bucket)
    rank = F.struct(*order)

    local = df.withColumn("__first", F.row_number().over(inside) == 1)
    summary = df.groupBy(*keys)
    if skip_nulls:
        local = local.withColumns({n: F.last(s, ignorenulls=True).over(before) for n, s in columns.items()})
        summary = summary.agg(
            *[F.max_by(s, F.when(F.col(s).isNotNull(), rank)).alias(f"__s_{n}") for n, s in columns.items()]
        )
        look = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
        carry = {n: F.last(f"__s_{n}", ignorenulls=True).over(look) for n in columns}
    else:
        local = local.withColumns({n: F.lag(s).over(inside) for n, s in columns.items()})
        summary = summary.agg(*[F.max_by(s, rank).alias(f"__s_{n}") for n, s in columns.items()])
        carry = {n: F.lag(f"__s_{n}").over(by_bucket) for n in columns}
    carried = summary.select(*keys, *[c.alias(f"__p_{n}") for n, c in carry.items()])
    joined = _attach(local, carried, keys, plain=keys)
    if skip_nulls:
        filled = {n: F.coalesce(F.col(n), F.col(f"__p_{n}")) for n in columns}
    else:
        filled = {n: F.when(F.col("__first"), F.col(f"__p_{n}")).otherwise(F.col(n)) for n in columns}
    return joined.withColumns(filled).drop("__first", *[f"__p_{n}" for n in columns])
