"""Exact quantiles, ranks and modes without putting a whole group into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icufeat.functions.prefix import running_sums
from icufeat.session import cut_lineage, join_small

SKETCH_ACCURACY = 100_000


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, probs: Mapping[str, float]
) -> DataFrame:
    """One row per group with the linearly interpolated quantile for each `name: p`.

    A sketch brackets every wanted rank. A second pass counts the rows under and
    over the bracket and keeps only the distinct values inside it, so the final
    sort sees a tiny share of a hot group, and the answer is exact.
    """
    names = list(probs)
    margin = 2.0 / SKETCH_ACCURACY
    asked = []
    for name in names:
        asked += [max(probs[name] - margin, 0.0), min(probs[name] + margin, 1.0)]
    held = df.select(
        *[F.col(g) for g in groups], F.col(value).cast("double").alias("__v"), F.lit(0).alias("__all")
    ).where(F.col("__v").isNotNull())
    by = [*groups, "__all"]
    sketch = held.groupBy(*by).agg(
        F.count("__v").alias("__n"),
        F.percentile_approx("__v", F.array(*[F.lit(p) for p in asked]), F.lit(SKETCH_ACCURACY)).alias("__b"),
    )
    bracketed = join_small(held, sketch, by)

    def zoned(i: int, name: str) -> Column:
        low, high = F.col("__b")[2 * i], F.col("__b")[2 * i + 1]
        zone = F.when(F.col("__v") < low, F.lit(-1)).when(F.col("__v") > high, F.lit(1)).otherwise(F.lit(0))
        at = F.when(zone == 0, F.col("__v"))
        return F.struct(
            F.lit(name).alias("q"), F.lit(float(probs[name])).alias("p"), zone.alias("zone"), at.alias("at")
        )

    spread = bracketed.select(
        *by, "__v", "__n", F.explode(F.array(*[zoned(i, n) for i, n in enumerate(names)])).alias("z")
    ).select(*by, "__v", "__n", "z.q", "z.p", "z.zone", "z.at")
    counted = spread.groupBy(*by, "q", "zone", "at").agg(
        F.count(F.lit(1)).alias("c"),
        F.max("__n").alias("n"),
        F.max("p").alias("p"),
        F.min("__v").alias("lo"),
        F.max("__v").alias("hi"),
    )
    # Below the bracket only the largest value can be wanted, above it only the smallest.
    points = counted.withColumn("v", F.when(F.col("zone") == 1, F.col("lo")).otherwise(F.col("hi")))
    inside = (
        Window.partitionBy(*by, "q").orderBy("zone", "v").rowsBetween(Window.unboundedPreceding, 0)
    )
    position = (F.col("n") - 1) * F.col("p")
    ranked = points.withColumns({"top": F.sum("c").over(inside), "pos": position}).withColumn(
        "below", F.col("top") - F.col("c")
    )

    def at_rank(k: Column) -> Column:
        hit = (k >= F.col("below")) & (k < F.col("top"))
        usable = (
            (F.col("zone") == 0)
            | ((F.col("zone") == 1) & (k == F.col("below")))
            | ((F.col("zone") == -1) & (k == F.col("top") - 1))
        )
        missed = F.raise_error(F.lit("quantile fell outside its bracket")).cast("double")
        return F.max(F.when(hit, F.when(usable, F.col("v")).otherwise(missed)))

    low, high = at_rank(F.floor("pos")), at_rank(F.ceil("pos"))
    per_q = ranked.groupBy(*by, "q").agg((low + (F.max("pos") - F.floor(F.max("pos"))) * (high - low)).alias("x"))
    wide = per_q.groupBy(*by).agg(*[F.max(F.when(F.col("q") == n, F.col("x"))).alias(n) for n in names])
    return wide.drop("__all")


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """(column, quantile…) for several numeric columns, nulls left out."""
    return exact_quantiles(unpivoted(df, columns), ["column"], "value", probs)


def unpivoted(df: DataFrame, columns: Sequence[str], as_type: str = "double") -> DataFrame:
    """(column, value) rows of the given columns."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast(as_type).alias("value")) for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("__p")).select("__p.column", "__p.value")


def ordered_parts(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """`df` stored in range partitions by `order`, with the number of each row's partition as `__part`.

    Ties in one column are parted by the next, so a value that most rows have takes many partitions.
    """
    return cut_lineage(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))


def ranks_of(tallied: DataFrame, groups: Sequence[str], value: str, n: str) -> DataFrame:
    """Adds `n_below` and `average_rank` to rows of distinct values per group that stand for `n` rows each."""
    placed = ordered_parts(tallied.withColumn("__all", F.lit(0)), [*groups, value])
    summed = running_sums(placed, [*groups, "__all"], "__part", [F.col(value)], {"__upto": F.col(n)})
    below = F.col("__upto") - F.col(n)
    ranks = {"n_below": below, "average_rank": below + (F.col(n) + 1) / F.lit(2.0)}
    return summed.withColumns(ranks).drop("__all", "__part", "__upto")


def exact_ranks(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """(groups…, value, n_tied, n_below, average_rank) per distinct value.

    Equal values collapse before the shuffle, and the distinct ones lie in ranges, so a
    hot group is spread over many tasks.
    """
    tallied = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n_tied"))
    return ranks_of(tallied, groups, value, "n_tied")


def modes(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """Most frequent value per group, the smallest one when tied; nulls do not count."""
    tallied = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("__n"))
    best = F.min(F.struct((-F.col("__n")).alias("rank"), F.col(value).alias("value")))
    return tallied.groupBy(*groups).agg(best.alias("__m")).select(*groups, F.col("__m.value").alias("mode"))
