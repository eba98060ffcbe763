"""What data is there: availability and value frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) per table."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


def availability(df: DataFrame, key: str, value: str, where: str | Column) -> DataFrame:
    """Distinct keys, measurements and value range of the rows that qualify."""
    return df.where(where).agg(
        F.count_distinct(key).alias("n_keys"),
        F.count(F.lit(1)).alias("n_measurements"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.avg(value).alias("avg_value"),
    )


def top_values(df: DataFrame, column: str, k: int, where: str | Column | None = None) -> DataFrame:
    """The k most frequent values, ties by value."""
    rows = df if where is None else df.where(where)
    return (
        rows.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("n_rows"), column)
        .limit(k)
    )
