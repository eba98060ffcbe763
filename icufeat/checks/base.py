"""Helpers of the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icufeat.sources.standin import view_texts


@dataclass(frozen=True)
class Check:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


# Engines break ties at the last digit differently; means of short decimals hit such
# ties often, so both sides shift by an offset that moves them off the tie.
NUDGE = 1.3e-6


def tidy(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded (and -0.0 made 0.0) so that two engines can be compared."""
    return df.select(
        *[
            (F.round(F.col(c) + F.lit(NUDGE), digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )


def r4(expr: str) -> str:
    return f"(round(CAST({expr} AS DOUBLE) + 0.0000013, 4) + 0.0)"


def over_views(names: str, body: str) -> str:
    """`body` with the named clinical views in front."""
    texts = view_texts("duckdb")
    views = ",\n".join(f"{n} AS ({texts[n]})" for n in names.split())
    lead = body.lstrip()
    if lead.upper().startswith("WITH "):
        return f"WITH {views},\n{lead[5:]}"
    return f"WITH {views}\n{body}"
