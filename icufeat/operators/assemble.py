"""Putting feature families side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_rows(df: DataFrame, order: Sequence[str], limit: int | None) -> DataFrame:
    """The first `limit` rows in `order`; all rows when no limit is asked for."""
    return df if limit is None else df.orderBy(*order).limit(limit)


def assemble(
    cohort: DataFrame, required: Sequence[DataFrame], optional: Sequence[DataFrame | None], key: str
) -> DataFrame:
    """Cohort, inner-joined with the required families and left-joined with the others."""
    out = cohort
    for how, families in (("inner", required), ("left", optional)):
        for family in families:
            if family is None:
                continue
            shared = (set(out.columns) & set(family.columns)) - {key}
            if shared:
                raise ValueError(f"families share columns: {sorted(shared)}")
            out = out.join(family, key, how)
    return out


def stay_key(df: DataFrame) -> str:
    """Whichever of the two stay keys the frame has."""
    return "icustay_id" if "icustay_id" in df.columns else "patientunitstayid"


def group_column(df: DataFrame) -> str:
    """Column that identifies the patient for grouped folds."""
    for c in ("subject_id", "patientunitstayid", "icustay_id"):
        if c in df.columns:
            return c
    raise ValueError("no patient or stay column to group by")


def extraction_yield(cohort: DataFrame, families: dict[str, DataFrame], key: str) -> DataFrame:
    """(family, n_cohort, n_found, percent_found) per feature family."""
    keys = cohort.select(key).distinct()
    out = None
    for name, family in families.items():
        found = keys.join(family.select(key).distinct().withColumn("__hit", F.lit(1)), key, "left")
        row = found.agg(
            F.lit(name).alias("family"),
            F.count(F.lit(1)).alias("n_cohort"),
            F.count("__hit").alias("n_found"),
            F.try_divide(F.count("__hit") * 100.0, F.count(F.lit(1))).alias("percent_found"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def feature_coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, n_present, low, high, mean) in one pass over the frame."""
    stats = df.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in columns]
            )
        ).alias("p")
    ).select("p.feature", "p.x")
    return stats.groupBy("feature").agg(
        F.count("x").alias("n_present"), F.min("x").alias("low"), F.max("x").alias("high"), F.avg("x").alias("mean")
    )
