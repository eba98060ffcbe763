"""Extraction from the long-event ICU schema; one row per `icustay_id`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icufeat.functions.scalars import flag, hours_between, number, years_between
from icufeat.operators.assemble import first_rows
from icufeat.operators.condagg import conditional_agg, keep_keys
from icufeat.operators.temporal import paired_series, series_statistics, typed_series, with_changes
from icufeat.plans import specs
from icufeat.session import join_small

KEY = "icustay_id"


def cohort(
    patients: DataFrame,
    admissions: DataFrame,
    icustays: DataFrame,
    *,
    ages: tuple[int, int] = (18, 89),
    min_hours: int = 24,
    limit: int | None = None,
) -> DataFrame:
    """Adult stays of at least `min_hours` clock-hour boundaries with demographics."""
    stays = icustays.withColumn("icu_los_hours", hours_between("outtime", "intime")).where(
        F.col("icu_los_hours") >= min_hours
    )
    joined = patients.join(admissions, "subject_id").withColumn("age", years_between("admittime", "dob"))
    rows = (
        joined.where(F.col("age").between(*ages))
        .join(stays, "hadm_id")
        .select(
            "subject_id",
            "gender",
            "age",
            "hadm_id",
            KEY,
            "first_careunit",
            "icu_los_hours",
            flag(F.col("deathtime").isNotNull()).alias("hospital_mortality"),
            F.col("dod").isNotNull().alias("deceased"),
            F.year("admittime").alias("admit_year"),
            "insurance",
            "language",
            "ethnicity",
        )
        .distinct()
    )
    return first_rows(rows, ["subject_id", KEY], limit)


def valid_chart(chartevents: DataFrame, codes: tuple[int, ...]) -> DataFrame:
    """Unflagged rows of the given codes with the value as number `num`."""
    return chartevents.where(F.col("itemid").isin(*codes) & F.col("error").isNull()).withColumn(
        "num", number("value")
    )


def pressure(chartevents: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    out = conditional_agg(
        valid_chart(chartevents, specs.LONG_PRESSURE_CODES),
        KEY,
        specs.LONG_PRESSURE,
        where="num BETWEEN 30 AND 300",
        having="sbp_mean IS NOT NULL AND dbp_mean IS NOT NULL",
    )
    return keep_keys(out, keys, KEY)


def vitals(chartevents: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    rows = valid_chart(chartevents, specs.LONG_VITAL_CODES)
    return keep_keys(conditional_agg(rows, KEY, specs.LONG_VITALS), keys, KEY)


def pressure_and_vitals(chartevents: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Both families from one scan and one shuffle; the stays of `pressure`.

    The row filter of the pressure family moves into its value: a pressure reading
    outside the range counts for nothing, exactly as if its row were gone.
    """
    rows = valid_chart(chartevents, specs.LONG_PRESSURE_CODES + specs.LONG_VITAL_CODES).where(
        f"NOT {specs.codes(specs.LONG_PRESSURE_CODES)} OR num BETWEEN 30 AND 300"
    )
    out = conditional_agg(
        rows,
        KEY,
        specs.LONG_PRESSURE + specs.LONG_VITALS,
        having="sbp_mean IS NOT NULL AND dbp_mean IS NOT NULL",
    )
    return keep_keys(out, keys, KEY)


def labs(icustays: DataFrame, labevents: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Lab means of the admission; stays without any listed lab do not appear.

    The means are taken per admission before the join, so only one row per
    admission moves to its stays.
    """
    rows = labevents.where(F.col("itemid").isin(*specs.LAB_CODES.values())).withColumn("num", number("value"))
    per_admission = conditional_agg(rows, "hadm_id", specs.LONG_LABS)
    stays = keep_keys(icustays.select(KEY, "hadm_id"), keys, KEY)
    return stays.join(per_admission, "hadm_id").drop("hadm_id")


def medications(inputevents: DataFrame, d_items: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Infusion rows per drug class; rewritten and status-less rows are left out.

    Rows are counted per (stay, item) first: the dictionary join and the label
    tests then see each item of a stay once.
    """
    counted = (
        inputevents.where(F.col("statusdescription") != "Rewritten")
        .groupBy(KEY, "itemid")
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    labelled = join_small(counted, d_items.select("itemid", "label"), ["itemid"])
    zero = F.lit(0).cast("bigint")
    out = labelled.groupBy(KEY).agg(
        *[
            F.sum(F.when(F.expr(f.when), F.col("__n")).otherwise(zero)).alias(f.name)
            for f in specs.drug_flags(specs.DRUG_CLASSES, "label")
        ]
    )
    return keep_keys(out, keys, KEY)


def series(chartevents: DataFrame) -> DataFrame:
    rows = valid_chart(chartevents, specs.LONG_SERIES_CODES)
    return typed_series(rows, [KEY, "charttime", "itemid"], specs.LONG_SERIES, "num")


def temporal(chartevents: DataFrame, keys: DataFrame | None = None, *, paired: bool = False) -> DataFrame:
    """Variability features.

    By default a change is the step between neighbouring rows of any vital and the
    cross-vital correlations, which need two vitals on one row, stay null. `paired`
    puts the vitals of one moment side by side and steps over gaps.
    """
    # Only stays of the cohort are windowed.
    rows = series(keep_keys(chartevents, keys, KEY)).where(F.col(KEY).isNotNull())
    if paired:
        rows = paired_series(rows, KEY, "charttime", list(specs.LONG_SERIES))
        changes = with_changes(rows, KEY, "charttime", ["sbp", "hr"], skip_nulls=True)
    else:
        changes = with_changes(rows, KEY, "charttime", ["sbp", "hr"], ties=["itemid"])
    return series_statistics(changes, KEY, "charttime")


def comorbidities(icustays: DataFrame, diagnoses: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    per_admission = conditional_agg(diagnoses, "hadm_id", specs.ICD9_FLAGS, once_per=["icd9_code"])
    stays = keep_keys(icustays.select(KEY, "hadm_id"), keys, KEY)
    return stays.join(per_admission, "hadm_id").drop("hadm_id")
