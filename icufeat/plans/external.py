"""Extraction from the wide-vitals ICU schema; one row per `patientunitstayid`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icufeat.functions.scalars import flag, minutes_to_hours, number, whole
from icufeat.operators.assemble import first_rows
from icufeat.operators.bandjoin import band_left_join, weighted_avg, weighted_std
from icufeat.operators.condagg import conditional_agg, keep_keys, named_means
from icufeat.plans import specs

KEY = "patientunitstayid"


def age_years(c: str = "age") -> Column:
    """Age text to years; the top-coded '> 89' becomes 90."""
    return F.when(F.col(c) == "> 89", F.lit(90).cast("bigint")).otherwise(whole(c))


def cohort(
    patient: DataFrame, *, ages: tuple[int, int] = (18, 89), min_minutes: int = 1440, limit: int | None = None
) -> DataFrame:
    rows = (
        patient.withColumn("age", age_years())
        .where(F.col("age").between(*ages) & (F.col("unitdischargeoffset") > min_minutes))
        .select(
            KEY,
            "patienthealthsystemstayid",
            "gender",
            "age",
            flag(F.col("unitdischargestatus") == "Expired").alias("hospital_mortality"),
            F.col("unittype").alias("first_careunit"),
            minutes_to_hours("unitdischargeoffset").alias("icu_los_hours"),
            "ethnicity",
            "hospitaladmitsource",
            F.col("admissionheight").alias("height"),
            F.col("admissionweight").alias("weight"),
            F.lit("Unknown").alias("insurance"),
            F.lit("Unknown").alias("language"),
            "hospitalid",
            "wardid",
            "apacheadmissiondx",
        )
        .distinct()
    )
    return first_rows(rows, [KEY], limit)


def pressure(vitalperiodic: DataFrame, keys: DataFrame | None = None, *, strict: bool = False) -> DataFrame:
    """Blood-pressure statistics; `strict` uses the check variant's ranges and counts."""
    having = "sbp_mean IS NOT NULL AND dbp_mean IS NOT NULL AND sbp_count >= 2"
    if strict:
        out = conditional_agg(
            vitalperiodic, KEY, specs.STRICT_PRESSURE, having=having + " AND dbp_count >= 2"
        )
    else:
        out = conditional_agg(
            vitalperiodic, KEY, specs.WIDE_PRESSURE, where=specs.WIDE_PRESSURE_ROWS, having=having
        )
    return keep_keys(out, keys, KEY)


def vitals(
    vitalperiodic: DataFrame, nursecharting: DataFrame, keys: DataFrame | None = None, *, minutes: int = 60, fan_out: bool = True
) -> DataFrame:
    """Vitals with the coma score charted within `minutes` of a vital row.

    With `fan_out` a vital row weighs as much as the chart rows in its band, which
    is what aggregating over the joined pairs gives. Without it every vital row
    counts once and the coma score is the mean over charted matches alike.
    """
    name = F.col("nursingchartcelltypevalname")
    score = F.when(name.contains("Glasgow") | name.contains("GCS"), number("nursingchartvalue"))
    # Only stays of the cohort are windowed.
    rows, notes = keep_keys(vitalperiodic, keys, KEY), keep_keys(nursecharting, keys, KEY)
    joined = band_left_join(rows, notes, KEY, "observationoffset", "nursingchartoffset", minutes, score)
    valid_values = {out: F.when(F.expr(valid), F.col(source)) for out, _, source, valid in specs.WIDE_VITALS}
    spreads = [out for out, agg, _, _ in specs.WIDE_VITALS if agg == "std"]
    centres = rows.groupBy(KEY).agg(*[F.avg(valid_values[out]).alias(f"__centre_{out}") for out in spreads])
    joined = joined.join(centres, KEY, "left")
    weight = F.col("fan_out") if fan_out else F.lit(1).cast("bigint")
    columns = []
    for out, agg, _, _ in specs.WIDE_VITALS:
        x = valid_values[out]
        column = {
            "avg": lambda x=x: weighted_avg(x, weight),
            "std": lambda x=x, out=out: weighted_std(x, weight, F.col(f"__centre_{out}")),
            "min": lambda x=x: F.min(x),
            "max": lambda x=x: F.max(x),
        }[agg]()
        columns.append(column.alias(out))
    gcs = F.try_divide(F.sum("sum_values"), F.sum("n_values")).alias("gcs_mean")
    return joined.groupBy(KEY).agg(*columns, gcs)


def strict_vitals(vitalperiodic: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Check variant: tight ranges, valid-measurement counts, no coma score."""
    out = conditional_agg(
        vitalperiodic,
        KEY,
        specs.STRICT_VITALS,
        having="hr_mean IS NOT NULL OR rr_mean IS NOT NULL OR spo2_mean IS NOT NULL",
    )
    return keep_keys(out, keys, KEY)


def labs(lab: DataFrame, keys: DataFrame | None = None, *, strict: bool = False) -> DataFrame:
    rows = lab.where(F.col("labresult") > 0)
    chosen = specs.STRICT_LABS if strict else specs.NAMED_LABS
    return keep_keys(named_means(rows, KEY, "labname", "labresult", chosen), keys, KEY)


def medications(medication: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Distinct drug names per class."""
    out = conditional_agg(
        medication,
        KEY,
        specs.drug_flags(specs.EXTERNAL_DRUG_CLASSES, "drugname"),
        where="drugname IS NOT NULL",
        once_per=["drugname"],
    )
    return keep_keys(out, keys, KEY)


def temporal(vitalperiodic: DataFrame, keys: DataFrame | None = None, *, min_rows: int = 3) -> DataFrame:
    out = conditional_agg(
        vitalperiodic,
        KEY,
        specs.WIDE_SERIES,
        where=specs.WIDE_SERIES_ROWS,
        having=f"total_measurements >= {min_rows}",
    )
    return keep_keys(out, keys, KEY)


def comorbidities(diagnosis: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    out = conditional_agg(
        diagnosis,
        KEY,
        specs.DIAGNOSIS_FLAGS,
        where="diagnosisstring IS NOT NULL",
        once_per=["diagnosisstring"],
    )
    return keep_keys(out, keys, KEY)
