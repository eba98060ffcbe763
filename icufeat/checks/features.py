"""Derived features on the assembled clinical tables."""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession

from icufeat.checks import clinical
from icufeat.checks.base import Check, over_views, r4, tidy
from icufeat.operators import features
from icufeat.operators.assemble import assemble
from icufeat.plans import external, specs

CATALOG = clinical.clinical_catalog


def long_table(spark: SparkSession, folder: str) -> DataFrame:
    """Assembled long-schema features, rounded so that both engines derive from equal inputs."""
    c, cohort = clinical.long_cohort(spark, folder)
    return tidy(clinical._assembled(c, cohort))


def wide_table(spark: SparkSession, folder: str) -> DataFrame:
    c, cohort = clinical.wide_cohort(spark, folder)
    return tidy(
        assemble(
            cohort,
            [external.pressure(c["vitalperiodic"])],
            [
                external.vitals(c["vitalperiodic"], c["nursecharting"]),
                external.labs(c["lab"]),
                external.medications(c["medication"]),
                external.temporal(c["vitalperiodic"]),
                external.comorbidities(c["diagnosis"]),
            ],
            "patientunitstayid",
        )
    )


LONG_TABLE = f"{clinical.LONG_COHORT}, {clinical.ASSEMBLED_CTES}, base AS ({clinical.ASSEMBLED_BODY})"
LONG_VIEWS = f"{clinical.LONG_BASE} {clinical.ASSEMBLED_VIEWS}"
WIDE_TABLE = (
    f"{clinical.WIDE_COHORT}, bp AS ({clinical.WIDE_BP_SQL}), vit AS ({clinical.WIDE_VITALS_SQL}),"
    f" lb AS ({clinical.WIDE_LABS_SQL}), med AS ({clinical.WIDE_MEDS_SQL}), tmp AS ({clinical.WIDE_SERIES_SQL}),"
    f" com AS ({clinical.WIDE_COMORB_SQL}), base AS (SELECT * REPLACE ({r4('CAST(icu_los_hours AS DOUBLE)')} AS icu_los_hours)"
    " FROM cohort JOIN bp USING (patientunitstayid)"
    " LEFT JOIN vit USING (patientunitstayid) LEFT JOIN lb USING (patientunitstayid)"
    " LEFT JOIN med USING (patientunitstayid) LEFT JOIN tmp USING (patientunitstayid)"
    " LEFT JOIN com USING (patientunitstayid))"
)
WIDE_VIEWS = "patient vitalperiodic nursecharting lab medication diagnosis"


def _bins(x: str, edges, labels) -> str:
    parts = " ".join(
        f"WHEN {x} > {lo} AND {x} <= {hi} THEN '{label}'" for (lo, hi), label in zip(pairwise(edges), labels, strict=True)
    )
    return f"CASE {parts} END"


def _dummies(x: str, prefix: str, labels) -> str:
    cols = [f"CASE WHEN {x} = '{v}' THEN 1 ELSE 0 END AS {prefix}_{v}" for v in labels]
    return ", ".join([*cols, f"CASE WHEN {x} IS NULL THEN 1 ELSE 0 END AS {prefix}_unknown"])


def _sum(cols) -> str:
    return " + ".join(f"coalesce({c}, 0)" for c in cols)


MEDS = features.MED_COUNTS
DERIVED = f"""
d1 AS (
  SELECT * REPLACE (coalesce(map_mean, dbp_mean + (sbp_mean - dbp_mean) / 3) AS map_mean,
                    {', '.join(f'coalesce({c}, 0) AS {c}' for c in MEDS)}),
         CASE WHEN gender = 'M' THEN 1 ELSE 0 END AS gender_male, age / 100.0 AS age_normalized,
         {_bins('age', *specs.AGE_BINS)} AS age_group,
         hr_std / nullif(hr_mean, 0) AS hr_coefficient_variation,
         hr_range * (hr_std / nullif(hr_mean, 0)) AS hr_complexity,
         sbp_mean - dbp_mean AS pulse_pressure, spo2_mean / nullif(rr_mean, 0) AS oxy_index,
         CASE WHEN hr_mean > 100 THEN 1 ELSE 0 END AS tachycardia, CASE WHEN hr_mean < 60 THEN 1 ELSE 0 END AS bradycardia,
         CASE WHEN hr_mean > 120 OR hr_mean < 50 THEN 1 ELSE 0 END AS hr_extreme,
         {_bins('sbp_mean', *specs.SBP_BINS)} AS sbp_category,
         {', '.join(f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END AS any_{c.removesuffix('_count')}" for c in MEDS)},
         {_sum(features.ANTIHYPERTENSIVES)} AS antihypertensive_count,
         CASE WHEN {_sum(features.ANTIHYPERTENSIVES)} > 0 THEN 1 ELSE 0 END AS on_antihypertensives,
         bun_mean / nullif(creatinine_mean, 0) AS bun_creatinine_ratio,
         {_sum(specs.COMORBIDITIES)} AS comorbidity_score, {_sum(specs.CV_RISKS)} AS cv_risk_score,
         CASE WHEN {_sum(specs.CV_RISKS)} >= 2 THEN 1 ELSE 0 END AS high_cv_risk
  FROM base),
d2 AS (SELECT *, {_dummies('age_group', 'age', specs.AGE_BINS[1])}, {_dummies('sbp_category', 'sbp', specs.SBP_BINS[1])} FROM d1)"""
BODY = f"""
b1 AS (SELECT *, CASE WHEN (SELECT avg(height) FROM base) > 3 THEN height / 100.0 ELSE height END AS metres FROM d2),
b2 AS (SELECT * EXCLUDE (metres), weight / nullif(metres * metres, 0) AS bmi FROM b1),
b3 AS (SELECT *, {_bins('bmi', *specs.BMI_BINS)} AS bmi_category FROM b2),
d3 AS (SELECT *, {_dummies('bmi_category', 'bmi', specs.BMI_BINS[1])} FROM b3)"""
INTERACTIONS = f"""
       hr_mean * creatinine_mean AS hr_creatinine_product, age_normalized * creatinine_mean AS age_creatinine_product,
       any_vasopressor * lactate_mean AS vasopressor_lactate_interaction,
       hr_coefficient_variation * sbp_mean AS hrv_sbp_interaction, any_beta_blocker * hr_mean AS beta_blocker_hr_effect,
       {', '.join(f"{f} * {f} AS {f}_squared, sqrt(abs({f})) AS {f}_sqrt, ln(1 + abs({f})) AS {f}_log" for f in features.EXPANDED)},
       creatinine_mean / nullif(sbp_mean, 0) AS creatinine_sbp_ratio,
       spo2_mean * hr_mean / (lactate_mean + 1) AS perfusion_index"""
OUTLIERS = ", ".join(
    f"CASE WHEN {c} >= {lo} AND {c} <= {hi} THEN {c} END AS {c}" for c, (lo, hi) in specs.EXTREME_LIMITS.items()
)
# Doubles of the finished table that need rounding before they can be compared.
ROUNDED = [
    "map_mean", "age_normalized", "hr_coefficient_variation", "hr_complexity", "pulse_pressure", "oxy_index",
    "bun_creatinine_ratio", "hr_creatinine_product", "age_creatinine_product", "vasopressor_lactate_interaction",
    "hrv_sbp_interaction", "beta_blocker_hr_effect", "creatinine_sbp_ratio", "perfusion_index",
    *[f"{f}_{k}" for f in features.EXPANDED for k in ("squared", "sqrt", "log")],
]


def finished(table: str, source: str, extra: tuple[str, ...] = ()) -> str:
    rounded = ", ".join(f"{r4(c)} AS {c}" for c in (*ROUNDED, *extra))
    return (
        f"WITH {table}, {source}, e AS (SELECT *, {INTERACTIONS} FROM {'d3' if 'd3' in source else 'd2'}),"
        f" o AS (SELECT * REPLACE ({OUTLIERS}) FROM e) SELECT * REPLACE ({rounded}) FROM o"
    )


def _long_features(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(features.build_features(long_table(spark, folder)))


def _wide_features(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(features.build_features(wide_table(spark, folder), male_codes=("M", "Male")))


def _outliers(spark: SparkSession, folder: str) -> DataFrame:
    return features.outlier_counts(wide_table(spark, folder))


WIDE_DERIVED = DERIVED.replace("gender = 'M'", "gender IN ('M', 'Male')")
OUTLIER_SQL = over_views(
    WIDE_VIEWS,
    f"WITH {WIDE_TABLE} "
    + " UNION ALL ".join(
        f'SELECT \'{c}\' AS "column", count(CASE WHEN {c} < {lo} OR {c} > {hi} THEN 1 END) AS n_replaced FROM base'
        for c, (lo, hi) in specs.EXTREME_LIMITS.items()
    ),
)

CHECKS: dict[str, Check] = {
    "derived_features_long": Check(_long_features, over_views(LONG_VIEWS, finished(LONG_TABLE, DERIVED))),
    "derived_features_wide": Check(
        _wide_features, over_views(WIDE_VIEWS, finished(WIDE_TABLE, f"{WIDE_DERIVED}, {BODY}", ("bmi",)))
    ),
    "outlier_counts": Check(_outliers, OUTLIER_SQL),
}
