"""Cohorts, extraction and profiles on the clinical views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icufeat.checks.base import Check, over_views, r4, read, tidy
from icufeat.operators.assemble import assemble, extraction_yield, feature_coverage
from icufeat.operators.bandjoin import band_left_join
from icufeat.operators.condagg import Feature, conditional_agg, keep_keys
from icufeat.functions.scalars import epoch_micros, number
from icufeat.operators.temporal import typed_series, with_changes
from icufeat.plans import external, internal, specs
from icufeat.sources.profile import availability, row_counts, top_values
from icufeat.sources.standin import clinical_catalog

# --- comparison SQL -------------------------------------------------------------------

# Stays with their patient and admission, measured once; the limits apply to the measured columns.
LONG_COHORT = """timed_stays AS (
  SELECT s.icustay_id, s.first_careunit, v.*, date_diff('hour', s.intime, s.outtime) AS icu_los_hours
  FROM icustays s
  JOIN (
    SELECT w.hadm_id, w.insurance, w.language, w.ethnicity, year(w.admittime) AS admit_year,
           CAST(w.deathtime IS NOT NULL AS INTEGER) AS hospital_mortality,
           who.subject_id, who.gender, who.dod IS NOT NULL AS deceased, date_diff('year', who.dob, w.admittime) AS age
    FROM admissions w JOIN patients who USING (subject_id)
  ) v USING (hadm_id)
), cohort AS (
  SELECT DISTINCT subject_id, gender, age, hadm_id, icustay_id, first_careunit, icu_los_hours, hospital_mortality,
         deceased, admit_year, insurance, language, ethnicity
  FROM timed_stays WHERE icu_los_hours >= 24 AND age >= 18 AND age <= 89)"""

# The age text becomes a number and the offset hours before anything is asked of them.
WIDE_COHORT = """measured AS (
  SELECT *, coalesce(TRY_CAST(nullif(age, '') AS BIGINT), CASE age WHEN '> 89' THEN 90 END) AS years,
         CASE WHEN unitdischargeoffset > 0 THEN unitdischargeoffset / 60.0 END AS hours,
         CAST(coalesce(unitdischargestatus = 'Expired', FALSE) AS INTEGER) AS died
  FROM patient
), cohort AS (
  SELECT DISTINCT m.* EXCLUDE (age, years, hours, died, unitdischargestatus, unittype, unitdischargeoffset, admissionheight, admissionweight),
         years AS age, hours AS icu_los_hours, died AS hospital_mortality, unittype AS first_careunit,
         admissionheight AS height, admissionweight AS weight, 'Unknown' AS insurance, 'Unknown' AS language
  FROM measured m WHERE years >= 18 AND years <= 89 AND unitdischargeoffset > 1440)"""

LONG_BASE = "patients admissions icustays"


def _in(values) -> str:
    return "(" + ", ".join(str(v) for v in values) + ")"


def _sql_stats(prefix: str, x: str, aggs: str) -> str:
    call = {
        "mean": f"{r4(f'avg({x})')} AS {prefix}_mean",
        "std": f"{r4(f'stddev_samp({x})')} AS {prefix}_std",
        "min": f"{r4(f'min({x})')} AS {prefix}_min",
        "max": f"{r4(f'max({x})')} AS {prefix}_max",
        "count": f"count({x}) AS {prefix}_count",
    }
    return ", ".join(call[a] for a in aggs.split())


def _coded(values) -> str:
    return f"CASE WHEN itemid IN {_in(values)} THEN num END"


CHART = "chart AS (SELECT *, TRY_CAST(nullif(value, '') AS DOUBLE) AS num FROM chartevents WHERE error IS NULL)"
LONG_BP_SQL = f"""
  SELECT icustay_id, {_sql_stats('sbp', _coded(specs.SBP_CODES), 'mean std count min max')},
         {_sql_stats('dbp', _coded(specs.DBP_CODES), 'mean std count')}, {_sql_stats('map', _coded(specs.MAP_CODES), 'mean')}
  FROM chart WHERE itemid IN {_in(specs.LONG_PRESSURE_CODES)} AND num BETWEEN 30 AND 300
    AND icustay_id IN (SELECT icustay_id FROM cohort)
  GROUP BY icustay_id HAVING sbp_mean IS NOT NULL AND dbp_mean IS NOT NULL"""
_TEMP = (
    f"CASE WHEN itemid IN {_in(specs.TEMP_SCALED_CODES)} THEN num * 9 / 5 + 32"
    f" WHEN itemid IN {_in(specs.TEMP_PLAIN_CODES)} THEN num END"
)
LONG_VITALS_SQL = f"""
  SELECT icustay_id, {_sql_stats('hr', _coded(specs.HR_CODES), 'mean std min max')},
         {_sql_stats('rr', _coded(specs.RR_CODES), 'mean std')}, {_sql_stats('temp', _TEMP, 'mean')},
         {_sql_stats('spo2', _coded(specs.SPO2_CODES), 'mean std')}, {_sql_stats('gcs', _coded(specs.GCS_CODES), 'mean')}
  FROM chart WHERE itemid IN {_in(specs.LONG_VITAL_CODES)} AND icustay_id IN (SELECT icustay_id FROM cohort)
  GROUP BY icustay_id"""
LONG_LABS_SQL = f"""
  SELECT i.icustay_id, {', '.join(f"{r4(f'avg(CASE WHEN l.itemid = {c} THEN TRY_CAST(l.value AS DOUBLE) END)')} AS {n}_mean" for n, c in specs.LAB_CODES.items())}
  FROM icustays i LEFT JOIN labevents l ON i.hadm_id = l.hadm_id
  WHERE i.icustay_id IN (SELECT icustay_id FROM cohort) AND l.itemid IN {_in(specs.LAB_CODES.values())}
  GROUP BY i.icustay_id"""


def _likes(column: str, words) -> str:
    return "(" + " OR ".join(f"lower({column}) LIKE '%{w}%'" for w in words) + ")"


LONG_MEDS_SQL = f"""
  SELECT mv.icustay_id, {', '.join(f"count(CASE WHEN {_likes('di.label', w)} THEN 1 END) AS {n}_count" for n, w in specs.DRUG_CLASSES.items())}
  FROM inputevents_mv mv JOIN d_items di ON mv.itemid = di.itemid
  WHERE mv.statusdescription <> 'Rewritten' AND mv.icustay_id IN (SELECT icustay_id FROM cohort)
  GROUP BY mv.icustay_id"""
LONG_COMORB_SQL = f"""
  SELECT i.icustay_id, {', '.join(f"max(CASE WHEN substr(d.icd9_code, 1, 3) IN ({', '.join(map(repr, p))}) THEN 1 ELSE 0 END) AS {n}" for n, p in specs.ICD9_PREFIXES.items())},
         count(DISTINCT d.icd9_code) AS total_diagnoses
  FROM icustays i JOIN diagnoses_icd d ON i.hadm_id = d.hadm_id
  WHERE i.icustay_id IN (SELECT icustay_id FROM cohort) GROUP BY i.icustay_id"""


def _corr(x: str, y: str) -> str:
    xb, yb = f"CASE WHEN {y} IS NOT NULL THEN {x} END", f"CASE WHEN {x} IS NOT NULL THEN {y} END"
    return (
        f"CASE WHEN stddev_pop({xb}) * stddev_pop({yb}) > 0"
        f" THEN covar_pop({x}, {y}) / (stddev_pop({xb}) * stddev_pop({yb})) END"
    )


SERIES = f"""series AS (
  SELECT icustay_id, charttime, itemid, {_coded(specs.SBP_CODES)} AS sbp, {_coded(specs.HR_CODES)} AS hr,
         {_coded(specs.RR_CODES)} AS rr, {_coded(specs.SPO2_CODES)} AS spo2
  FROM chart WHERE itemid IN {_in(specs.LONG_SERIES_CODES)})"""
SERIES_STATS_SQL = f"""
  SELECT icustay_id, {r4('avg(sbp)')} AS sbp_mean_verify, {r4('stddev_samp(sbp)')} AS sbp_std_verify,
         {r4('stddev_samp(hr) / nullif(avg(hr), 0)')} AS hr_cv_temporal,
         {r4(_corr('CAST(floor(epoch(charttime)) AS DOUBLE)', 'hr'))} AS hr_trend,
         {r4('max(hr) - min(hr)')} AS hr_range, {r4('max(rr) - min(rr)')} AS rr_range,
         {r4('max(spo2) - min(spo2)')} AS spo2_range,
         {r4(_corr('hr', 'sbp'))} AS hr_sbp_corr, {r4(_corr('rr', 'sbp'))} AS rr_sbp_corr,
         {r4(_corr('spo2', 'sbp'))} AS spo2_sbp_corr,
         count(CASE WHEN sbp_change > 20 THEN 1 END) AS sbp_lability_events,
         count(CASE WHEN hr_change > 20 THEN 1 END) AS hr_lability_events,
         count(*) AS total_measurements, count(DISTINCT CAST(charttime AS DATE)) AS measurement_days,
         count(DISTINCT charttime) AS unique_timepoints
  FROM changes WHERE icustay_id IN (SELECT icustay_id FROM cohort) GROUP BY icustay_id"""
CHANGES = """changes AS (
  SELECT *, abs(sbp - lag(sbp) OVER w) AS sbp_change, abs(hr - lag(hr) OVER w) AS hr_change
  FROM series WINDOW w AS (PARTITION BY icustay_id ORDER BY charttime, itemid))"""
PAIRED = """paired AS (
  SELECT icustay_id, charttime, avg(sbp) AS sbp, avg(hr) AS hr, avg(rr) AS rr, avg(spo2) AS spo2
  FROM series GROUP BY icustay_id, charttime),
changes AS (
  SELECT *, abs(sbp - lag(sbp IGNORE NULLS) OVER w) AS sbp_change, abs(hr - lag(hr IGNORE NULLS) OVER w) AS hr_change
  FROM paired WINDOW w AS (PARTITION BY icustay_id ORDER BY charttime))"""


def _when(test: str, x: str) -> str:
    return f"CASE WHEN {test} THEN {x} END"


WIDE_BP_SQL = f"""
  SELECT patientunitstayid, {_sql_stats('sbp', _when('systemicsystolic > 0', 'systemicsystolic'), 'mean std count min max')},
         {_sql_stats('dbp', _when('systemicdiastolic > 0', 'systemicdiastolic'), 'mean std count')},
         {_sql_stats('map', _when('systemicmean > 0', 'systemicmean'), 'mean')}
  FROM vitalperiodic
  WHERE systemicsystolic BETWEEN 30 AND 300 AND systemicdiastolic BETWEEN 15 AND 200
    AND patientunitstayid IN (SELECT patientunitstayid FROM cohort)
  GROUP BY patientunitstayid HAVING sbp_mean IS NOT NULL AND dbp_mean IS NOT NULL AND sbp_count >= 2"""


def _wide_vitals_columns(alias: str = "vp") -> str:
    call = {"avg": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    return ", ".join(
        f"{r4(f'{call[agg]}({_when(valid, source)})')} AS {out}" for out, agg, source, valid in specs.WIDE_VITALS
    )


WIDE_VITALS_SQL = f"""
  SELECT vp.patientunitstayid, {_wide_vitals_columns()},
         {r4("avg(CASE WHEN nursingchartcelltypevalname LIKE '%Glasgow%' OR nursingchartcelltypevalname LIKE '%GCS%' THEN TRY_CAST(nursingchartvalue AS DOUBLE) END)")} AS gcs_mean
  FROM vitalperiodic vp LEFT JOIN nursecharting nc
    ON vp.patientunitstayid = nc.patientunitstayid AND abs(vp.observationoffset - nc.nursingchartoffset) <= 60
  WHERE vp.patientunitstayid IN (SELECT patientunitstayid FROM cohort)
  GROUP BY vp.patientunitstayid"""
STRICT_BP_SQL = f"""
  SELECT patientunitstayid,
         {_sql_stats('sbp', _when('systemicsystolic > 30 AND systemicsystolic < 300', 'systemicsystolic'), 'mean std count min max')},
         {_sql_stats('dbp', _when('systemicdiastolic > 15 AND systemicdiastolic < 200', 'systemicdiastolic'), 'mean std count')},
         {_sql_stats('map', _when('systemicmean > 20 AND systemicmean < 200', 'systemicmean'), 'mean')}
  FROM vitalperiodic WHERE patientunitstayid IN (SELECT patientunitstayid FROM cohort)
  GROUP BY patientunitstayid
  HAVING sbp_mean IS NOT NULL AND dbp_mean IS NOT NULL AND sbp_count >= 2 AND dbp_count >= 2"""
_HR, _RR, _SP = "heartrate > 20 AND heartrate < 250", "respiration > 5 AND respiration < 60", "sao2 > 50 AND sao2 <= 100"
STRICT_VITALS_SQL = f"""
  SELECT patientunitstayid, {_sql_stats('hr', _when(_HR, 'heartrate'), 'mean std min max count')},
         {_sql_stats('rr', _when(_RR, 'respiration'), 'mean std count')},
         {_sql_stats('temp', _when('temperature > 80 AND temperature < 110', 'temperature'), 'mean')},
         {_sql_stats('spo2', _when(_SP, 'sao2'), 'mean std count')},
         {_sql_stats('cvp', _when('cvp > 0 AND cvp < 50', 'cvp'), 'mean')},
         {_sql_stats('etco2', _when('etco2 > 10 AND etco2 < 80', 'etco2'), 'mean')}
  FROM vitalperiodic WHERE patientunitstayid IN (SELECT patientunitstayid FROM cohort)
  GROUP BY patientunitstayid HAVING hr_mean IS NOT NULL OR rr_mean IS NOT NULL OR spo2_mean IS NOT NULL"""


def _lab_column(name: str, words, bounds=None) -> str:
    test = _likes("labname", words) + (f" AND labresult BETWEEN {bounds[0]} AND {bounds[1]}" if bounds else "")
    return f"{r4(f'avg(CASE WHEN {test} THEN labresult END)')} AS {name}_mean"


WIDE_LABS_SQL = f"""
  SELECT patientunitstayid, {', '.join(_lab_column(n, w, specs.PH_RANGE if n == 'ph' else None) for n, w in specs.LAB_NAMES.items())}
  FROM lab WHERE labresult IS NOT NULL AND labresult > 0 AND patientunitstayid IN (SELECT patientunitstayid FROM cohort)
  GROUP BY patientunitstayid"""
STRICT_LABS_SQL = f"""
  SELECT patientunitstayid, {', '.join(_lab_column(n, specs.LAB_NAMES[n], b) for n, b in specs.STRICT_LAB_RANGES.items())},
         {', '.join(f"count(DISTINCT CASE WHEN {_likes('labname', specs.LAB_NAMES[n])} THEN labname END) AS {n}_tests" for n in specs.STRICT_LAB_COUNTS)}
  FROM lab WHERE labresult > 0 AND patientunitstayid IN (SELECT patientunitstayid FROM cohort)
  GROUP BY patientunitstayid"""
WIDE_MEDS_SQL = f"""
  SELECT patientunitstayid, {', '.join(f"count(DISTINCT CASE WHEN {_likes('drugname', w)} THEN drugname END) AS {n}_count" for n, w in specs.EXTERNAL_DRUG_CLASSES.items())}
  FROM medication WHERE drugname IS NOT NULL AND patientunitstayid IN (SELECT patientunitstayid FROM cohort)
  GROUP BY patientunitstayid"""
WIDE_SERIES_SQL = f"""
  SELECT patientunitstayid, {r4('stddev_samp(heartrate) / nullif(avg(heartrate), 0)')} AS hr_cv_temporal,
         {r4('max(heartrate) - min(heartrate)')} AS hr_range, {r4('max(respiration) - min(respiration)')} AS rr_range,
         {r4('max(sao2) - min(sao2)')} AS spo2_range, count(*) AS total_measurements,
         count(DISTINCT observationoffset) AS unique_timepoints,
         max(observationoffset) - min(observationoffset) AS measurement_span_minutes
  FROM vitalperiodic
  WHERE heartrate > 0 AND heartrate < 300 AND respiration > 0 AND respiration < 60 AND sao2 > 0 AND sao2 <= 100
    AND patientunitstayid IN (SELECT patientunitstayid FROM cohort)
  GROUP BY patientunitstayid HAVING count(*) >= 3"""
WIDE_COMORB_SQL = f"""
  SELECT patientunitstayid, {', '.join(f"max(CASE WHEN regexp_matches(lower(diagnosisstring), '{p}') THEN 1 ELSE 0 END) AS {n}" for n, p in specs.DIAGNOSIS_PATTERNS.items())},
         count(DISTINCT diagnosisstring) AS total_diagnoses
  FROM diagnosis WHERE diagnosisstring IS NOT NULL AND patientunitstayid IN (SELECT patientunitstayid FROM cohort)
  GROUP BY patientunitstayid"""


def long_sql(views: str, ctes: str, body: str) -> str:
    return over_views(f"{LONG_BASE} {views}", f"WITH {LONG_COHORT}{', ' + ctes if ctes else ''} {body}")


def wide_sql(views: str, body: str) -> str:
    return over_views(f"patient {views}", f"WITH {WIDE_COHORT} {body}")


# --- Spark side -----------------------------------------------------------------------


def long_cohort(spark: SparkSession, folder: str) -> tuple:
    c = clinical_catalog(spark, folder)
    return c, internal.cohort(c["patients"], c["admissions"], c["icustays"])


def wide_cohort(spark: SparkSession, folder: str) -> tuple:
    c = clinical_catalog(spark, folder)
    return c, external.cohort(c["patient"])


def _long(build):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        c, cohort = long_cohort(spark, folder)
        return tidy(build(c, cohort))

    return run


def _wide(build):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        c, cohort = wide_cohort(spark, folder)
        return tidy(build(c, cohort))

    return run


def long_families(c, cohort, **kw) -> dict[str, DataFrame]:
    return {
        "pressure": internal.pressure(c["chartevents"], cohort),
        "vitals": internal.vitals(c["chartevents"], cohort),
        "labs": internal.labs(c["icustays"], c["labevents"], cohort),
        "medications": internal.medications(c["inputevents_mv"], c["d_items"], cohort),
        "temporal": internal.temporal(c["chartevents"], cohort, **kw),
        "comorbidities": internal.comorbidities(c["icustays"], c["diagnoses_icd"], cohort),
    }


def _assembled(c, cohort) -> DataFrame:
    f = long_families(c, None)
    return assemble(
        cohort, [f["pressure"]], [f[n] for n in ("vitals", "labs", "medications", "temporal", "comorbidities")], "icustay_id"
    )


def _fused(c, cohort) -> DataFrame:
    return internal.pressure_and_vitals(c["chartevents"], cohort)


def _check_merge(c, cohort) -> DataFrame:
    return assemble(
        cohort.select("patientunitstayid", "age", "gender"),
        [external.pressure(c["vitalperiodic"], cohort, strict=True)],
        [external.strict_vitals(c["vitalperiodic"], cohort), external.labs(c["lab"], cohort, strict=True)],
        "patientunitstayid",
    )


def _yield(c, cohort) -> DataFrame:
    families = {
        "pressure": external.pressure(c["vitalperiodic"], cohort, strict=True),
        "vitals": external.strict_vitals(c["vitalperiodic"], cohort),
        "labs": external.labs(c["lab"], cohort, strict=True),
    }
    return extraction_yield(cohort, families, "patientunitstayid")


def _coverage(c, cohort) -> DataFrame:
    return feature_coverage(
        external.strict_vitals(c["vitalperiodic"], cohort), ["hr_mean", "rr_mean", "temp_mean", "spo2_mean"]
    )


COVERAGE_SQL = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, count({f}) AS n_present, {r4(f'min({f})')} AS low, {r4(f'max({f})')} AS high,"
    f" {r4(f'avg({f})')} AS mean FROM v"
    for f in ("hr_mean", "rr_mean", "temp_mean", "spo2_mean")
)


def _band(spark: SparkSession, folder: str) -> DataFrame:
    """Error events within twelve hours of each click of the same user."""
    events = read(spark, folder, "events").withColumn("at", epoch_micros("ts"))
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "at")
    errors = events.where("event_type = 'error'").select("user_id", F.col("at").alias("error_at"), "value")
    joined = band_left_join(clicks, errors, "user_id", "at", "error_at", 12 * 3_600_000_000, "value")
    return tidy(
        joined.select("event_id", "user_id", "n_matched", "fan_out", F.try_divide("sum_values", "n_values").alias("avg_value"))
    )


BAND_SQL = f"""
  SELECT c.event_id, c.user_id, count(e.event_id) AS n_matched, greatest(count(e.event_id), 1) AS fan_out,
         {r4('avg(e.value)')} AS avg_value
  FROM (SELECT * FROM events WHERE event_type = 'click') c
  LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') e
    ON c.user_id = e.user_id AND abs(epoch_us(c.ts) - epoch_us(e.ts)) <= 43200000000
  GROUP BY c.event_id, c.user_id"""


def _event_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Per-user conditional aggregation of the event stream, restricted to a cohort of customers."""
    users = read(spark, folder, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    kinds = ("click", "view", "purchase", "signup", "error")
    features = [
        f
        for k in kinds
        for f in (
            Feature(f"{k}_mean", "avg", "value", f"event_type = '{k}'"),
            Feature(f"{k}_std", "std", "value", f"event_type = '{k}'"),
            Feature(f"{k}_count", "rows", when=f"event_type = '{k}'"),
        )
    ]
    out = conditional_agg(
        read(spark, folder, "events"), "user_id", features, where="value BETWEEN 1 AND 300", having="click_count >= 2"
    )
    return tidy(keep_keys(out, users, "user_id"))


EVENT_STATS_SQL = f"""
  SELECT user_id, {', '.join(_sql_stats(k, f"CASE WHEN event_type = '{k}' THEN value END", 'mean std count') for k in ('click', 'view', 'purchase', 'signup', 'error'))}
  FROM events WHERE value BETWEEN 1 AND 300 AND user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
  GROUP BY user_id HAVING click_count >= 2"""


def _changes(c, cohort) -> DataFrame:
    rows = with_changes(internal.series(c["chartevents"]), "icustay_id", "charttime", ["sbp", "hr"], ties=["itemid"])
    return keep_keys(rows, cohort, "icustay_id").select(
        "icustay_id", F.date_format(F.col("charttime"), "yyyy-MM-dd HH:mm:ss").alias("charttime"), "itemid",
        "sbp", "hr", "rr", "spo2", "sbp_change", "hr_change",
    )


def _typed(c, cohort) -> DataFrame:
    return internal.series(c["chartevents"]).select(
        "icustay_id", "itemid", *[F.col(v) for v in ("sbp", "hr", "rr", "spo2")]
    )


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    c = clinical_catalog(spark, folder)
    return row_counts({t: c[t] for t in ("patient", "vitalperiodic", "lab")})


def _ages(spark: SparkSession, folder: str) -> DataFrame:
    return top_values(clinical_catalog(spark, folder)["patient"], "age", 10, "age IS NOT NULL AND age <> ''")


def _lab_names(spark: SparkSession, folder: str) -> DataFrame:
    return top_values(clinical_catalog(spark, folder)["lab"], "labname", 15, "labname IS NOT NULL")


def _bp_availability(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(
        availability(
            clinical_catalog(spark, folder)["vitalperiodic"],
            "patientunitstayid",
            "systemicsystolic",
            "systemicsystolic > 0 AND systemicdiastolic > 0",
        )
    )


def _casts(spark: SparkSession, folder: str) -> DataFrame:
    c = clinical_catalog(spark, folder)
    x = number("value")
    return tidy(
        c["chartevents"].groupBy("itemid").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count(x).alias("n_numeric"), F.count_if(x.between(30, 300)).alias("n_in_range"),
            F.sum(x).alias("total"),
        )
    )


LONG_FAMILY_SQL = {
    "pressure": ("chartevents", CHART, LONG_BP_SQL),
    "vitals": ("chartevents", CHART, LONG_VITALS_SQL),
    "labs": ("labevents", "", LONG_LABS_SQL),
    "medications": ("inputevents_mv d_items", "", LONG_MEDS_SQL),
    "temporal": ("chartevents", f"{CHART}, {SERIES}, {CHANGES}", SERIES_STATS_SQL),
    "comorbidities": ("diagnoses_icd", "", LONG_COMORB_SQL),
}
ASSEMBLED_CTES = (
    f"{CHART}, {SERIES}, {CHANGES}, bp AS ({LONG_BP_SQL}), vit AS ({LONG_VITALS_SQL}), lab15 AS ({LONG_LABS_SQL}),"
    f" med AS ({LONG_MEDS_SQL}), tmp AS ({SERIES_STATS_SQL}), com AS ({LONG_COMORB_SQL})"
)
ASSEMBLED_VIEWS = "chartevents labevents inputevents_mv d_items diagnoses_icd"
ASSEMBLED_BODY = (
    "SELECT * FROM cohort JOIN bp USING (icustay_id) LEFT JOIN vit USING (icustay_id) LEFT JOIN lab15 USING (icustay_id)"
    " LEFT JOIN med USING (icustay_id) LEFT JOIN tmp USING (icustay_id) LEFT JOIN com USING (icustay_id)"
)

CHECKS: dict[str, Check] = {
    "user_event_features": Check(_event_stats, EVENT_STATS_SQL),
    "table_row_counts": Check(
        _counts,
        over_views(
            "patient vitalperiodic lab",
            " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ("patient", "vitalperiodic", "lab")),
        ),
    ),
    "bp_availability": Check(
        _bp_availability,
        over_views(
            "vitalperiodic",
            f"SELECT count(DISTINCT patientunitstayid) AS n_keys, count(*) AS n_measurements, {r4('min(systemicsystolic)')} AS min_value,"
            f" {r4('max(systemicsystolic)')} AS max_value, {r4('avg(systemicsystolic)')} AS avg_value FROM vitalperiodic"
            " WHERE systemicsystolic > 0 AND systemicdiastolic > 0",
        ),
    ),
    "top_ages": Check(
        _ages,
        over_views("patient", "SELECT age, count(*) AS n_rows FROM patient WHERE age IS NOT NULL AND age <> '' GROUP BY age ORDER BY n_rows DESC, age LIMIT 10"),
    ),
    "top_lab_names": Check(
        _lab_names,
        over_views("lab", "SELECT labname, count(*) AS n_rows FROM lab WHERE labname IS NOT NULL GROUP BY labname ORDER BY n_rows DESC, labname LIMIT 15"),
    ),
    "safe_cast_quality": Check(
        _casts,
        over_views(
            "chartevents",
            f"SELECT itemid, count(*) AS n_rows, count(TRY_CAST(nullif(value, '') AS DOUBLE)) AS n_numeric,"
            f" count(CASE WHEN TRY_CAST(nullif(value, '') AS DOUBLE) BETWEEN 30 AND 300 THEN 1 END) AS n_in_range,"
            f" {r4("sum(TRY_CAST(nullif(value, '') AS DOUBLE))")} AS total FROM chartevents GROUP BY itemid",
        ),
    ),
    "cohort_long": Check(_long(lambda c, cohort: cohort), long_sql("", "", "SELECT * FROM cohort")),
    "cohort_long_first_1000": Check(
        _long(lambda c, cohort: internal.cohort(c["patients"], c["admissions"], c["icustays"], limit=1000)),
        long_sql("", "", "SELECT * FROM cohort ORDER BY subject_id, icustay_id LIMIT 1000"),
    ),
    "cohort_wide": Check(
        _wide(lambda c, cohort: cohort),
        wide_sql("", f"SELECT * REPLACE ({r4('CAST(icu_los_hours AS DOUBLE)')} AS icu_los_hours) FROM cohort"),
    ),
    "cohort_wide_first_1000": Check(
        _wide(lambda c, cohort: external.cohort(c["patient"], limit=1000).select("patientunitstayid", "age", "icu_los_hours")),
        wide_sql("", f"SELECT patientunitstayid, age, {r4('CAST(icu_los_hours AS DOUBLE)')} AS icu_los_hours FROM cohort ORDER BY patientunitstayid LIMIT 1000"),
    ),
    "pressure_long": Check(_long(lambda c, k: internal.pressure(c["chartevents"], k)), long_sql(*LONG_FAMILY_SQL["pressure"])),
    "vitals_long": Check(_long(lambda c, k: internal.vitals(c["chartevents"], k)), long_sql(*LONG_FAMILY_SQL["vitals"])),
    "pressure_and_vitals_fused": Check(
        _long(_fused),
        long_sql("chartevents", f"{CHART}, bp AS ({LONG_BP_SQL}), vit AS ({LONG_VITALS_SQL})", "SELECT * FROM bp LEFT JOIN vit USING (icustay_id)"),
    ),
    "labs_long": Check(
        _long(lambda c, k: internal.labs(c["icustays"], c["labevents"], k)), long_sql(*LONG_FAMILY_SQL["labs"])
    ),
    "medications_long": Check(
        _long(lambda c, k: internal.medications(c["inputevents_mv"], c["d_items"], k)), long_sql(*LONG_FAMILY_SQL["medications"])
    ),
    "typed_series": Check(
        _long(_typed), over_views("chartevents", f"WITH {CHART}, {SERIES} SELECT icustay_id, itemid, {', '.join(f'{r4(v)} AS {v}' for v in ('sbp', 'hr', 'rr', 'spo2'))} FROM series")
    ),
    "vital_changes": Check(
        _long(_changes),
        long_sql(
            "chartevents",
            f"{CHART}, {SERIES}, {CHANGES}",
            "SELECT icustay_id, strftime(charttime, '%Y-%m-%d %H:%M:%S') AS charttime, itemid, "
            + ", ".join(f"{r4(v)} AS {v}" for v in ("sbp", "hr", "rr", "spo2", "sbp_change", "hr_change"))
            + " FROM changes WHERE icustay_id IN (SELECT icustay_id FROM cohort)",
        ),
    ),
    "temporal_long": Check(_long(lambda c, k: internal.temporal(c["chartevents"], k)), long_sql(*LONG_FAMILY_SQL["temporal"])),
    "temporal_long_paired": Check(
        _long(lambda c, k: internal.temporal(c["chartevents"], k, paired=True)),
        long_sql("chartevents", f"{CHART}, {SERIES}, {PAIRED}", SERIES_STATS_SQL),
    ),
    "comorbidities_long": Check(
        _long(lambda c, k: internal.comorbidities(c["icustays"], c["diagnoses_icd"], k)), long_sql(*LONG_FAMILY_SQL["comorbidities"])
    ),
    "feature_assembly_long": Check(_long(_assembled), long_sql(ASSEMBLED_VIEWS, ASSEMBLED_CTES, ASSEMBLED_BODY)),
    "pressure_wide": Check(_wide(lambda c, k: external.pressure(c["vitalperiodic"], k)), wide_sql("vitalperiodic", WIDE_BP_SQL)),
    "vitals_wide_band": Check(
        _wide(lambda c, k: external.vitals(c["vitalperiodic"], c["nursecharting"], k)), wide_sql("vitalperiodic nursecharting", WIDE_VITALS_SQL)
    ),
    "vitals_wide_unweighted": Check(
        _wide(lambda c, k: external.vitals(c["vitalperiodic"], c["nursecharting"], k, fan_out=False).drop("gcs_mean")),
        wide_sql("vitalperiodic", f"SELECT patientunitstayid, {_wide_vitals_columns()} FROM vitalperiodic WHERE patientunitstayid IN (SELECT patientunitstayid FROM cohort) GROUP BY patientunitstayid"),
    ),
    "labs_wide": Check(_wide(lambda c, k: external.labs(c["lab"], k)), wide_sql("lab", WIDE_LABS_SQL)),
    "medications_wide": Check(_wide(lambda c, k: external.medications(c["medication"], k)), wide_sql("medication", WIDE_MEDS_SQL)),
    "temporal_wide": Check(_wide(lambda c, k: external.temporal(c["vitalperiodic"], k)), wide_sql("vitalperiodic", WIDE_SERIES_SQL)),
    "comorbidities_wide": Check(_wide(lambda c, k: external.comorbidities(c["diagnosis"], k)), wide_sql("diagnosis", WIDE_COMORB_SQL)),
    "pressure_wide_strict": Check(
        _wide(lambda c, k: external.pressure(c["vitalperiodic"], k, strict=True)), wide_sql("vitalperiodic", STRICT_BP_SQL)
    ),
    "vitals_wide_strict": Check(_wide(lambda c, k: external.strict_vitals(c["vitalperiodic"], k)), wide_sql("vitalperiodic", STRICT_VITALS_SQL)),
    "labs_wide_strict": Check(_wide(lambda c, k: external.labs(c["lab"], k, strict=True)), wide_sql("lab", STRICT_LABS_SQL)),
    "check_set_merge": Check(
        _wide(_check_merge),
        over_views(
            "patient vitalperiodic lab",
            f"WITH {WIDE_COHORT}, bp AS ({STRICT_BP_SQL}), vit AS ({STRICT_VITALS_SQL}), lb AS ({STRICT_LABS_SQL})"
            " SELECT * FROM (SELECT patientunitstayid, age, gender FROM cohort) JOIN bp USING (patientunitstayid)"
            " LEFT JOIN vit USING (patientunitstayid) LEFT JOIN lb USING (patientunitstayid)",
        ),
    ),
    "extraction_yield": Check(
        _wide(_yield),
        over_views(
            "patient vitalperiodic lab",
            f"WITH {WIDE_COHORT}, bp AS ({STRICT_BP_SQL}), vit AS ({STRICT_VITALS_SQL}), lb AS ({STRICT_LABS_SQL})"
            + " UNION ALL ".join(
                f" SELECT '{n}' AS family, (SELECT count(*) FROM cohort) AS n_cohort, (SELECT count(*) FROM {t}) AS n_found,"
                f" {r4(f'(SELECT count(*) FROM {t}) * 100.0 / (SELECT count(*) FROM cohort)')} AS percent_found"
                for n, t in (("pressure", "bp"), ("vitals", "vit"), ("labs", "lb"))
            ),
        ),
    ),
    "feature_coverage": Check(
        _wide(_coverage), wide_sql("vitalperiodic", f", v AS ({STRICT_VITALS_SQL}) {COVERAGE_SQL}")
    ),
    "band_join_totals": Check(_band, BAND_SQL),
}
