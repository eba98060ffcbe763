"""Clinical codes, name patterns, ranges and defaults."""

from __future__ import annotations

from icufeat.operators.condagg import Feature, NamedMean

# --- Fixed values: item codes of the long charting table -----------------------------
SBP_CODES = (51, 442, 455, 6701, 220179, 220050)
DBP_CODES = (8368, 8440, 8441, 8555, 220180, 220051)
MAP_CODES = (52, 6702, 220181, 220052, 225312)
HR_CODES = (211, 220045)
RR_CODES = (615, 618, 220210, 224690)
TEMP_SCALED_CODES = (223761, 678)
TEMP_PLAIN_CODES = (223762, 676)
SPO2_CODES = (646, 220277)
GCS_CODES = (198, 226755)

# --- Fixed values: laboratory item codes ---------------------------------------------
LAB_CODES = {
    "sodium": 50824,
    "potassium": 50822,
    "creatinine": 50912,
    "bun": 51006,
    "hemoglobin": 51222,
    "wbc": 51301,
    "lactate": 50813,
    "troponin": 50090,
    "crp": 50889,
    "ph": 50820,
    "pco2": 50818,
    "po2": 50821,
    "alp": 50863,
    "ast": 50878,
    "alt": 50861,
}

# --- Fixed values: laboratory name patterns ------------------------------------------
LAB_NAMES = {
    "sodium": ("sodium",),
    "potassium": ("potassium",),
    "creatinine": ("creatinine",),
    "bun": ("bun", "urea"),
    "hemoglobin": ("hgb", "hemoglobin"),
    "wbc": ("wbc", "white blood"),
    "lactate": ("lactate",),
    "troponin": ("troponin",),
    "crp": ("crp", "c-reactive"),
    "ph": ("ph",),
    "pco2": ("pco2", "co2"),
    "po2": ("po2", "oxygen"),
    "alt": ("alt", "sgpt"),
    "ast": ("ast", "sgot"),
    "alp": ("alkaline", "alp"),
}
PH_RANGE = (6.5, 8.0)
STRICT_LAB_RANGES = {
    "sodium": (120.0, 180.0),
    "potassium": (2.0, 8.0),
    "creatinine": (0.3, 15.0),
    "bun": (5.0, 200.0),
    "hemoglobin": (3.0, 20.0),
    "wbc": (1.0, 100.0),
    "lactate": (0.3, 30.0),
}
STRICT_LAB_COUNTS = ("sodium", "potassium", "creatinine", "lactate")

# --- Fixed values: drug classes ------------------------------------------------------
DRUG_CLASSES = {
    "vasopressor": ("norepinephrine", "epinephrine", "dopamine", "dobutamine", "vasopressin"),
    "beta_blocker": ("metoprolol", "esmolol", "propranolol", "carvedilol", "labetalol"),
    "diuretic": ("furosemide", "lasix", "bumetanide", "torsemide", "hydrochlorothiazide"),
    "acei": ("lisinopril", "enalapril", "captopril", "ramipril"),
    "arb": ("losartan", "valsartan", "candesartan", "irbesartan"),
    "ccb": ("amlodipine", "diltiazem", "verapamil", "nifedipine"),
}
EXTERNAL_DRUG_CLASSES = {
    **DRUG_CLASSES,
    "vasopressor": (*DRUG_CLASSES["vasopressor"], "phenylephrine"),
    "beta_blocker": (*DRUG_CLASSES["beta_blocker"], "atenolol"),
    "arb": ("losartan", "valsartan", "candesartan"),
}

# --- Fixed values: comorbidities -----------------------------------------------------
ICD9_PREFIXES = {
    "hypertension": ("401", "402", "403", "404", "405"),
    "diabetes": ("250",),
    "heart_failure": ("428",),
    "coronary_artery_disease": ("410", "411", "412", "413", "414"),
    "chronic_kidney_disease": ("585",),
    "stroke_history": ("430", "431", "432", "433", "434", "435", "436", "437", "438"),
    "copd": ("491", "492", "496"),
    "liver_disease": ("570", "571", "572", "573"),
}
DIAGNOSIS_PATTERNS = {
    "hypertension": "hypertension|htn|high blood pressure",
    "diabetes": "diabetes|dm|diabetic",
    "heart_failure": "heart failure|chf|cardiomyopathy|cardiac failure",
    "coronary_artery_disease": "coronary|cad|mi|myocardial|ischemic heart",
    "chronic_kidney_disease": "kidney|renal|ckd|chronic kidney|renal failure",
    "stroke_history": "stroke|cva|cerebrovascular|brain infarct",
    "copd": "copd|emphysema|chronic obstructive|chronic bronchitis",
    "liver_disease": "liver|hepatic|cirrhosis|liver disease",
}
COMORBIDITIES = tuple(ICD9_PREFIXES)
CV_RISKS = ("hypertension", "diabetes", "heart_failure", "coronary_artery_disease", "stroke_history")

# --- Fixed values: bins --------------------------------------------------------------
AGE_BINS = ((0, 40, 60, 75, 100), ("young_adult", "middle_age", "elderly", "very_elderly"))
BMI_BINS = (
    (0, 18.5, 25, 30, 35, 100),
    ("underweight", "normal", "overweight", "obese", "severely_obese"),
)
SBP_BINS = (
    (0, 90, 120, 140, 160, 300),
    ("hypotension", "normal", "prehypertension", "stage1_htn", "stage2_htn"),
)
REPORT_LABELS = ("Hypotension", "Normal", "Prehypertension", "Stage 1 HTN", "Stage 2 HTN")
REPORT_EDGES = {"SBP": (0, 90, 120, 140, 160, 300), "DBP": (0, 60, 80, 90, 100, 200)}
STRATUM_EDGES = (0, 90, 120, 140, 300)
STRATUM_LABELS = ("Hypotension", "Normal", "Prehypertension", "Hypertension")

# --- Fixed values: limits and defaults -----------------------------------------------
EXTREME_LIMITS = {
    "hr_mean": (20, 250),
    "sbp_mean": (40, 300),
    "dbp_mean": (15, 200),
    "temp_mean": (80, 110),
    "spo2_mean": (50, 100),
}
CLINICAL_DEFAULTS = {
    "hr_mean": 80.0,
    "hr_std": 10.0,
    "rr_mean": 18.0,
    "rr_std": 5.0,
    "temp_mean": 98.6,
    "spo2_mean": 97.0,
    "spo2_std": 3.0,
    "gcs_mean": 15.0,
    "sodium_mean": 140.0,
    "potassium_mean": 4.0,
    "creatinine_mean": 1.0,
    "bun_mean": 20.0,
    "hemoglobin_mean": 12.0,
    "wbc_mean": 8.0,
    "lactate_mean": 1.5,
    "vasopressor_count": 0.0,
    "beta_blocker_count": 0.0,
    "diuretic_count": 0.0,
    "acei_count": 0.0,
    "arb_count": 0.0,
    "ccb_count": 0.0,
    "hr_min": 60.0,
    "hr_max": 100.0,
    "sbp_min": 100.0,
    "sbp_max": 140.0,
    "hr_coefficient_variation": 0.1,
    "map_calculated": 93.0,
}
ALIGNMENT_DEFAULTS = {
    "admit_year": 2015.0,
    "deceased": 0.0,
    "gender_male": 0.5,
    "age_creatinine_product": 0.0,
    "hr_lability_events": 0.0,
    "sbp_lability_events": 0.0,
    "any_vasopressor": 0.0,
    "any_beta_blocker": 0.0,
    "any_diuretic": 0.0,
    "any_acei": 0.0,
    "any_arb": 0.0,
    "any_ccb": 0.0,
    "antihypertensive_count": 0.0,
    "comorbidity_score": 0.0,
    "cv_risk_score": 0.0,
    "high_cv_risk": 0.0,
}

# --- Fixed values: columns that reveal the target ------------------------------------
LEAKY_COLUMNS = (
    "sbp_mean_verify",
    "sbp_std_verify",
    "dbp_mean_verify",
    "dbp_std_verify",
    "sbp_mean_verify_squared",
    "sbp_std_verify_squared",
    "hr_sbp_corr",
    "rr_sbp_corr",
    "spo2_sbp_corr",
    "creatinine_sbp_ratio",
    "hrv_sbp_interaction",
)
LEAK_PATTERNS = ("verify", "sbp_mean", "dbp_mean", "map_mean")
TARGETS = ("sbp_mean", "dbp_mean")
NOT_FEATURES = (
    *TARGETS,
    "icustay_id",
    "patientunitstayid",
    "subject_id",
    "hadm_id",
    "gender",
    "age_group",
    "sbp_count",
    "sbp_min",
    "sbp_max",
    "dbp_count",
    "map_mean",
    "map_calculated",
    "pulse_pressure",
)
# Built from the targets, yet neither named above nor caught by the patterns.
TARGET_DERIVED = ("sbp_category", "sbp_std", "dbp_std", "sbp_lability_events")

IMPUTATION_REPORT_COLUMNS = (
    "temp_mean",
    "sodium_mean",
    "potassium_mean",
    "lactate_mean",
    "hr_mean",
    "creatinine_mean",
    "bun_mean",
    "hemoglobin_mean",
)


def codes(values: tuple[int, ...], column: str = "itemid") -> str:
    return f"{column} IN ({', '.join(str(v) for v in values)})"


def within(column: str, low: float, high: float | None = None, *, closed_top: bool = False) -> str:
    """SQL test low < column < high; `closed_top` includes high."""
    test = f"{column} > {low}"
    if high is not None:
        test += f" AND {column} {'<=' if closed_top else '<'} {high}"
    return test


def pressure_features(sbp: str, dbp: str, mean: str, value: dict[str, str]) -> list[Feature]:
    """The nine blood-pressure outputs, for three row predicates and three value expressions."""
    return [
        *[Feature(f"sbp_{a}", b, value["sbp"], sbp) for a, b in (("mean", "avg"), ("std", "std"))],
        Feature("sbp_count", "rows", when=sbp),
        *[Feature(f"sbp_{a}", a, value["sbp"], sbp) for a in ("min", "max")],
        *[Feature(f"dbp_{a}", b, value["dbp"], dbp) for a, b in (("mean", "avg"), ("std", "std"))],
        Feature("dbp_count", "rows", when=dbp),
        Feature("map_mean", "avg", value["map"], mean),
    ]


LONG_PRESSURE = pressure_features(
    codes(SBP_CODES), codes(DBP_CODES), codes(MAP_CODES), dict.fromkeys(("sbp", "dbp", "map"), "num")
)
LONG_VITALS = [
    Feature("hr_mean", "avg", "num", codes(HR_CODES)),
    Feature("hr_std", "std", "num", codes(HR_CODES)),
    Feature("hr_min", "min", "num", codes(HR_CODES)),
    Feature("hr_max", "max", "num", codes(HR_CODES)),
    Feature("rr_mean", "avg", "num", codes(RR_CODES)),
    Feature("rr_std", "std", "num", codes(RR_CODES)),
    Feature(
        "temp_mean",
        "avg",
        f"CASE WHEN {codes(TEMP_SCALED_CODES)} THEN num * 9 / 5 + 32 ELSE num END",
        codes(TEMP_SCALED_CODES + TEMP_PLAIN_CODES),
    ),
    Feature("spo2_mean", "avg", "num", codes(SPO2_CODES)),
    Feature("spo2_std", "std", "num", codes(SPO2_CODES)),
    Feature("gcs_mean", "avg", "num", codes(GCS_CODES)),
]
LONG_PRESSURE_CODES = SBP_CODES + DBP_CODES + MAP_CODES
LONG_VITAL_CODES = (
    HR_CODES + RR_CODES + TEMP_SCALED_CODES + TEMP_PLAIN_CODES + SPO2_CODES + GCS_CODES
)
LONG_SERIES = {
    "sbp": codes(SBP_CODES),
    "hr": codes(HR_CODES),
    "rr": codes(RR_CODES),
    "spo2": codes(SPO2_CODES),
}
LONG_SERIES_CODES = SBP_CODES + HR_CODES + RR_CODES + SPO2_CODES

LONG_LABS = [Feature(f"{lab}_mean", "avg", "num", f"itemid = {c}") for lab, c in LAB_CODES.items()]

WIDE_PRESSURE = pressure_features(
    within("systemicsystolic", 0),
    within("systemicdiastolic", 0),
    within("systemicmean", 0),
    {"sbp": "systemicsystolic", "dbp": "systemicdiastolic", "map": "systemicmean"},
)
WIDE_PRESSURE_ROWS = "systemicsystolic BETWEEN 30 AND 300 AND systemicdiastolic BETWEEN 15 AND 200"
STRICT_PRESSURE = pressure_features(
    within("systemicsystolic", 30, 300),
    within("systemicdiastolic", 15, 200),
    within("systemicmean", 20, 200),
    {"sbp": "systemicsystolic", "dbp": "systemicdiastolic", "map": "systemicmean"},
)

# (output, statistic, source column, valid range) of the wide vitals table.
WIDE_VITALS = (
    ("hr_mean", "avg", "heartrate", within("heartrate", 0)),
    ("hr_std", "std", "heartrate", within("heartrate", 0)),
    ("hr_min", "min", "heartrate", within("heartrate", 0)),
    ("hr_max", "max", "heartrate", within("heartrate", 0)),
    ("rr_mean", "avg", "respiration", within("respiration", 0)),
    ("rr_std", "std", "respiration", within("respiration", 0)),
    ("temp_mean", "avg", "temperature", within("temperature", 70, 115)),
    ("spo2_mean", "avg", "sao2", within("sao2", 0, 100, closed_top=True)),
    ("spo2_std", "std", "sao2", within("sao2", 0, 100, closed_top=True)),
    ("cvp_mean", "avg", "cvp", within("cvp", 0)),
    ("etco2_mean", "avg", "etco2", within("etco2", 0)),
)
STRICT_RANGES = {
    "hr": ("heartrate", within("heartrate", 20, 250)),
    "rr": ("respiration", within("respiration", 5, 60)),
    "temp": ("temperature", within("temperature", 80, 110)),
    "spo2": ("sao2", within("sao2", 50, 100, closed_top=True)),
    "cvp": ("cvp", within("cvp", 0, 50)),
    "etco2": ("etco2", within("etco2", 10, 80)),
}
STRICT_VITALS = [
    *[
        Feature(name, agg, STRICT_RANGES[name.split("_")[0]][0], STRICT_RANGES[name.split("_")[0]][1])
        for name, agg, _, _ in WIDE_VITALS
    ],
    *[Feature(f"{v}_count", "rows", when=STRICT_RANGES[v][1]) for v in ("hr", "rr", "spo2")],
]
WIDE_SERIES_ROWS = (
    "heartrate > 0 AND heartrate < 300 AND respiration > 0 AND respiration < 60"
    " AND sao2 > 0 AND sao2 <= 100"
)
WIDE_SERIES = [
    Feature("hr_cv_temporal", "cv", "heartrate"),
    Feature("hr_range", "range", "heartrate"),
    Feature("rr_range", "range", "respiration"),
    Feature("spo2_range", "range", "sao2"),
    Feature("total_measurements", "rows"),
    Feature("unique_timepoints", "distinct", "observationoffset"),
    Feature("measurement_span_minutes", "range", "observationoffset"),
]

NAMED_LABS = [
    NamedMean(f"{lab}_mean", words, *(PH_RANGE if lab == "ph" else ())) for lab, words in LAB_NAMES.items()
]
STRICT_LABS = [
    NamedMean(
        f"{lab}_mean",
        LAB_NAMES[lab],
        *STRICT_LAB_RANGES[lab],
        count_names_as=f"{lab}_tests" if lab in STRICT_LAB_COUNTS else None,
    )
    for lab in STRICT_LAB_RANGES
]


def drug_flags(classes: dict[str, tuple[str, ...]], column: str) -> list[Feature]:
    """Row counts per drug class, by lower-case substring."""
    return [
        Feature(
            f"{name}_count", "rows", when=" OR ".join(f"lower({column}) LIKE '%{w}%'" for w in words)
        )
        for name, words in classes.items()
    ]


ICD9_FLAGS = [
    *[
        Feature(name, "flag", when=f"substring(icd9_code, 1, 3) IN ({', '.join(map(repr, p))})")
        for name, p in ICD9_PREFIXES.items()
    ],
    Feature("total_diagnoses", "count", "icd9_code"),
]
DIAGNOSIS_FLAGS = [
    *[
        Feature(name, "flag", when=f"lower(diagnosisstring) RLIKE '{p}'")
        for name, p in DIAGNOSIS_PATTERNS.items()
    ],
    Feature("total_diagnoses", "count", "diagnosisstring"),
]
