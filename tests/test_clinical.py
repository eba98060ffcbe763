"""Cohorts and extraction on hand-sized tables."""

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from icufeat.operators.bandjoin import band_left_join, weighted_std
from icufeat.operators.condagg import Feature, conditional_agg
from icufeat.plans import external, internal
from icufeat.sources.catalog import LONG_SCHEMAS, WIDE_SCHEMAS


def day(y, m=1, d=1, h=0, mi=0):
    return datetime(y, m, d, h, mi)


def long_table(spark, name, rows):
    return spark.createDataFrame(rows, LONG_SCHEMAS[name])


def wide_table(spark, name, rows):
    return spark.createDataFrame(rows, WIDE_SCHEMAS[name])


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


@pytest.fixture(scope="module")
def stays(spark):
    return spark.createDataFrame([(1,), (2,), (3,)], "icustay_id BIGINT")


def test_long_cohort_counts_boundaries(spark):
    born = {1: 1983, 2: 1982, 3: 1911, 4: 1910}
    patients = long_table(spark, "patients", [(s, "M", day(y, 12, 31), None) for s, y in born.items()])
    admissions = long_table(
        spark,
        "admissions",
        [(s, s * 10, day(2000, 1, 2), day(2000, 1, 9) if s == 2 else None, "x", None, "y") for s in born]
        + [(2, 21, day(2000, 2, 2), None, "x", None, "y")],
    )
    stays = [(s * 100, s * 10, "MICU", day(2000, 1, 2), day(2000, 1, 5)) for s in born]
    # 23 h 2 min that cross 24 clock hours, then exactly 23 crossings, then no end.
    stays += [(201, 21, "CCU", day(2000, 2, 2, 0, 59), day(2000, 2, 3, 0, 1)), (202, 21, "CCU", day(2000, 2, 2, 1), day(2000, 2, 3, 0, 59)), (203, 21, "CCU", day(2000, 2, 2), None)]
    out = by_key(internal.cohort(patients, admissions, long_table(spark, "icustays", stays)), "icustay_id")
    assert set(out) == {200, 201, 300}
    assert out[200]["age"] == 18 and out[300]["age"] == 89
    assert out[200]["hospital_mortality"] == 1 and out[201]["hospital_mortality"] == 0
    assert out[201]["icu_los_hours"] == 24


def chart(spark, rows):
    return long_table(spark, "chartevents", [(s, t, i, v, e) for s, t, i, v, e in rows])


def test_pressure_keeps_valid_readings(spark, stays):
    t = day(2020)
    rows = [(1, t, 51, v, None) for v in ("abc", "", " 120 ", "29", "30", "300", "301")]
    rows += [(1, t, 8368, "80", None), (1, t, 51, "100", 1), (2, t, 51, "120", None), (9, t, 51, "120", None), (9, t, 8368, "60", None)]
    out = by_key(internal.pressure(chart(spark, rows), stays), "icustay_id")
    assert set(out) == {1}
    assert out[1]["sbp_count"] == 3 and out[1]["sbp_mean"] == pytest.approx(150)
    assert out[1]["sbp_min"] == 30 and out[1]["sbp_max"] == 300
    assert out[1]["dbp_std"] is None and out[1]["map_mean"] is None


def test_vitals_convert_flagged_codes_and_fuse(spark, stays):
    t = day(2020)
    rows = [(1, t, 678, "37", None), (1, t, 676, "98.6", None), (1, t, 211, "80", None), (1, t, 51, "120", None), (1, t, 8368, "70", None), (1, t, 51, "400", None)]
    df = chart(spark, rows)
    vitals = by_key(internal.vitals(df, stays), "icustay_id")[1]
    assert vitals["temp_mean"] == pytest.approx(98.6)
    fused = by_key(internal.pressure_and_vitals(df, stays), "icustay_id")[1].asDict()
    apart = {**by_key(internal.pressure(df, stays), "icustay_id")[1].asDict(), **vitals.asDict()}
    assert fused == apart


def test_temporal_modes(spark, stays):
    rows = []
    for i, (hr, sbp) in enumerate([(80, 100), (80, 130), (80, 131)]):
        rows += [(1, day(2020, 1, 1 + i, 5), 211, str(hr), None), (1, day(2020, 1, 1 + i, 5), 51, str(sbp), None)]
    df = chart(spark, rows)
    plain = by_key(internal.temporal(df, stays), "icustay_id")[1]
    assert plain["hr_trend"] is None and plain["hr_sbp_corr"] is None
    assert plain["sbp_lability_events"] == 0
    assert (plain["total_measurements"], plain["unique_timepoints"], plain["measurement_days"]) == (6, 3, 3)
    paired = by_key(internal.temporal(df, stays, paired=True), "icustay_id")[1]
    assert paired["sbp_lability_events"] == 1 and paired["total_measurements"] == 3


def test_labs_medications_comorbidities(spark, stays):
    icu = long_table(spark, "icustays", [(1, 10, "a", None, None), (2, 10, "a", None, None), (3, 30, "a", None, None)])
    labs = long_table(spark, "labevents", [(10, 50824, "140"), (10, 50824, "150"), (10, 50813, "x"), (20, 50824, "1")])
    out = by_key(internal.labs(icu, labs, stays), "icustay_id")
    assert set(out) == {1, 2} and out[2]["sodium_mean"] == 145 and out[1]["lactate_mean"] is None

    items = long_table(spark, "d_items", [(1, "Norepinephrine drip"), (2, "Lasix"), (3, "Saline")])
    drugs = [(1, 1, "Done"), (1, 1, "Done"), (1, 2, "Rewritten"), (1, 2, None), (2, 3, "Done"), (3, 99, "Done")]
    meds = by_key(internal.medications(long_table(spark, "inputevents_mv", drugs), items, stays), "icustay_id")
    assert set(meds) == {1, 2}
    assert meds[1]["vasopressor_count"] == 2 and meds[1]["diuretic_count"] == 0 and meds[2]["arb_count"] == 0

    codes = long_table(spark, "diagnoses_icd", [(10, "4019"), (10, "4019"), (10, "25000"), (10, None), (30, "428")])
    out = by_key(internal.comorbidities(icu, codes, stays), "icustay_id")
    assert out[1]["hypertension"] == 1 and out[1]["total_diagnoses"] == 2 and out[3]["heart_failure"] == 1
    assert out[3]["diabetes"] == 0


def test_wide_cohort_ages_and_stay(spark):
    def row(i, age, offset):
        return (i, i, "Male", age, "Expired" if i == 1 else "Alive", "MICU", offset, "e", None, 170.0, 70.0, 1, 1, "x")

    rows = [row(1, "18", 1441), row(2, "> 89", 5000), row(3, "", 5000), row(4, None, 5000), row(5, "abc", 5000), row(6, "89", 1440), row(7, "89", None), row(8, "17", 5000)]
    out = external.cohort(wide_table(spark, "patient", rows)).collect()
    assert [(r["patientunitstayid"], r["age"], r["hospital_mortality"]) for r in out] == [(1, 18, 1)]
    assert out[0]["icu_los_hours"] == pytest.approx(1441 / 60)


def test_band_edges_and_fan_out(spark):
    keys = spark.createDataFrame([(1,), (2,)], "patientunitstayid BIGINT")

    def vital(k, t, hr):
        return (k, t, None, None, None, hr, None, None, None, None, None)

    vitals = wide_table(spark, "vitalperiodic", [vital(1, 100, 60.0), vital(1, 1000, 90.0), vital(2, 0, 70.0)])
    notes = [(1, 40, "GCS Total", "10"), (1, 160, "Glasgow", "14"), (1, 161, "GCS Total", "3"), (1, 39, "GCS Total", "3"), (1, 100, "glasgow", "1")]
    out = by_key(external.vitals(vitals, wide_table(spark, "nursecharting", notes), keys), "patientunitstayid")
    # Three chart rows lie in the band of the first vital row, none in that of the second.
    assert out[1]["hr_mean"] == pytest.approx((60 * 3 + 90) / 4)
    assert out[1]["hr_std"] == pytest.approx(15.0)
    assert out[1]["gcs_mean"] == 12 and out[2]["gcs_mean"] is None and out[2]["hr_std"] is None


def test_band_totals_equal_all_pairs(spark):
    left = [(k, t) for k in (1, 2) for t in range(0, 500, 7)]
    right = [(k, t, float(t % 13)) for k in (1, 3) for t in range(0, 500, 3) for _ in range(1 + t % 2)]
    out = band_left_join(
        spark.createDataFrame(left, "k INT, t INT"), spark.createDataFrame(right, "k INT, u INT, v DOUBLE"), "k", "t", "u", 20, "v", 
    ).collect()
    assert len(out) == len(left)
    for r in out:
        hits = [v for k, u, v in right if k == r["k"] and abs(r["t"] - u) <= 20]
        assert r["n_matched"] == len(hits) and r["fan_out"] == max(1, len(hits))
        if hits:
            assert r["sum_values"] == pytest.approx(sum(hits))


def test_extreme_values_stay_in_their_bands(spark):
    """An infinity or a huge value reaches the bands that hold it, and no later one."""
    right = [(1, 0, 5.0), (1, 10, 1e17), (1, 30, float("inf")), (1, 100, 5.0), (1, 101, 7.0), (1, 102, None), (1, None, 3.0), (None, 5, 4.0)]
    left = [(1, t) for t in (-3, 0, 5, 10, 33, 97, 100, 104, 200)] + [(1, None), (None, 5), (1, 100)]
    out = band_left_join(spark.createDataFrame(left, "k INT, t INT"), spark.createDataFrame(right, "k INT, u INT, v DOUBLE"), "k", "t", "u", 3, "v").collect()
    assert len(out) == len(left)
    for r in out:
        hits = [v for k, u, v in right if k is not None and u is not None and k == r["k"] and r["t"] is not None and abs(r["t"] - u) <= 3]
        values = [v for v in hits if v is not None]
        assert (r["n_matched"], r["n_values"]) == (len(hits), len(values)) and (r["sum_values"] or 0.0) == sum(values)


def test_spread_of_large_values(spark):
    """Values near 1e8 keep the digits of their spread."""
    beats, offset = [99.1, 99.2, 99.3], 10.0
    large = spark.createDataFrame([(1e8 + v / offset, 2) for v in beats], "x DOUBLE, w BIGINT")
    got = large.agg(weighted_std(F.col("x"), F.col("w"), F.lit(1e8)).alias("s")).first()["s"]
    assert got == pytest.approx(np.std([v / offset for v in beats for _ in range(2)], ddof=1), rel=1e-6)


def test_wide_labs_overlap_and_ph(spark):
    keys = spark.createDataFrame([(1,)], "patientunitstayid BIGINT")
    rows = [(1, "pCO2", 40.0), (1, "total CO2", 20.0), (1, "phosphate", 7.0), (1, "Phosphate", 9.0), (1, "sodium", -1.0), (1, "sodium", None)]
    out = external.labs(wide_table(spark, "lab", rows), keys).first()
    assert out["pco2_mean"] == 30 and out["ph_mean"] == 7 and out["sodium_mean"] is None


def test_wide_medications_and_diagnoses(spark):
    keys = spark.createDataFrame([(1,)], "patientunitstayid BIGINT")
    drugs = [(1, "Atenolol"), (1, "Atenolol"), (1, "ATENOLOL"), (1, None), (1, "irbesartan")]
    meds = external.medications(wide_table(spark, "medication", drugs), keys).first()
    assert meds["beta_blocker_count"] == 2 and meds["arb_count"] == 0
    notes = [(1, "HTN with renal failure"), (1, "HTN with renal failure"), (1, None)]
    out = external.comorbidities(wide_table(spark, "diagnosis", notes), keys).first()
    assert out["hypertension"] == 1 and out["chronic_kidney_disease"] == 1 and out["total_diagnoses"] == 1


def test_wide_temporal_needs_three_rows(spark):
    keys = spark.createDataFrame([(1,), (2,)], "patientunitstayid BIGINT")
    rows = [(k, t, None, None, None, 80.0 + t, 15.0, None, 100.0, None, None) for k, n in ((1, 3), (2, 2)) for t in range(n)]
    rows += [(2, 9, None, None, None, 80.0, 15.0, None, 101.0, None, None)]
    out = external.temporal(wide_table(spark, "vitalperiodic", rows), keys).collect()
    assert [(r["patientunitstayid"], r["total_measurements"], r["measurement_span_minutes"]) for r in out] == [(1, 3, 2)]


def test_conditional_agg_equals_filter_then_agg(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id % 3 AS c", "CAST(id AS DOUBLE) AS v")
    out = by_key(conditional_agg(df, "k", [Feature("m", "avg", "v", "c = 1"), Feature("n", "rows", when="c = 1")]), "k")
    want = by_key(df.where("c = 1").groupBy("k").agg({"v": "avg", "*": "count"}), "k")
    for k, r in want.items():
        assert out[k]["m"] == pytest.approx(r["avg(v)"]) and out[k]["n"] == r["count(1)"]
