"""Report tables, with published figures that need no patient data."""

import random

import pytest
from pyspark.sql import functions as F

from icufeat.functions.order_stats import exact_quantiles, exact_ranks, modes, ordered_parts
from icufeat.functions.student import two_sided_p
from icufeat.operators import evaluate, prepare, report

PREDS = "key BIGINT, target STRING, fold INT, y_true DOUBLE, y_pred DOUBLE, lower DOUBLE, upper DOUBLE"


def preds(spark, rows):
    return spark.createDataFrame([(i, t, 1, float(a), float(b), float(lo), float(hi)) for i, (t, a, b, lo, hi) in enumerate(rows)], PREDS)


def test_student_tail():
    assert two_sided_p(-0.7388657084736107, 888) == pytest.approx(0.46018379109575, abs=1e-9)
    assert two_sided_p(0.10779308397024001, 888) == pytest.approx(0.9141841786310664, abs=1e-9)
    assert two_sided_p(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert two_sided_p(0.0, 5) == 1.0


def test_agreement_arithmetic(spark):
    bias, sd, n = -0.149356769008539, 6.027126123430192, 889
    assert bias - 1.96 * sd == pytest.approx(-11.962523970931716)
    assert bias / (sd / n**0.5) == pytest.approx(-0.7388657084736107)
    out = evaluate.agreement(preds(spark, [("SBP", 100, 101, 90, 110), ("SBP", 100, 99, 90, 110), ("SBP", 104, 100, 90, 110)])).first()
    assert out["mean_difference"] == pytest.approx(4 / 3) and out["std_difference"] == pytest.approx(2.5166, abs=1e-4)
    assert out["bhs_grade"] == "A" and out["aami_pass"] and out["p_value"] == pytest.approx(0.455669, abs=1e-5)


@pytest.mark.parametrize(
    ("within", "grade"),
    [((57.03, 91.11, 98.99), "B"), ((60.4, 90.1, 96.97), "A"), ((20.0, 53.3, 66.7), "D"), ((63.2, 93.7, 100.0), "A"), ((40.0, 65.0, 85.0), "C")],
)
def test_grades(spark, within, grade):
    df = spark.createDataFrame([within], "within_5 DOUBLE, within_10 DOUBLE, within_15 DOUBLE")
    assert df.select(evaluate.device_grade()).first()[0] == grade


def test_within_five_from_strata():
    strata = [(8, 0.0), (461, 56.61605206073753), (302, 56.29139072847682), (95, 63.1578947368421), (23, 69.56521739130434)]
    assert sum(n * p for n, p in strata) / 889 == pytest.approx(57.03037120359955)


def test_workload_roll_up(spark):
    counts = spark.createDataFrame([("SBP", 383, 206, 300)], "target STRING, low_risk BIGINT, medium_risk BIGINT, high_risk BIGINT")
    out = evaluate.workload(counts).first()
    assert out["reduced_minutes"] == 46512 and out["saved_minutes"] == 25488
    assert out["nurse_hours_saved"] == pytest.approx(424.8) and out["percent_saved"] == pytest.approx(35.4)
    assert out["early_warning_minutes"] == pytest.approx(1800)


def test_comparisons(spark):
    schema = "target STRING, rmse DOUBLE, r2 DOUBLE, within_5 DOUBLE"
    inside = spark.createDataFrame([("SBP", 6.03, 0.861, 57.0), ("DBP", 7.13, 0.491, 55.7)], schema)
    outside = spark.createDataFrame([("SBP", 7.84, 0.84, 49.7), ("DBP", 9.31, 0.32, 43.9)], schema)
    out = {r["target"]: r for r in report.internal_vs_external(inside, outside).collect()}
    assert out["SBP"]["rmse_change"] == pytest.approx(30.0, abs=0.05) and out["DBP"]["rmse_change"] == pytest.approx(30.6, abs=0.05)
    assert out["SBP"]["verdict"].startswith("reduced")
    own = {r["target"]: r for r in report.literature_comparison(inside).collect()}
    assert own["SBP"]["rmse_improvement"] == pytest.approx(24.6, abs=0.1) and own["DBP"]["rmse_improvement"] is None
    assert own["SBP"]["verdict"] == "competitive" and own["SBP"]["best_method"] == "Clinical Oscillometric Devices"
    radar = {(r["method"], r["target"], r["axis"]): r["score"] for r in report.radar_scores(report.with_literature(inside)).collect()}
    assert radar["This study", "SBP", "rmse"] == pytest.approx(1 - 6.03 / 15) and len(radar) == 30


def test_stratified_report_edges_and_empty_classes(spark):
    rows = [("SBP", v, v + e, 0, 1) for v, e in ((90, 5), (90.1, 10), (120, 15), (140, 5), (160, 20))]
    out = {(r["target"], r["category"]): r for r in evaluate.stratified_report(preds(spark, rows)).collect()}
    assert len(out) == 10
    assert out["SBP", "Hypotension"]["n"] == 1 and out["SBP", "Hypotension"]["within_5"] == 100
    assert out["SBP", "Normal"]["n"] == 2 and out["SBP", "Normal"]["median_error"] == 12.5
    assert out["SBP", "Stage 2 HTN"]["n"] == 0 and out["SBP", "Stage 2 HTN"]["bhs_grade"] == "D"


def test_detection_with_empty_denominators(spark):
    out = {r["condition"]: r for r in evaluate.detection(preds(spark, [("SBP", 150, 150, 0, 1), ("SBP", 100, 141, 0, 1)])).collect()}
    assert out["hypotension"]["sensitivity"] == 0 and out["hypotension"]["specificity"] == 100
    assert out["hypertension"]["ppv"] == 50 and out["hypertension"]["npv"] == 0


def test_tertiles_with_equal_widths(spark):
    rows = [("SBP", 1, 1, 0, w) for w in [10] * 5 + [20] * 3 + [30] * 2]
    out = evaluate.risk_tertiles(preds(spark, rows)).first()
    assert (out["low_risk"], out["medium_risk"], out["high_risk"]) == (5, 3, 2)


def test_quantiles_ranks_and_modes_under_a_hot_group(spark):
    draw = random.Random(5)
    rows = [("hot", round(draw.gauss(0, 1), 2)) for _ in range(3000)] + [("tiny", 1.0), ("tiny", 2.0)] + [(None, 7.0), ("none", None)]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    out = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", {"lo": 0.0, "a": 0.33, "m": 0.5, "z": 0.95, "hi": 1.0}).collect()}
    values = sorted(v for g, v in rows if g == "hot")

    def interpolated(p):
        at = (len(values) - 1) * p
        i = int(at)
        return values[i] + (at - i) * (values[min(i + 1, len(values) - 1)] - values[i])

    for name, p in (("lo", 0.0), ("a", 0.33), ("m", 0.5), ("z", 0.95), ("hi", 1.0)):
        assert out["hot"][name] == pytest.approx(interpolated(p))
    assert out["tiny"]["m"] == 1.5 and out[None]["z"] == 7.0 and "none" not in out
    ranks = {r["v"]: r for r in exact_ranks(df.where("g = 'hot'"), ["g"], "v").collect()}
    for v in set(values):
        below, tied = sum(x < v for x in values), values.count(v)
        assert (ranks[v]["n_below"], ranks[v]["n_tied"], ranks[v]["average_rank"]) == (below, tied, below + (tied + 1) / 2)
    tied_mode = modes(spark.createDataFrame([("a", "y"), ("a", "x"), ("a", None)], "g STRING, v STRING"), ["g"], "v").first()
    assert tied_mode["mode"] == "x"


def test_rank_correlation_with_ties(spark):
    rows = [("SBP", a, b, 0, 1) for a, b in ((1, 2), (1, 3), (2, 3), (3, 1), (4, 9))]
    # Average ranks: x 1.5 1.5 3 4 5, y 2 3.5 3.5 1 5.
    out = evaluate.rank_correlation(preds(spark, rows)).first()["spearman_r"]
    assert out == pytest.approx(2.75 / 9.5)


def test_every_nth(spark):
    rows = [("SBP", i % 7, 0, 0, 1) for i in range(43)]
    out = evaluate.every_nth(preds(spark, rows), 10).collect()
    ordered = sorted((float(i % 7), i) for i in range(43))
    assert sorted((r["y_true"], r["key"]) for r in out) == ordered[::10]


def test_metrics_without_intervals(spark):
    df = preds(spark, [("SBP", 100, 104, 0, 1), ("SBP", 120, 110, 0, 1)]).withColumns({"lower": F.lit(None).cast("double"), "upper": F.lit(None).cast("double")})
    out = evaluate.error_metrics(df).first()
    assert out["interval_coverage"] is None and out["within_5"] == 50 and out["p90_error"] == pytest.approx(9.4)


def test_order_under_one_value_in_nearly_all_rows(spark):
    """Ranges part a tie by the next column: the fullest of eight holds less than a third of the rows."""
    rows = [(i, "SBP", 1, 120.0 if i % 10 else float(i % 700), 0.0, None, None) for i in range(30_000)]
    df = spark.createDataFrame(rows, "key BIGINT, target STRING, fold INT, y_true DOUBLE, y_pred DOUBLE, lower DOUBLE, upper DOUBLE").repartition(8)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in ordered_parts(df, ["target", "y_true", "key"]).groupBy("__part").count().collect()]
        got = sorted((r["y_true"], r["key"]) for r in evaluate.every_nth(df, 10).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(sizes) == 8 and max(sizes) < 10_000
    assert got == sorted((r[3], r[0]) for r in rows)[::10]


def test_codes_of_levels_that_begin_alike(spark):
    levels = [f"same beginning {i:04d}" for i in range(500)]
    df = spark.createDataFrame([(v,) for v in levels * 3 + [None]], "word STRING")
    got = {r["level"]: r["code"] for r in prepare.category_levels(df, "word").collect()}
    assert got == {v: i for i, v in enumerate(levels)}


def test_metrics_against_pandas(spark):
    import numpy as np
    import pandas as pd

    draw = np.random.default_rng(2)
    t = np.round(draw.normal(120, 15, 3_000))
    p = np.round(t + draw.normal(0, 8, 3_000))
    rows = [(i, "SBP", 1, float(a), float(b), float(b - 9), float(b + 9)) for i, (a, b) in enumerate(zip(t, p, strict=True))]
    rows += [(-1, "SBP", 1, None, 3.0, None, None), (-2, "DBP", 1, 4.0, 5.0, 3.0, 6.0)]
    df = spark.createDataFrame(rows, "key BIGINT, target STRING, fold INT, y_true DOUBLE, y_pred DOUBLE, lower DOUBLE, upper DOUBLE")
    out = evaluate.error_metrics(df)
    assert str(out._jdf.queryExecution().executedPlan()).count("Exchange") < 15
    one = {r["target"]: r for r in out.collect()}
    error = np.abs(t - p)
    assert one["SBP"]["spearman_r"] == pytest.approx(pd.Series(t).rank().corr(pd.Series(p).rank()))
    assert [one["SBP"][c] for c in ("median_error", "p90_error", "p95_error")] == pytest.approx(np.quantile(error, [0.5, 0.9, 0.95]))
    assert one["SBP"]["mae"] == pytest.approx(error.mean()) and one["DBP"]["spearman_r"] is None and one["DBP"]["p90_error"] == 1.0
