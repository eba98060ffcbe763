"""Report tables over predictions derived from the event stream."""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icufeat.checks.base import NUDGE, Check, r4, read, tidy
from icufeat.functions.order_stats import exact_ranks
from icufeat.operators import evaluate, report
from icufeat.plans import specs


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Event values as truth, pulled towards the user's mean as prediction."""
    e = read(spark, folder, "events")
    is_sbp = F.col("event_type").isin("click", "view", "error")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    base = e.select(
        F.col("event_id").alias("key"),
        "user_id",
        "ts",
        F.when(is_sbp, "SBP").otherwise("DBP").alias("target"),
        F.when(is_sbp, F.col("value") + 60).otherwise(F.col("value") * 0.6 + 40).alias("y_true"),
        k.alias("k"),
    )
    means = base.groupBy("user_id", "target").agg(F.avg("y_true").alias("user_mean"))
    return base.join(means, ["user_id", "target"]).select(
        "key",
        "target",
        (F.col("user_id") % 5 + 1).alias("fold"),
        "ts",
        "y_true",
        F.round(F.col("y_true") * 0.8 + F.col("user_mean") * 0.2 + (F.col("k") % 11 - 5) + NUDGE, 3).alias("y_pred"),
        F.round(F.col("user_mean") - (F.col("k") % 30) - 12 + NUDGE, 3).alias("lower"),
        F.round(F.col("user_mean") + (F.col("k") % 30) + 12 + NUDGE, 3).alias("upper"),
    )


PREDS = """WITH raw AS (
  SELECT event_id AS key, user_id, ts, CASE WHEN event_type IN ('click', 'view', 'error') THEN 'SBP' ELSE 'DBP' END AS target,
         CASE WHEN event_type IN ('click', 'view', 'error') THEN value + 60 ELSE value * 0.6 + 40 END AS y_true,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events),
preds AS (
  SELECT key, target, user_id % 5 + 1 AS fold, ts, y_true,
         round(y_true * 0.8 + user_mean * 0.2 + (k % 11 - 5) + 0.0000013, 3) AS y_pred,
         round(user_mean - (k % 30) - 12 + 0.0000013, 3) AS lower, round(user_mean + (k % 30) + 12 + 0.0000013, 3) AS upper
  FROM (SELECT *, avg(y_true) OVER (PARTITION BY user_id, target) AS user_mean FROM raw)),
err AS (SELECT *, y_true - y_pred AS error, abs(y_true - y_pred) AS abs_error, upper - lower AS width FROM preds)"""


def _w(n: int, x: str = "abs_error") -> str:
    return f"avg(CASE WHEN {x} <= {n} THEN 100.0 ELSE 0.0 END)"


WITHIN = ", ".join(f"{r4(_w(n))} AS within_{n}" for n in (5, 10, 15))
GRADE = (
    f"CASE WHEN {_w(5)} >= 60 AND {_w(10)} >= 85 AND {_w(15)} >= 95 THEN 'A'"
    f" WHEN {_w(5)} >= 50 AND {_w(10)} >= 75 AND {_w(15)} >= 90 THEN 'B'"
    f" WHEN {_w(5)} >= 40 AND {_w(10)} >= 65 AND {_w(15)} >= 85 THEN 'C' ELSE 'D' END"
)
FIT = f"""count(*) AS n, {r4('avg(error * error)')} AS mse, {r4('sqrt(avg(error * error))')} AS rmse,
  {r4('avg(abs_error)')} AS mae, {r4('1 - sum(error * error) / (count(*) * var_pop(y_true))')} AS r2,
  {r4('corr(y_true, y_pred)')} AS pearson_r"""
INTERVAL = f"""{r4('avg(CASE WHEN y_true BETWEEN lower AND upper THEN 100.0 ELSE 0.0 END)')} AS interval_coverage,
  {r4('avg(upper - lower)')} AS interval_width"""
RANKED = """ranked AS (
  SELECT target, rank() OVER (PARTITION BY target ORDER BY y_true) + (count(*) OVER (PARTITION BY target, y_true) - 1) / 2.0 AS rt,
         rank() OVER (PARTITION BY target ORDER BY y_pred) + (count(*) OVER (PARTITION BY target, y_pred) - 1) / 2.0 AS rp FROM preds)"""


def _category_sql() -> str:
    parts = []
    for target, edges in specs.REPORT_EDGES.items():
        for (lo, hi), label in zip(pairwise(edges), specs.REPORT_LABELS, strict=True):
            parts.append(f"WHEN target = '{target}' AND y_true > {lo} AND y_true <= {hi} THEN '{label}'")
    return f"CASE {' '.join(parts)} END"


CLASSES = " UNION ALL ".join(
    f"SELECT '{t}' AS target, {i} AS position, '{label}' AS category"
    for t in specs.REPORT_EDGES
    for i, label in enumerate(specs.REPORT_LABELS)
)


def _table(build):
    return lambda spark, folder: tidy(build(predictions(spark, folder)))


def _metrics_of(spark: SparkSession, folder: str, when: str) -> DataFrame:
    p = predictions(spark, folder).where(when)
    errors = evaluate.with_errors(p)
    fit = evaluate.fold_metrics(p, ["target"])
    return fit.join(errors.groupBy("target").agg(*evaluate.within_columns()), "target")


BEFORE, AFTER = "ts < '2024-01-16'", "ts >= '2024-01-16'"


def _compare(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(report.internal_vs_external(_metrics_of(spark, folder, BEFORE), _metrics_of(spark, folder, AFTER)))


def _halves() -> str:
    one = (
        "SELECT target, sqrt(avg(error * error)) AS rmse, 1 - sum(error * error) / (count(*) * var_pop(y_true)) AS r2,"
        f" {_w(5)} AS within_5, {GRADE} AS grade FROM err WHERE "
    )
    return f"{PREDS}, a AS ({one}{BEFORE} GROUP BY target), b AS ({one}{AFTER} GROUP BY target)"


COMPARE_SQL = f"""{_halves()}
SELECT target, {r4('a.rmse')} AS internal_rmse, {r4('a.r2')} AS internal_r2, {r4('a.within_5')} AS internal_within_5,
       {r4('b.rmse')} AS external_rmse, {r4('b.r2')} AS external_r2, {r4('b.within_5')} AS external_within_5,
       {r4('(b.rmse - a.rmse) * 100 / a.rmse')} AS rmse_change, {r4('(b.r2 - a.r2) * 100 / a.r2')} AS r2_change,
       {r4('b.within_5 - a.within_5')} AS within_5_change,
       CASE WHEN abs((b.rmse - a.rmse) * 100 / a.rmse) < CASE WHEN target = 'SBP' THEN 20 ELSE 30 END
            THEN CASE WHEN target = 'SBP' THEN 'good generalizability' ELSE 'acceptable generalizability' END
            ELSE 'reduced generalizability' END AS verdict
FROM a JOIN b USING (target)"""

LITERATURE_SQL = "lit(method, target, rmse, r2, within_5) AS (VALUES " + ", ".join(
    f"('{m}', '{t}', {rmse}, {r2}, {w})" for m, t, rmse, r2, w in report.LITERATURE
) + ")"
OWN = (
    "own AS (SELECT target, sqrt(avg(error * error)) AS rmse, 1 - sum(error * error) / (count(*) * var_pop(y_true)) AS r2,"
    f" {_w(5)} AS within_5 FROM err GROUP BY target),"
    " merged AS (SELECT method, target, CAST(rmse AS DOUBLE) AS rmse, CAST(r2 AS DOUBLE) AS r2, CAST(within_5 AS DOUBLE) AS within_5"
    " FROM lit UNION ALL SELECT 'This study', target, rmse, r2, within_5 FROM own)"
)


def _own(spark: SparkSession, folder: str) -> DataFrame:
    return _metrics_of(spark, folder, "true")


def _summary(spark: SparkSession, folder: str) -> DataFrame:
    parts = {"internal": BEFORE, "external": AFTER}
    return tidy(
        report.final_summary(
            {n: _metrics_of(spark, folder, w) for n, w in parts.items()},
            {n: evaluate.agreement(predictions(spark, folder).where(w), with_p=False) for n, w in parts.items()},
        )
    )


def _rank_table(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(exact_ranks(predictions(spark, folder), ["target"], "y_pred"))


def _coverage_grade(name: str) -> str:
    return f"{PREDS} {name}"


CHECKS: dict[str, Check] = {
    "error_metrics": Check(
        _table(evaluate.error_metrics),
        f"""{PREDS}, {RANKED}, s AS (SELECT target, corr(rt, rp) AS spearman FROM ranked GROUP BY target)
        SELECT m.*, {r4('s.spearman')} AS spearman_r FROM (
          SELECT target, {FIT}, {WITHIN}, {INTERVAL}, {r4('quantile_cont(abs_error, 0.5)')} AS median_error,
                 {r4('quantile_cont(abs_error, 0.9)')} AS p90_error, {r4('quantile_cont(abs_error, 0.95)')} AS p95_error
          FROM err GROUP BY target) m JOIN s USING (target)""",
    ),
    "fold_metrics": Check(_table(evaluate.fold_metrics), f"{PREDS} SELECT target, fold, {FIT} FROM err GROUP BY target, fold"),
    "interval_quality": Check(
        _table(evaluate.interval_quality),
        f"{PREDS} SELECT target, {INTERVAL}, count(CASE WHEN lower > upper THEN 1 END) AS n_crossed FROM err GROUP BY target",
    ),
    "average_ranks": Check(
        _rank_table,
        f"{PREDS} SELECT DISTINCT target, y_pred, n_tied, n_below, {r4('n_below + (n_tied + 1) / 2.0')} AS average_rank FROM ("
        " SELECT target, y_pred, count(*) OVER (PARTITION BY target, y_pred) AS n_tied,"
        " rank() OVER (PARTITION BY target ORDER BY y_pred) - 1 AS n_below FROM preds)",
    ),
    "rank_correlation": Check(
        _table(evaluate.rank_correlation), f"{PREDS}, {RANKED} SELECT target, {r4('corr(rt, rp)')} AS spearman_r FROM ranked GROUP BY target"
    ),
    "agreement": Check(
        _table(lambda p: evaluate.agreement(p, with_p=False)),
        f"""{PREDS} SELECT target, count(*) AS n, {r4('avg(error)')} AS mean_difference, {r4('stddev_samp(error)')} AS std_difference,
        {r4('avg(abs_error)')} AS mae, {WITHIN}, {r4('avg(error) - 1.96 * stddev_samp(error)')} AS limit_low,
        {r4('avg(error) + 1.96 * stddev_samp(error)')} AS limit_high, {r4('stddev_samp(error) / sqrt(count(*))')} AS se,
        {r4('avg(error) / (stddev_samp(error) / sqrt(count(*)))')} AS t_statistic, {GRADE} AS bhs_grade,
        abs(avg(error)) <= 5 AND stddev_samp(error) <= 8 AS aami_pass FROM err GROUP BY target""",
    ),
    # The p-value by midpoints of the density between 0 and |t|.
    "paired_t_test": Check(
        _table(lambda p: evaluate.agreement(p).select("target", "n", "t_statistic", "p_value")),
        f"""{PREDS}, s AS (SELECT target, count(*) AS n, avg(error) / (stddev_samp(error) / sqrt(count(*))) AS t FROM err GROUP BY target),
        d AS (SELECT target, n, t, exp(lgamma(n / 2.0) - lgamma((n - 1) / 2.0) - ln((n - 1) * pi()) / 2
          - n / 2.0 * ln(1 + pow((k + 0.5) * abs(t) / 20000, 2) / (n - 1))) * abs(t) / 20000 AS part FROM s, range(20000) r(k))
        SELECT target, any_value(n) AS n, {r4('any_value(t)')} AS t_statistic, {r4('1 - 2 * sum(part)')} AS p_value FROM d GROUP BY target""",
    ),
    "stratified_report": Check(
        _table(evaluate.stratified_report),
        f"""{PREDS}, c AS ({CLASSES}), g AS (SELECT target, {_category_sql()} AS category, count(*) AS n, {r4('avg(abs_error)')} AS mae,
        {r4('stddev_samp(abs_error)')} AS error_std, {r4('quantile_cont(abs_error, 0.5)')} AS median_error, {WITHIN}, {GRADE} AS bhs_grade
        FROM err GROUP BY 1, 2) SELECT c.target, c.position, c.category, coalesce(n, 0) AS n, mae, error_std, median_error,
        within_5, within_10, within_15, coalesce(bhs_grade, 'D') AS bhs_grade FROM c LEFT JOIN g USING (target, category)""",
    ),
    "threshold_detection": Check(
        _table(evaluate.detection),
        f"""{PREDS}, c AS (SELECT target, 'hypotension' AS condition, y_true < 90 AS t, y_pred < 90 AS p FROM preds
        UNION ALL SELECT target, 'hypertension', y_true > 140, y_pred > 140 FROM preds)
        SELECT target, condition, {', '.join(
            f"coalesce({r4(f'sum(CASE WHEN {a} AND {b} THEN 100.0 ELSE 0.0 END) / nullif(count(CASE WHEN {w} THEN 1 END), 0)')}, 0.0) AS {n}"
            for n, a, b, w in (("sensitivity", "t", "p", "t"), ("specificity", "NOT t", "NOT p", "NOT t"), ("ppv", "t", "p", "p"), ("npv", "NOT t", "NOT p", "NOT p"))
        )} FROM c GROUP BY target, condition""",
    ),
    "risk_tertiles_and_workload": Check(
        _table(lambda p: evaluate.workload(evaluate.risk_tertiles(p))),
        f"""{PREDS}, q AS (SELECT target, quantile_cont(width, 0.33) AS p33, quantile_cont(width, 0.66) AS p66 FROM err GROUP BY target),
        c AS (SELECT target, count(CASE WHEN width <= p33 THEN 1 END) AS low_risk,
              count(CASE WHEN width > p33 AND width <= p66 THEN 1 END) AS medium_risk, count(CASE WHEN width > p66 THEN 1 END) AS high_risk
              FROM err JOIN q USING (target) GROUP BY target),
        r AS (SELECT *, (low_risk * 24 * 0.5 + medium_risk * 24 * 0.75 + high_risk * 24) * 3.0 AS reduced FROM c)
        SELECT target, low_risk, medium_risk, high_risk, CAST(72000 AS DOUBLE) AS baseline_minutes, {r4('reduced')} AS reduced_minutes,
        {r4('72000.0 - reduced')} AS saved_minutes, {r4('(72000.0 - reduced) / 60')} AS nurse_hours_saved,
        {r4('(72000.0 - reduced) * 100 / 72000.0')} AS percent_saved, {r4('high_risk * 0.2 * 30')} AS early_warning_minutes FROM r""",
    ),
    "agreement_points": Check(
        _table(evaluate.agreement_points),
        f"{PREDS} SELECT key, target, {r4('(y_true + y_pred) / 2')} AS pair_mean, {r4('y_true - y_pred')} AS difference FROM preds",
    ),
    "error_boxes": Check(
        _table(evaluate.error_boxes),
        f"""{PREDS} SELECT target, {_category_sql()} AS category, {', '.join(
            f"{r4(f'quantile_cont(abs_error, {p})')} AS {n}" for n, p in (("low", 0.0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("high", 1.0))
        )} FROM err GROUP BY 1, 2 HAVING category IS NOT NULL""",
    ),
    "width_trend": Check(
        _table(evaluate.width_trend),
        f"{PREDS} SELECT target, {r4('regr_slope(abs_error, width)')} AS slope, {r4('regr_intercept(abs_error, width)')} AS intercept,"
        f" {r4('corr(width, abs_error)')} AS correlation FROM err GROUP BY target",
    ),
    "every_tenth_by_truth": Check(
        _table(lambda p: evaluate.every_nth(p).select("key", "target", "y_true", "y_pred", "lower", "upper")),
        f"""{PREDS}, n AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY y_true, key) AS rn FROM preds)
        SELECT key, target, {', '.join(f'{r4(c)} AS {c}' for c in ('y_true', 'y_pred', 'lower', 'upper'))} FROM n WHERE (rn - 1) % 10 = 0""",
    ),
    "internal_vs_external": Check(_compare, COMPARE_SQL),
    "literature_comparison": Check(
        lambda s, f: tidy(report.literature_comparison(_own(s, f))),
        f"""{PREDS}, {LITERATURE_SQL}, {OWN},
        best AS (SELECT target, min(rmse) AS best_rmse, arg_min(method, (rmse, method)) AS best_method, max(within_5) AS best_within_5 FROM lit GROUP BY target),
        j AS (SELECT o.target, o.rmse, o.within_5, CAST(best_rmse AS DOUBLE) AS best_rmse, best_method, CAST(best_within_5 AS DOUBLE) AS best_within_5,
              o.rmse < best_rmse AS improves_rmse, CASE WHEN o.rmse < best_rmse THEN (best_rmse - o.rmse) * 100 / best_rmse END AS rmse_improvement,
              o.within_5 > best_within_5 AS improves_within_5 FROM own o JOIN best USING (target))
        SELECT target, {r4('rmse')} AS rmse, {r4('within_5')} AS within_5, best_rmse, best_method, best_within_5, improves_rmse,
               {r4('rmse_improvement')} AS rmse_improvement, improves_within_5,
               (SELECT CASE WHEN bool_and(improves_rmse) THEN 'state-of-the-art' WHEN bool_or(improves_rmse) THEN 'competitive'
                       WHEN bool_or(improves_within_5) THEN 'improved clinical metrics' ELSE 'comparable' END FROM j) AS verdict FROM j""",
    ),
    "method_table": Check(
        lambda s, f: tidy(report.with_literature(_own(s, f))),
        f"{PREDS}, {LITERATURE_SQL}, {OWN} SELECT method, target, {r4('rmse')} AS rmse, {r4('r2')} AS r2, {r4('within_5')} AS within_5 FROM merged",
    ),
    "best_method": Check(
        lambda s, f: report.best_method(report.with_literature(_own(s, f))),
        f"{PREDS}, {LITERATURE_SQL}, {OWN} SELECT target, arg_min(method, (rmse, method)) AS lowest_rmse, arg_max(method, (within_5, method)) AS highest_within_5 FROM merged GROUP BY target",
    ),
    "radar_scores": Check(
        lambda s, f: tidy(report.radar_scores(report.with_literature(_own(s, f)))),
        f"""{PREDS}, {LITERATURE_SQL}, {OWN} SELECT method, target, axis, {r4('score')} AS score FROM (
        SELECT method, target, 'rmse' AS axis, 1 - rmse / CASE WHEN target = 'SBP' THEN 15.0 ELSE 10.0 END AS score FROM merged
        UNION ALL SELECT method, target, 'within_5', within_5 / 100 FROM merged UNION ALL SELECT method, target, 'r2', r2 FROM merged)""",
    ),
    "final_summary": Check(
        _summary,
        f"""{_halves()} SELECT 'internal' AS dataset, target, {r4('rmse')} AS rmse, {r4('r2')} AS r2, {r4('within_5')} AS within_5, grade AS bhs_grade FROM a
        UNION ALL SELECT 'external', target, {r4('rmse')}, {r4('r2')}, {r4('within_5')}, grade FROM b""",
    ),
}
