"""Error, agreement, grade, detection and workload tables over predictions.

Predictions are long: (key, target, fold, y_true, y_pred, lower, upper). Every
table is an aggregate by target, so a target is a group key and never a loop.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icufeat.functions.order_stats import exact_quantiles, ordered_parts, ranks_of
from icufeat.functions.prefix import running_sums
from icufeat.functions.scalars import correlation, percent, right_closed_bins
from icufeat.functions.student import p_value
from icufeat.plans import specs
from icufeat.session import cut_lineage, join_small

WITHIN = (5, 10, 15)


def with_errors(preds: DataFrame) -> DataFrame:
    error = F.col("y_true") - F.col("y_pred")
    return preds.withColumns({"error": error, "abs_error": F.abs(error)})


def within_columns(error: str = "abs_error") -> list[Column]:
    return [percent(F.col(error) <= w).alias(f"within_{w}") for w in WITHIN]


def device_grade(w5: str = "within_5", w10: str = "within_10", w15: str = "within_15") -> Column:
    """A to D by cumulative percentages of errors within 5, 10 and 15."""
    bars = (("A", 60, 85, 95), ("B", 50, 75, 90), ("C", 40, 65, 85))
    grade = F.when(F.lit(False), F.lit(None).cast("string"))
    for letter, a, b, c in bars:
        grade = grade.when((F.col(w5) >= a) & (F.col(w10) >= b) & (F.col(w15) >= c), F.lit(letter))
    return grade.otherwise(F.lit("D"))


def fit_columns() -> list[Column]:
    e = F.col("error")
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg("abs_error").alias("mae"),
        (1 - F.try_divide(F.sum(e * e), F.count(e) * F.var_pop("y_true"))).alias("r2"),
        correlation("y_true", "y_pred").alias("pearson_r"),
    ]


def fold_metrics(preds: DataFrame, by: Sequence[str] = ("target", "fold")) -> DataFrame:
    """Squared, absolute and explained error and the linear correlation per group."""
    return with_errors(preds).groupBy(*by).agg(*fit_columns())


def _ranked_cells(preds: DataFrame, by: Sequence[str], axes: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Distinct (by…, x, y, n), and the ranks (by…, axis, value, n, n_below, average_rank) along each axis, both stored.

    All axes are ranked in one pass over the distinct values.
    """
    pairs = preds.where(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())
    cells = cut_lineage(pairs.groupBy(*by, F.col("y_true").cast("double").alias("x"), F.col("y_pred").cast("double").alias("y")).agg(F.count(F.lit(1)).alias("n")))
    values = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), v.alias("value")) for a, v in axes.items()]))
    each = cells.select(*by, "n", values.alias("v")).groupBy(*by, "v.axis", "v.value").agg(F.sum("n").alias("n"))
    return cells, cut_lineage(ranks_of(each, [*by, "axis"], "value", "n"))


def _rank_correlation(cells: DataFrame, ranks: DataFrame, by: Sequence[str]) -> DataFrame:
    """Linear correlation of the average ranks, every cell counted as often as it occurs."""
    found = cells
    for axis in ("x", "y"):
        own = ranks.where(F.col("axis") == axis).select(*by, F.col("value").alias(axis), F.col("average_rank").alias(f"__{axis}"))
        found = join_small(found, own, [*by, axis])
    n, x, y = (F.col(c) for c in ("n", "__x", "__y"))
    sums = found.groupBy(*by).agg(
        F.sum(n).alias("n"), *[F.sum(n * e).alias(name) for name, e in {"x": x, "y": y, "xx": x * x, "yy": y * y, "xy": x * y}.items()]
    )
    cov, var_x, var_y = (F.col(p) / F.col("n") - F.col(a) * F.col(b) / (F.col("n") * F.col("n")) for p, a, b in (("xy", "x", "y"), ("xx", "x", "x"), ("yy", "y", "y")))
    return sums.select(*by, F.try_divide(cov, F.sqrt(var_x * var_y)).alias("spearman_r"))


def rank_correlation(preds: DataFrame, by: Sequence[str] = ("target",), x: str = "y_true", y: str = "y_pred") -> DataFrame:
    """Spearman's correlation per group, ties sharing their average rank."""
    pairs = preds.select(*by, F.col(x).alias("y_true"), F.col(y).alias("y_pred"))
    return _rank_correlation(*_ranked_cells(pairs, by, {"x": F.col("x"), "y": F.col("y")}), by)


def _quantiles_by_rank(ranks: DataFrame, by: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """One row per group with the linearly interpolated quantile for each `name: p`, from ranked distinct values."""
    sizes = ranks.groupBy(*by).agg(F.sum("n").alias("__n"))
    placed = join_small(ranks, sizes, by)

    def at(k: Column) -> Column:
        return F.max(F.when((F.col("n_below") <= k) & (k < F.col("n_below") + F.col("n")), F.col("value")))

    parts = []
    for name, p in probs.items():
        place = (F.col("__n") - 1) * F.lit(float(p))
        share = F.max(place - F.floor(place))
        low, high = at(F.floor(place)), at(F.ceil(place))
        parts.append((low + share * (high - low)).alias(name))
    return placed.groupBy(*by).agg(*parts)


def error_metrics(preds: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    """One row per group: fit, clinical thresholds, error quantiles and interval quality."""
    by = list(by)
    out = with_errors(preds).groupBy(*by).agg(*fit_columns(), *within_columns(), *interval_columns())
    axes = {"x": F.col("x"), "y": F.col("y"), "error": F.abs(F.col("x") - F.col("y"))}
    cells, ranks = _ranked_cells(preds, by, axes)
    errors = ranks.where(F.col("axis") == "error")
    spread = _quantiles_by_rank(errors, by, {"median_error": 0.5, "p90_error": 0.9, "p95_error": 0.95})
    for part in (_rank_correlation(cells, ranks, by), spread):
        out = _beside(out, part, by)
    return out


def _beside(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({b: f"__r_{b}" for b in by})
    condition = F.lit(True)
    for b in by:
        condition = condition & left[b].eqNullSafe(renamed[f"__r_{b}"])
    return left.join(renamed, condition, "left").drop(*[f"__r_{b}" for b in by])


def interval_columns() -> list[Column]:
    covered = F.col("y_true").between(F.col("lower"), F.col("upper"))
    return [
        percent(covered).alias("interval_coverage"),
        F.avg(F.col("upper") - F.col("lower")).alias("interval_width"),
    ]


def interval_quality(preds: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    """Coverage, mean width and the number of intervals whose ends are crossed."""
    return preds.groupBy(*by).agg(
        *interval_columns(), F.count_if(F.col("lower") > F.col("upper")).alias("n_crossed")
    )


def agreement(preds: DataFrame, by: Sequence[str] = ("target",), *, with_p: bool = True) -> DataFrame:
    """Bias and limits of agreement, paired t test, device grade and standard."""
    base = (
        with_errors(preds)
        .groupBy(*by)
        .agg(
            F.count("error").alias("n"),
            F.avg("error").alias("mean_difference"),
            F.stddev_samp("error").alias("std_difference"),
            F.avg("abs_error").alias("mae"),
            *within_columns(),
        )
    )
    bias, sd = F.col("mean_difference"), F.col("std_difference")
    se = sd / F.sqrt(F.col("n"))
    out = base.withColumns(
        {
            "limit_low": bias - 1.96 * sd,
            "limit_high": bias + 1.96 * sd,
            "se": se,
            "t_statistic": F.try_divide(bias, se),
            "bhs_grade": device_grade(),
            "aami_pass": (F.abs(bias) <= 5) & (sd <= 8),
        }
    )
    return out.withColumn("p_value", p_value(F.col("t_statistic"), F.col("n") - 1)) if with_p else out


def _category(edges: Mapping[str, Sequence[float]], labels: Sequence[str]) -> Column:
    chosen = F.when(F.lit(False), F.lit(None).cast("string"))
    for target, cuts in edges.items():
        chosen = chosen.when(F.col("target") == target, right_closed_bins("y_true", cuts, labels))
    return chosen


def stratified_report(
    preds: DataFrame,
    edges: Mapping[str, Sequence[float]] = specs.REPORT_EDGES,
    labels: Sequence[str] = specs.REPORT_LABELS,
) -> DataFrame:
    """Errors per clinical class of the true value; classes without rows appear with count 0."""
    rows = with_errors(preds).withColumn("category", _category(edges, labels)).where("category IS NOT NULL")
    by = ["target", "category"]
    stats = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("abs_error").alias("mae"),
        F.stddev_samp("abs_error").alias("error_std"),
        *within_columns(),
    )
    medians = exact_quantiles(rows, by, "abs_error", {"median_error": 0.5})
    spark = preds.sparkSession
    classes = spark.createDataFrame(
        [(t, i, label) for t in edges for i, label in enumerate(labels)],
        "target STRING, position INT, category STRING",
    )
    out = _beside(_beside(classes, stats, by), medians, by)
    return out.withColumn("n", F.coalesce("n", F.lit(0).cast("bigint"))).withColumn("bhs_grade", device_grade())


def detection(
    preds: DataFrame, *, low: float = 90, high: float = 140, by: Sequence[str] = ("target",)
) -> DataFrame:
    """Sensitivity, specificity and predictive values, in percent, for low and high pressure."""
    t, p = F.col("y_true"), F.col("y_pred")
    cases = F.array(
        F.struct(F.lit("hypotension").alias("condition"), (t < low).alias("truth"), (p < low).alias("called")),
        F.struct(F.lit("hypertension").alias("condition"), (t > high).alias("truth"), (p > high).alias("called")),
    )
    rows = preds.select(*by, F.explode(cases).alias("c")).select(*by, "c.condition", "c.truth", "c.called")
    truth, called = F.col("truth"), F.col("called")

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(F.count_if(part) * 100.0, F.count_if(whole)), F.lit(0.0))

    return rows.groupBy(*by, "condition").agg(
        share(truth & called, truth).alias("sensitivity"),
        share(~truth & ~called, ~truth).alias("specificity"),
        share(truth & called, called).alias("ppv"),
        share(~truth & ~called, ~called).alias("npv"),
    )


def risk_tertiles(preds: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    """Rows per risk class by interval width: above p66 high, above p33 medium, else low."""
    by = list(by)
    widths = preds.select(*by, (F.col("upper") - F.col("lower")).alias("width")).where("width IS NOT NULL")
    cuts = exact_quantiles(widths, by, "width", {"__p33": 0.33, "__p66": 0.66})
    w = F.col("width")
    risk = F.when(w > F.col("__p66"), "high").when(w > F.col("__p33"), "medium").otherwise("low")
    tallied = join_small(widths, cuts, by).groupBy(*by).agg(
        *[F.count_if(risk == r).alias(f"{r}_risk") for r in ("low", "medium", "high")]
    )
    return tallied


def workload(
    tertiles: DataFrame,
    *,
    patients: int = 1000,
    per_day: int = 24,
    minutes: int = 3,
    cuts: Mapping[str, float] | None = None,
    needing: float = 0.2,
    earlier: int = 30,
) -> DataFrame:
    """Measurement time saved when low-risk patients are measured less often."""
    cuts = cuts or {"low": 0.5, "medium": 0.25, "high": 0.0}
    kept = sum((F.col(f"{r}_risk") * per_day * (1 - c) for r, c in cuts.items()), F.lit(0.0))
    reduced = kept * minutes
    baseline = F.lit(float(patients * per_day * minutes))
    return tertiles.withColumns(
        {
            "baseline_minutes": baseline,
            "reduced_minutes": reduced,
            "saved_minutes": baseline - reduced,
            "nurse_hours_saved": (baseline - reduced) / 60.0,
            "percent_saved": (baseline - reduced) * 100.0 / baseline,
            "early_warning_minutes": F.col("high_risk") * needing * float(earlier),
        }
    )


def agreement_points(preds: DataFrame) -> DataFrame:
    """Mean and difference of each pair."""
    return preds.select(
        "key",
        "target",
        ((F.col("y_true") + F.col("y_pred")) / 2).alias("pair_mean"),
        (F.col("y_true") - F.col("y_pred")).alias("difference"),
    )


def error_boxes(
    preds: DataFrame,
    edges: Mapping[str, Sequence[float]] = specs.REPORT_EDGES,
    labels: Sequence[str] = specs.REPORT_LABELS,
) -> DataFrame:
    """Five-number summary of the absolute error per class."""
    rows = with_errors(preds).withColumn("category", _category(edges, labels)).where("category IS NOT NULL")
    quartiles = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}
    return exact_quantiles(rows, ["target", "category"], "abs_error", quartiles)


def width_trend(preds: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    """Line and correlation of the absolute error over the interval width."""
    rows = with_errors(preds).withColumn("width", F.col("upper") - F.col("lower"))
    both = F.col("width").isNotNull() & F.col("abs_error").isNotNull()
    x, y = F.when(both, F.col("width")), F.when(both, F.col("abs_error"))
    slope = F.try_divide(F.covar_pop(x, y), F.var_pop(x))
    return rows.groupBy(*by).agg(
        slope.alias("slope"),
        (F.avg(y) - slope * F.avg(x)).alias("intercept"),
        correlation("width", "abs_error").alias("correlation"),
    )


def every_nth(preds: DataFrame, n: int = 10) -> DataFrame:
    """Every n-th row of each target by true value, beginning with the first; ties by key."""
    rows = preds.where("y_true IS NOT NULL")
    placed = ordered_parts(rows, ["target", "y_true", "key"])
    numbered = running_sums(placed, ["target"], "__part", [F.col("y_true"), F.col("key")], {"__row": F.lit(1)})
    return numbered.where((F.col("__row") - 1) % n == 0).drop("__row", "__part")
