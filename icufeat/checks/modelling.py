"""Missing data, preparation, folds, scaling and models on tables derived from the event stream."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icufeat.checks import clinical, evaluation, features
from icufeat.checks.base import NUDGE, Check, over_views, r4, read, tidy
from icufeat.functions.order_stats import modes, unpivoted
from icufeat.operators import correlate, evaluate, missing, models, prepare, report, scaling
from icufeat.operators.assemble import feature_coverage
from icufeat.operators.chained import fit_chained
from icufeat.operators.folds import fold_balance, group_folds
from icufeat.operators.neighbours import neighbour_fill
from icufeat.operators.predict import blend, predict, route
from icufeat.plans import pipeline
from icufeat.session import cut_lineage
from icufeat.sources.sinks import metrics_document
from icufeat.sources.standin import clinical_catalog

KINDS = ("click", "view", "purchase", "signup", "error")


def gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Mean event value per (user, day) and kind; about 60 % null."""
    e = read(spark, folder, "events")
    day = F.to_date("ts")
    return (
        e.groupBy("user_id", day.alias("day"))
        .agg(*[(F.round(F.avg(F.when(F.col("event_type") == k, F.col("value"))) + NUDGE, 4)).alias(k) for k in KINDS], F.count(F.lit(1)).cast("double").alias("n"))
        .select((F.col("user_id") * 100 + F.dayofmonth("day")).alias("key"), "user_id", *KINDS, "n")
    )


GAPS = "gaps AS (SELECT user_id * 100 + day(ts) AS key, user_id, " + ", ".join(
    f"round(avg(CASE WHEN event_type = '{k}' THEN value END) + 0.0000013, 4) AS {k}" for k in KINDS
) + ", CAST(count(*) AS DOUBLE) AS n FROM events GROUP BY user_id, CAST(ts AS DATE), day(ts))"


def matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Complete model input per (user, day): five features and two targets, stored."""
    e = read(spark, folder, "events").withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).cast("int"))
    rows = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.avg("k").alias("k"),
        F.avg(F.hour("ts")).alias("hour"),
        F.max("value").alias("top"),
        F.min("value").alias("low"),
        F.sum("value").alias("total"),
    )
    return cut_lineage(
        rows.select(
            (F.col("user_id") * 100 + F.dayofmonth("day")).alias("key"),
            F.col("user_id").alias("group"),
            *MODEL_FEATURES,
            (60 + F.col("total") * 0.5).alias("sbp_mean"),
            (40 + F.col("top") * 0.3 + F.col("n")).alias("dbp_mean"),
        )
    )


MODEL_FEATURES = ("n", "k", "hour", "top", "low")


def _incomplete(spark: SparkSession, folder: str) -> DataFrame:
    return gaps(spark, folder).drop("user_id")


PROFILE_SQL = f"WITH {GAPS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {r4(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)')} AS fraction_missing,"
    f" CASE WHEN avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > 0.7 THEN 'high'"
    f" WHEN avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > 0 THEN 'regular' ELSE 'none' END AS severity FROM gaps"
    for c in (*KINDS, "n")
)
MEDIAN_SQL = f"WITH {GAPS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {r4(f'median({c})')} AS median FROM gaps" for c in KINDS
)
MODE_COLUMNS = ("insurance", "language", "ethnicity")
MODE_SQL = over_views("admissions", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (SELECT {c} FROM admissions WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode"
    for c in MODE_COLUMNS
))
FILLED = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM gaps)) AS {c}" for c in KINDS)
PAIRS = list(combinations(KINDS, 2))


def _corr_sql(source: str, x: str = "{a}", y: str = "{b}") -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {r4(clinical._corr(x.format(a=a), y.format(b=b)))} AS corr FROM {source}" for a, b in PAIRS
    )


MISS = "m AS (SELECT " + ", ".join(f"CASE WHEN {k} IS NULL THEN 1.0 ELSE 0.0 END AS {k}" for k in KINDS) + " FROM gaps)"
LONG_NUMBERS = ("hr_mean", "hr_std", "temp_mean", "gcs_mean")


def _codes(spark: SparkSession, folder: str) -> DataFrame:
    a = clinical_catalog(spark, folder)["admissions"]
    return prepare.encode(a.select("hadm_id", "language", "ethnicity"), "ethnicity", prepare.category_levels(a, "ethnicity"))


def _align(spark: SparkSession, folder: str) -> DataFrame:
    wanted = ["n", "admit_year", "click", "gender_male", "troponin_mean"]
    return tidy(prepare.align(gaps(spark, folder), wanted, keep=["key"]))


def _dropped(spark: SparkSession, folder: str) -> DataFrame:
    table = features.long_table(spark, folder)
    kept = prepare.require_no_leaks(prepare.model_columns(prepare.drop_leaky(table)))
    return tidy(kept)


def _counted(listed: DataFrame, table: DataFrame, name: str) -> DataFrame:
    """A list of columns with the number of values each has in the table."""
    numeric = [c for c in missing.numeric_columns(table)]
    held = feature_coverage(table, numeric).select(F.col("feature").alias(name), "n_present")
    zero = F.lit(0).cast("bigint")
    return listed.join(held, name, "left").withColumn("n_present", F.coalesce("n_present", zero))


def _leaks(spark: SparkSession, folder: str) -> DataFrame:
    table = features.long_table(spark, folder)
    return _counted(prepare.leak_report(table), table, "column")


LEAKS_SQL = over_views(
    features.LONG_VIEWS,
    f"WITH {features.LONG_TABLE} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{p}' AS pattern, count({c}) AS n_present FROM base"
        for c, p in (
            ("sbp_mean", "sbp_mean"), ("dbp_mean", "dbp_mean"), ("map_mean", "map_mean"),
            ("sbp_mean_verify", "verify"), ("sbp_std_verify", "verify"),
        )
    ),
)


def _difference(spark: SparkSession, folder: str) -> DataFrame:
    table = gaps(spark, folder)
    return _counted(prepare.column_difference(table, ["click", "view", "hr_mean"]), table, "feature")


DIFFERENCE_SQL = f"WITH {GAPS} SELECT 'hr_mean' AS feature, 'missing' AS status, 0 AS n_present UNION ALL " + " UNION ALL ".join(
    f"SELECT '{c}', 'extra', count({c}) FROM gaps" for c in ("key", "user_id", "purchase", "signup", "error", "n")
)


def _catalogue(spark: SparkSession, folder: str) -> DataFrame:
    table = features.long_table(spark, folder).drop("gender", "ethnicity", "language")
    return _counted(report.feature_catalogue(table).drop("description"), table, "feature")


NOT_IN_TABLE = {
    "gender", "ethnicity", "language", "dbp_mean_verify", "dbp_std_verify", "age_creatinine_product",
    "vasopressor_lactate_interaction", "bun_creatinine_ratio", "perfusion_index", "lactate_mean_squared", "lactate_mean_sqrt",
}
CATALOGUE_SQL = over_views(
    features.LONG_VIEWS,
    f"WITH {features.LONG_TABLE} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS category, '{f}' AS feature, {str(f not in NOT_IN_TABLE).lower()} AS present,"
        f" {0 if f in NOT_IN_TABLE else f'(SELECT count({f}) FROM base)'} AS n_present"
        for c, (_, fs) in report.FEATURE_CATALOGUE.items()
        for f in fs
    ),
)


def _sensitivity(spark: SparkSession, folder: str) -> DataFrame:
    g = gaps(spark, folder)
    first = missing.fill_simple(g, KINDS, [])
    second = missing.fill_clinical(g, KINDS, {"click": 80.0, "view": 18.0})
    return tidy(missing.imputation_sensitivity(g, first, second, KINDS[:4], ("median", "clinical")))


def _sens_sql() -> str:
    parts = []
    for c in KINDS[:4]:
        m = f"(SELECT median({c}) FROM gaps)"
        s = {"click": "80.0", "view": "18.0"}.get(c, m)
        a, b = f"CAST(coalesce({c}, {m}) AS DOUBLE)", f"CAST(coalesce({c}, {s}) AS DOUBLE)"
        gap = f"abs(avg({a}) - avg({b})) * 100 / avg({c})"
        parts.append(
            f"SELECT '{c}' AS variable, {r4(f'avg({c})')} AS original_mean, {r4(f'stddev_samp({c})')} AS original_std,"
            f" {r4(f'avg({a})')} AS median_mean, {r4(f'stddev_samp({a})')} AS median_std, {r4(f'avg({b})')} AS clinical_mean,"
            f" {r4(f'stddev_samp({b})')} AS clinical_std, {r4(gap)} AS difference_percent, {gap} > 10 AS large FROM gaps"
        )
    return f"WITH {GAPS} " + " UNION ALL ".join(parts)


FOLD_SQL = """WITH RECURSIVE g AS (
  SELECT user_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, user_id) AS rn FROM events GROUP BY user_id),
r AS (
  SELECT CAST(0 AS BIGINT) AS rn, CAST([0, 0, 0, 0, 0] AS BIGINT[]) AS loads, CAST(-1 AS INT) AS fold, CAST(0 AS BIGINT) AS n
  UNION ALL
  SELECT g.rn, [""" + ", ".join(
    f"loads[{i}] + CASE WHEN list_position(loads, list_min(loads)) = {i} THEN g.n ELSE 0 END" for i in range(1, 6)
) + """], CAST(list_position(loads, list_min(loads)) - 1 AS INT), g.n FROM r JOIN g ON g.rn = r.rn + 1)
SELECT fold, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows FROM r WHERE rn > 0 GROUP BY fold"""


def _folds(spark: SparkSession, folder: str) -> DataFrame:
    return fold_balance(group_folds(read(spark, folder, "events"), "user_id"), "user_id")


def _scaled(spark: SparkSession, folder: str) -> DataFrame:
    g = gaps(spark, folder).select("key", *KINDS)
    return tidy(scaling.robust_scaled(g, scaling.robust_facts(g, KINDS)))


SCALED_SQL = f"WITH {GAPS} SELECT key, " + ", ".join(
    r4(f"({c} - (SELECT median({c}) FROM gaps)) / (SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM gaps)") + f" AS {c}" for c in KINDS
) + " FROM gaps"
POWERS = {"click": 0.25, "view": 0.0, "purchase": 2.0}


def _bent(spark: SparkSession, folder: str) -> DataFrame:
    g = gaps(spark, folder)
    return tidy(g.select("key", *[F.expr(scaling.yeo_johnson_sql(f"({c} - 30)", p)).alias(c) for c, p in POWERS.items()]))


def _bent_sql() -> str:
    cols = []
    for c, p in POWERS.items():
        x = f"({c} - 30)"
        up = f"ln(1 + {x})" if p == 0 else f"(pow({x} + 1, {p}) - 1) / {p}"
        down = f"-ln(1 - {x})" if p == 2 else f"-(pow(1 - {x}, {2 - p}) - 1) / {2 - p}"
        guarded = f"CASE WHEN {c} >= 30 THEN {up.replace(x, f'greatest({x}, 0)')} WHEN {c} < 30 THEN {down.replace(x, f'least({x}, 0)')} END"
        cols.append(f"{r4(guarded)} AS {c}")
    return f"WITH {GAPS} SELECT key, {', '.join(cols)} FROM gaps"


def _powers(spark: SparkSession, folder: str) -> DataFrame:
    g = gaps(spark, folder)
    rows = [(c, p) for c, p in scaling.fit_powers(g, KINDS).items()]
    return tidy(spark.createDataFrame(rows, "column STRING, power DOUBLE"))


def _powers_sql() -> str:
    """Likelihoods on a wide grid in steps of 0.05, then the top of the parabola through the best point and its neighbours."""
    up = "CASE WHEN p = 0 THEN ln(1 + greatest(x, 0)) ELSE (pow(greatest(x, 0) + 1, p) - 1) / p END"
    down = "CASE WHEN p = 2 THEN -ln(1 - least(x, 0)) ELSE -(pow(1 - least(x, 0), 2 - p) - 1) / (2 - p) END"
    values = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS x FROM gaps WHERE {c} IS NOT NULL" for c in KINDS)
    return f"""WITH {GAPS}, v AS ({values}), g AS (SELECT k * 5 / 100.0 AS p FROM range(-100, 141) r(k)),
    l AS (SELECT "column", p, -count(*) / 2.0 * ln(var_pop(CASE WHEN x >= 0 THEN {up} ELSE {down} END))
      + (p - 1) * sum(sign(x) * ln(1 + abs(x))) AS score FROM v, g GROUP BY 1, 2),
    n AS (SELECT *, lag(score) OVER w AS a, lead(score) OVER w AS c, row_number() OVER (PARTITION BY "column" ORDER BY score DESC) AS best
      FROM l WINDOW w AS (PARTITION BY "column" ORDER BY p))
    SELECT "column", {r4('p + 0.05 * 0.5 * (a - c) / (a - 2 * score + c)')} AS power FROM n WHERE best = 1"""


def _routed(spark: SparkSession, folder: str) -> DataFrame:
    p = evaluation.predictions(spark, folder)
    ranges = [(0.0, 90.0, "lower"), (90.0, 120.0, "upper"), (140.0, 300.0, "lower")]
    mixed = p.withColumn("mixed", blend("y_pred", "upper"))
    return tidy(mixed.select("key", "mixed", route("mixed", ranges).alias("routed")))


ROUTED_SQL = f"""{evaluation.PREDS}, b AS (SELECT *, 0.4 * y_pred + 0.6 * upper AS mixed FROM preds)
SELECT key, {r4('mixed')} AS mixed, {r4('''CASE WHEN mixed >= 0 AND mixed < 90 THEN 0.3 * mixed + 0.7 * lower
  WHEN mixed >= 90 AND mixed < 120 THEN 0.3 * mixed + 0.7 * upper
  WHEN mixed >= 140 AND mixed < 300 THEN 0.3 * mixed + 0.7 * lower ELSE mixed END''')} AS routed FROM b"""


def _scores(kind: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        m = matrix(spark, folder)
        model = models.fit_regressor(m, MODEL_FEATURES, "sbp_mean", kind=kind)
        return tidy(model.transform(m).select("key", "sbp_mean", "prediction"))

    return run


def _folded(spark: SparkSession, folder: str) -> DataFrame:
    return group_folds(matrix(spark, folder), "group")


def _grid(spark: SparkSession, folder: str) -> DataFrame:
    settings = models.grid(models.BOOSTING_GRID)
    scores = models.cross_validate(_folded(spark, folder), MODEL_FEATURES, "sbp_mean", settings)
    rows = [(*s.values(), v) for s, v in zip(settings, scores, strict=True)]
    return spark.createDataFrame(rows, "trees INT, rate DOUBLE, depth INT, min_rows INT, rows DOUBLE, columns STRING, rmse DOUBLE")


def _random(spark: SparkSession, folder: str) -> DataFrame:
    settings = models.random_settings(models.BOOSTING_RANGES, pipeline.Options().trials)
    scores = models.cross_validate(_folded(spark, folder), MODEL_FEATURES, "sbp_mean", settings)
    return spark.createDataFrame([(i, s["rate"], v) for i, (s, v) in enumerate(zip(settings, scores, strict=True))], "trial INT, rate DOUBLE, rmse DOUBLE")


def _bake(spark: SparkSession, folder: str) -> DataFrame:
    candidates = {kind: (kind, {}) for kind in ("linear", "forest", "boosting")}
    return models.bake_off(_folded(spark, folder), MODEL_FEATURES, "sbp_mean", candidates)[0]


def _quantiles(spark: SparkSession, folder: str) -> DataFrame:
    m = matrix(spark, folder)
    model, _, _ = models.fit_interval(m, MODEL_FEATURES, "sbp_mean")
    return tidy(model.transform(m).select("key", "sbp_mean", "lower", "upper"))


def _stack(spark: SparkSession, folder: str) -> DataFrame:
    m = _folded(spark, folder)
    model = models.search_stack(m, MODEL_FEATURES, "sbp_mean")
    return tidy(model.transform(m).select("key", "sbp_mean", "prediction"))


def _strata(spark: SparkSession, folder: str) -> DataFrame:
    m = matrix(spark, folder)
    base = models.fit_regressor(m, MODEL_FEATURES, "sbp_mean")
    strata = models.fit_strata(m, MODEL_FEATURES, "sbp_mean", group="group")
    return tidy(predict(m, base, strata=strata).select("key", "sbp_mean", "y_pred"))


def _importance(spark: SparkSession, folder: str) -> DataFrame:
    m = matrix(spark, folder)
    a, b = (models.fit_regressor(m, MODEL_FEATURES, t) for t in ("sbp_mean", "dbp_mean"))
    return report.top_features(models.importance_table(a, b, MODEL_FEATURES, spark))


def _important(spark: SparkSession, folder: str) -> DataFrame:
    m = matrix(spark, folder)
    model = models.fit_regressor(m, MODEL_FEATURES, "dbp_mean")
    return tidy(m.select("key", *models.important_features(model, MODEL_FEATURES)))


def _permutation(spark: SparkSession, folder: str) -> DataFrame:
    m = matrix(spark, folder)
    model = models.fit_regressor(m, MODEL_FEATURES, "sbp_mean")
    return models.permutation_importance(m, model, MODEL_FEATURES, "sbp_mean", "key")


def _chained(spark: SparkSession, folder: str) -> DataFrame:
    g = gaps(spark, folder)
    return tidy(fit_chained(g, [*KINDS, "n"]).transform(g))


def _neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(neighbour_fill(gaps(spark, folder), "key", [*KINDS, "n"]))


def _neighbours_sql() -> str:
    """Every row against every donor, column by column."""
    columns = (*KINDS, "n")
    squares = " + ".join(f"coalesce(pow(r.{c} - q.{c}, 2), 0)" for c in columns)
    common = " + ".join(f"CAST(r.{c} - q.{c} IS NOT NULL AS INTEGER)" for c in columns)
    parts = [
        f"""SELECT key, '{c}' AS col, sum(w * v) / sum(w) AS filled FROM (
          SELECT key, v, CASE WHEN min(dist) OVER (PARTITION BY key) = 0 THEN CAST(dist = 0 AS DOUBLE) ELSE 1 / dist END AS w FROM (
            SELECT r.key, q.{c} AS v, sqrt({len(columns)} * ({squares}) / nullif({common}, 0)) AS dist
            FROM gaps r JOIN gaps q ON r.{c} IS NULL AND q.{c} IS NOT NULL
            QUALIFY dist IS NOT NULL AND row_number() OVER (PARTITION BY r.key ORDER BY dist, q.key) <= 5)) GROUP BY key"""
        for c in KINDS
    ]
    filled = ", ".join(
        f"{r4(f'coalesce(g.{c}, (SELECT filled FROM f WHERE f.key = g.key AND col = {chr(39)}{c}{chr(39)}), (SELECT avg({c}) FROM gaps))')} AS {c}" for c in KINDS
    )
    return f"WITH {GAPS}, f AS MATERIALIZED ({' UNION ALL '.join(parts)}) SELECT g.key, g.user_id, {filled}, {r4('g.n')} AS n FROM gaps g"


def _document(spark: SparkSession, folder: str) -> DataFrame:
    p = evaluation.predictions(spark, folder)
    doc = metrics_document("events", "run", evaluate.fold_metrics(p, ["target"]), evaluate.agreement(p), evaluate.fold_metrics(p))
    return doc.select(F.to_json(F.struct("*")).alias("document"))


def _external(spark: SparkSession, folder: str) -> DataFrame:
    """Train on the long-event database, score the wide-vitals one."""
    c = clinical_catalog(spark, folder)
    run = pipeline.train(pipeline.long_features(c))
    return tidy(pipeline.validate_externally(run, pipeline.wide_features(c))["summary"])


CHECKS: dict[str, Check] = {
    "missing_profile": Check(lambda s, f: tidy(missing.missing_profile(gaps(s, f), [*KINDS, "n"])), PROFILE_SQL),
    "column_medians": Check(
        lambda s, f: tidy(missing.column_quantiles(gaps(s, f), KINDS, {"median": 0.5})), MEDIAN_SQL
    ),
    "column_modes": Check(
        lambda s, f: modes(unpivoted(clinical_catalog(s, f)["admissions"], MODE_COLUMNS, "string"), ["column"], "value"), MODE_SQL
    ),
    "median_fill": Check(
        lambda s, f: tidy(missing.fill_simple(_incomplete(s, f), KINDS, [])),
        f"WITH {GAPS}, t AS (SELECT key, {FILLED}, n FROM gaps) SELECT key, {', '.join(f'{r4(c)} AS {c}' for c in (*KINDS, 'n'))} FROM t",
    ),
    "mode_fill": Check(
        lambda s, f: missing.fill_simple(clinical_catalog(s, f)["admissions"].select("hadm_id", "language"), [], ["language"]),
        over_views("admissions", "SELECT hadm_id, coalesce(language, 'ENGL') AS language FROM admissions"),
    ),
    "clinical_default_fill": Check(
        lambda s, f: tidy(
            missing.fill_clinical(_incomplete(s, f).withColumnsRenamed({"click": "hr_mean", "view": "rr_mean"}), ["hr_mean", "rr_mean", "purchase"]).select("key", "hr_mean", "rr_mean", "purchase")
        ),
        f"WITH {GAPS} SELECT key, {r4('coalesce(click, 80.0)')} AS hr_mean, {r4('coalesce(view, 18.0)')} AS rr_mean,"
        f" {r4('coalesce(purchase, (SELECT median(purchase) FROM gaps))')} AS purchase FROM gaps",
    ),
    "imputation_sensitivity": Check(_sensitivity, _sens_sql()),
    "imputation_dispatch": Check(lambda s, f: tidy(missing.impute(gaps(s, f), "key", exclude=["user_id"]))),
    "chained_imputation": Check(_chained),
    "neighbour_imputation": Check(_neighbours, _neighbours_sql()),
    "correlation_pairs": Check(
        lambda s, f: tidy(prepare.pair_correlations(gaps(s, f), KINDS)), f"WITH {GAPS} {_corr_sql('gaps')}"
    ),
    "correlation_matrix": Check(
        lambda s, f: tidy(
            correlate.correlation_matrix(gaps(s, f), KINDS).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "corr")
        ),
        f"WITH {GAPS} SELECT least(a, b) AS a, greatest(a, b) AS b, corr FROM ({_corr_sql('gaps')})",
    ),
    "missingness_correlation": Check(
        lambda s, f: tidy(correlate.missingness_correlation(gaps(s, f), KINDS).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "corr")),
        f"WITH {GAPS}, {MISS} SELECT least(a, b) AS a, greatest(a, b) AS b, corr FROM ({_corr_sql('m')})",
    ),
    "variance_threshold": Check(
        lambda s, f: tidy(prepare.variance_table(gaps(s, f).withColumn("flat", F.lit(1.0)), [*KINDS, "n", "flat"])),
        f"WITH {GAPS}, t AS (SELECT *, 1.0 AS flat FROM gaps) "
        + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {r4(f'var_pop({c})')} AS variance, var_pop({c}) > 0.00001 AS kept FROM t" for c in (*KINDS, "n", "flat")),
    ),
    "collinear_columns": Check(
        lambda s, f: s.createDataFrame(
            [(c,) for c in prepare.collinear_columns(gaps(s, f).withColumn("twice", F.col("click") * 2 + 1), [*KINDS, "twice"])], "column STRING"
        ),
        f"WITH {GAPS}, t AS (SELECT *, click * 2 + 1 AS twice FROM gaps) SELECT DISTINCT b AS \"column\" FROM ("
        + " UNION ALL ".join(f"SELECT '{b}' AS b, {clinical._corr(a, b)} AS c FROM t" for a, b in combinations([*KINDS, "twice"], 2))
        + ") WHERE abs(c) > 0.95",
    ),
    "category_codes": Check(
        _codes,
        over_views(
            "admissions",
            "WITH l AS (SELECT ethnicity AS level, dense_rank() OVER (ORDER BY ethnicity) - 1 AS code FROM (SELECT DISTINCT ethnicity FROM admissions WHERE ethnicity IS NOT NULL))"
            " SELECT hadm_id, language, coalesce(code, -1) AS ethnicity FROM admissions LEFT JOIN l ON ethnicity = level",
        ),
    ),
    "feature_alignment": Check(
        _align, f"WITH {GAPS} SELECT key, {r4('n')} AS n, CAST(2015 AS DOUBLE) AS admit_year, {r4('click')} AS click, CAST(0.5 AS DOUBLE) AS gender_male, CAST(0 AS DOUBLE) AS troponin_mean FROM gaps"
    ),
    "feature_difference": Check(_difference, DIFFERENCE_SQL),
    "model_columns_without_leaks": Check(
        _dropped,
        over_views(
            features.LONG_VIEWS,
            f"WITH {features.LONG_TABLE} SELECT * EXCLUDE (icustay_id, subject_id, hadm_id, gender, sbp_mean, dbp_mean, sbp_count, sbp_min, sbp_max, dbp_count, map_mean,"
            " sbp_mean_verify, sbp_std_verify, hr_sbp_corr, rr_sbp_corr, spo2_sbp_corr, sbp_std, dbp_std, sbp_lability_events) FROM base",
        ),
    ),
    "leak_names": Check(_leaks, LEAKS_SQL),
    "leak_audit": Check(
        lambda s, f: tidy(prepare.leak_audit(gaps(s, f).withColumn("y", F.col("click") * 3 - 2), ["click", "view", "n"], ["y"])),
        f"WITH {GAPS}, t AS (SELECT *, click * 3 - 2 AS y FROM gaps) "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, 'y' AS target, {r4(clinical._corr(c, 'y'))} AS corr, coalesce(abs({clinical._corr(c, 'y')}) > 0.95, false) AS suspect FROM t"
            for c in ("click", "view", "n")
        ),
    ),
    "feature_catalogue": Check(_catalogue, CATALOGUE_SQL),
    "group_folds": Check(_folds, FOLD_SQL),
    "robust_scaling": Check(_scaled, SCALED_SQL),
    "power_transform": Check(_bent, _bent_sql()),
    "power_fit": Check(_powers, _powers_sql()),
    "blend_and_route": Check(_routed, ROUTED_SQL),
    "seeded_sample": Check(
        lambda s, f: tidy(models.seeded_sample(gaps(s, f), "key")),
        f"WITH {GAPS} SELECT key, user_id, {', '.join(f'{r4(c)} AS {c}' for c in (*KINDS, 'n'))} FROM gaps ORDER BY md5('42:' || CAST(key AS VARCHAR)), key LIMIT 500",
    ),
    "boosting_model": Check(_scores("boosting")),
    "forest_model": Check(_scores("forest")),
    "grid_search": Check(_grid),
    "random_search": Check(_random),
    "model_bake_off": Check(_bake),
    "quantile_intervals": Check(_quantiles),
    "stacked_model": Check(_stack),
    "stratum_models": Check(_strata),
    "feature_importance": Check(_importance),
    "permutation_importance": Check(_permutation),
    "important_features": Check(_important),
    "metrics_document": Check(_document),
    "train_and_validate_externally": Check(_external),
}
