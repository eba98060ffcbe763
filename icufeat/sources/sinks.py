"""Where results go: tables by dataset and run, and one JSON document of all metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, root: str, name: str, dataset: str, run_id: str, format: str = "csv") -> str:
    """Write under root/name/dataset=…/run_id=…, so that all runs read back as one table."""
    place = f"{root}/{name}/dataset={dataset}/run_id={run_id}"
    writer = df.write.mode("overwrite").format(format)
    if format == "csv":
        writer = writer.option("header", True)
    writer.save(place)
    return place


def _nested(df: DataFrame, drop: tuple[str, ...], renamed: dict[str, Column] | None = None) -> Column:
    fields = [F.col(c) for c in df.columns if c not in drop]
    return F.struct(*fields, *[e.alias(n) for n, e in (renamed or {}).items()])


def metrics_document(
    dataset: str, run_id: str, metrics: DataFrame, agreement: DataFrame, folds: DataFrame | None = None
) -> DataFrame:
    """One row: dataset, run and, per target, metrics, hypothesis tests and fold metrics."""

    def by_target(df: DataFrame, name: str, value: Column) -> DataFrame:
        return df.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("target", value.alias("v")))).alias(name))

    limits = {"limits_of_agreement": F.array("limit_low", "limit_high")}
    out = by_target(metrics, "metrics", _nested(metrics, ("target",)))
    tests = by_target(agreement, "hypothesis_tests", _nested(agreement, ("target", "limit_low", "limit_high"), limits))
    out = out.join(tests)
    if folds is not None:
        per_target = folds.groupBy("target").agg(
            F.sort_array(F.collect_list(F.struct("fold", *[c for c in folds.columns if c not in ("target", "fold")]))).alias("rows")
        )
        out = out.join(by_target(per_target, "fold_metrics", F.col("rows")))
    return out.select(F.lit(dataset).alias("dataset"), F.lit(run_id).alias("timestamp"), *out.columns)


def write_document(document: DataFrame, root: str, dataset: str, run_id: str) -> str:
    place = f"{root}/evaluation/dataset={dataset}/run_id={run_id}"
    document.coalesce(1).write.mode("overwrite").json(place)
    return place
