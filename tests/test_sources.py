"""Catalog, sinks and the registered queries."""

import json

import duckdb
import pytest

import __spark_entry__
from compare import TABLES, close, normal
from icufeat.operators import evaluate, report
from icufeat.sources import sinks
from icufeat.sources.catalog import LONG_SCHEMAS, Catalog
from icufeat.sources.profile import top_values

FOLDER = "/root/testdata/sf0.001"
SOME = (
    "user_event_features cohort_long cohort_wide pressure_and_vitals_fused labs_wide temporal_long_paired vitals_wide_band"
    " band_join_totals derived_features_wide error_metrics stratified_report group_folds correlation_matrix median_fill"
).split()


def test_catalog_reads_declared_columns(spark, tmp_path):
    rows = spark.createDataFrame([(1, "5", 7)], "itemid INT, label STRING, extra INT")
    rows.write.parquet(str(tmp_path / "items.parquet"))
    c = Catalog(spark, root=str(tmp_path), locations={"d_items": "items.parquet"})
    assert c["d_items"].columns == ["itemid", "label"]
    rows.createOrReplaceTempView("labelled")
    assert Catalog(spark, locations={"d_items": "labelled"})["d_items"].count() == 1
    assert set(LONG_SCHEMAS) >= {"patients", "chartevents"}


def test_top_values_break_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",)], "v STRING")
    assert [r["v"] for r in top_values(df, "v", 2).collect()] == ["a", "b"]


def test_sinks(spark, tmp_path):
    preds = spark.createDataFrame(
        [(i, t, i // 2 % 2, 100.0 + i, 101.0 + i % 3, 90.0, 120.0) for i, t in enumerate(["SBP", "DBP"] * 6)],
        "key BIGINT, target STRING, fold INT, y_true DOUBLE, y_pred DOUBLE, lower DOUBLE, upper DOUBLE",
    )
    place = sinks.write_table(preds, str(tmp_path), "predictions", "set", "r1")
    assert spark.read.option("header", True).csv(place).count() == 12
    assert spark.read.option("header", True).csv(str(tmp_path / "predictions")).first()["run_id"] == "r1"
    doc = sinks.metrics_document("set", "r1", evaluate.fold_metrics(preds, ["target"]), evaluate.agreement(preds), evaluate.fold_metrics(preds))
    text = spark.read.text(sinks.write_document(doc, str(tmp_path), "set", "r1")).first()[0]
    found = json.loads(text)
    assert found["dataset"] == "set" and set(found["metrics"]) == {"SBP", "DBP"}
    assert len(found["hypothesis_tests"]["SBP"]["limits_of_agreement"]) == 2 and len(found["fold_metrics"]["DBP"]) == 2


def test_catalogue_marks_presence(spark):
    out = {r["feature"]: r["present"] for r in report.feature_catalogue(spark.createDataFrame([(1.0,)], "hr_mean DOUBLE")).collect()}
    assert out["hr_mean"] and not out["hr_trend"]


def test_every_query_has_a_name_of_its_own():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SOME)
def test_registered_query_equals_sql(spark, duck, name):
    got = __spark_entry__.queries()[name](spark, FOLDER).toPandas().astype(object)
    cursor = duck.execute(__spark_entry__.oracle_sql()[name])
    import pandas as pd

    want = pd.DataFrame(cursor.fetchall(), columns=[d[0] for d in cursor.description], dtype=object)
    assert sorted(got.columns) == sorted(want.columns)
    assert close(normal(got), normal(want))
