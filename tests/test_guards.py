"""Run-time guards of the reference, re-expressed as errors raised by the operators."""

import pytest
from pyspark.sql import functions as F

from txrisk.operators import evaluation as ev
from txrisk.operators import imbalance, modeling
from txrisk.sources import params as params_io
from txrisk.sources.transactions import extract_target, load_transactions


def test_unsupported_suffix(spark):
    with pytest.raises(ValueError, match="read from .parquet or .csv"):
        load_transactions(spark, "/tmp/ledger.json")


def test_missing_target(spark):
    df = spark.createDataFrame([(1, 2.0)], "tx_id long, amount double")
    with pytest.raises(ValueError, match="no label column 'isFraud'"):
        extract_target(df)


def test_one_class_confusion(spark):
    s = spark.createDataFrame([(1, 0, 0.1), (2, 0, 0.2)], "id long, y_true int, score double")
    with pytest.raises(ValueError, match="no 2 x 2 confusion matrix"):
        ev.confusion_matrix(s, 0.5)


def test_unknown_metric(spark):
    s = spark.createDataFrame([(1, 0, 0.1), (2, 1, 0.9)], "id long, y_true int, score double")
    with pytest.raises(ValueError, match="no threshold can be chosen"):
        ev.optimal_threshold(s, "accuracy")


def test_smote_small_minority(spark):
    rows = [(i, float(i), 1 if i < 5 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "tx_id long, x double, isFraud int")
    with pytest.raises(ValueError, match="5 neighbours need more"):
        imbalance.smote(df, "tx_id", ["x"], ratio=0.3)


def test_smote_negative_count(spark):
    rows = [(i, float(i), 1 if i < 50 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "tx_id long, x double, isFraud int")
    with pytest.raises(ValueError, match="below the one there is"):
        imbalance.smote(df, "tx_id", ["x"], ratio=0.3)


def test_smote_with_weights(spark):
    from txrisk.plans.training import RunConfig, prepare

    with pytest.raises(ValueError, match="SMOTE and class weights"):
        prepare(spark, None, RunConfig(use_smote=True, use_class_weights=True))


def test_mlp_unsupported_options(spark):
    df = spark.createDataFrame([(1, 0.0, 0), (2, 1.0, 1)], "tx_id long, x double, isFraud int")
    with pytest.raises(ValueError, match="not supported"):
        modeling.fit_classifier(df, ["x"], "mlp", {"dropout_rate": 0.3})
    with pytest.raises(ValueError, match="no row weights"):
        modeling.fit_classifier(df.withColumn("weight", F.lit(1.0)), ["x"], "mlp", {}, weight_col="weight")


def test_missing_artifacts_listed_together(spark, tmp_shared):
    path = tmp_shared("missing")
    with pytest.raises(FileNotFoundError) as e:
        params_io.load_params(spark, path, ("bounds", "stats"), config=True)
    assert "bounds" in str(e.value) and "stats" in str(e.value) and "config" in str(e.value)
