"""Loader by header names, caps and odd keys, missing scores, jobs before the action, a saved run."""

import pytest
from pyspark.sql import functions as F

from txrisk.operators import evaluation, preprocess, sampling
from txrisk.plans import registry, training
from txrisk.sources import transactions
from txrisk.sources.params import load_all

from .conftest import SF_SMALL

HEADER = "step,type,amount,nameOrig,oldbalanceOrg,newbalanceOrig,nameDest,oldbalanceDest,newbalanceDest,isFraud"


def test_csv_columns_by_name_without_key(spark, tmp_path):
    rows = ["1,PAYMENT,9839.64,C1,170136.0,160296.36,M1,0.0,0.0,0", "1,NA,9839.64,C1,,160296.36,M1,0.0,0.0,1", "1,PAYMENT,9839.64,C1,170136.0,160296.36,M1,0.0,0.0,0"]
    (tmp_path / "l.csv").write_text("\n".join([HEADER, *rows]))
    df = transactions.load_transactions(spark, str(tmp_path / "l.csv"))
    got = df.orderBy("isFraud").collect()
    assert [(r["step"], r["type"], r["amount"], r["nameOrig"], r["oldbalanceOrg"], r["isFraud"]) for r in got] == [
        (1, "PAYMENT", 9839.64, "C1", 170136.0, 0), (1, "PAYMENT", 9839.64, "C1", 170136.0, 0), (1, None, 9839.64, "C1", None, 1)]
    assert len({r["tx_id"] for r in got}) == 3
    again = transactions.load_transactions(spark, str(tmp_path / "l.csv")).repartition(3)
    assert sorted(r["tx_id"] for r in again.collect()) == sorted(r["tx_id"] for r in got)
    (tmp_path / "m.csv").write_text("amount,extra,step,tx_id\n2.5,hello,7,42\n")
    r = transactions.load_transactions(spark, str(tmp_path / "m.csv")).first()
    assert (r["amount"], r["extra"], r["step"], r["tx_id"]) == (2.5, "hello", 7, 42)


def test_parquet_texts_are_kept(spark, tmp_path):
    spark.createDataFrame([(1, "NA"), (2, "None")], "tx_id long, type string").write.parquet(str(tmp_path / "p.parquet"))
    assert sorted(r["type"] for r in transactions.load_transactions(spark, str(tmp_path / "p.parquet")).collect()) == ["NA", "None"]


def test_repeated_and_null_keys_and_labels_are_errors(spark):
    same = spark.range(21_000).select(F.lit(5).alias("tx_id"), (F.col("id") % 7 == 0).cast("int").alias("isFraud"))
    with pytest.raises(ValueError, match="unique"):
        sampling.sample_n(same, 10).count()
    null_keys = spark.range(100).select(F.lit(None).cast("long").alias("tx_id"), (F.col("id") % 7 == 0).cast("int").alias("isFraud"))
    with pytest.raises(ValueError, match="NULL"):
        sampling.sample_n(null_keys, 10).count()
    null_label = spark.range(100).select(F.col("id").alias("tx_id"), F.when(F.col("id") > 3, 1).alias("isFraud"))
    with pytest.raises(ValueError, match="NULL"):
        sampling.stratified_split(null_label)


def test_five_thousand_categories(spark):
    df = spark.range(10_000).select(F.col("id").alias("tx_id"), F.format_string("c%05d", F.col("id") % 5000).alias("type"))
    cats = preprocess.fit_categories(df, ["type"])
    pre = preprocess.Preprocessor(["type"], [], "standard", cats, spark.createDataFrame([], preprocess.STATS_SCHEMA))
    hot = preprocess.one_hot_sparse(pre, df.unionByName(spark.createDataFrame([(-1, None), (-2, "?")], "tx_id long, type string")))
    got = {r["tx_id"]: (r["hot_size"], list(r["hot_indices"])) for r in hot.collect()}
    assert got[0] == (4999, []) and got[5000] == (4999, []) and got[1] == (4999, [0]) and got[9999] == (4999, [4998])
    assert got[-1] == got[-2] == (4999, []) and len(got) == 10_002


def test_missing_scores_are_no_positives(spark):
    rows = [(1, 0.9), (0, 0.2), (1, float("nan")), (0, float("nan")), (1, None), (0, 0.95)]
    scored = spark.createDataFrame(rows, "y_true int, score double")
    m = evaluation.confusion_matrix(scored).first()
    assert (m["tn"], m["fp"], m["fn"], m["tp"]) == (2, 1, 2, 1)
    sweep = evaluation.threshold_sweep(scored).collect()
    assert len(sweep) == 85 and all(r["tp"] + r["fn"] == 3 for r in sweep)
    assert 0 <= evaluation.auc_roc(scored) <= 1 and 0 <= evaluation.average_precision(scored) <= 1


@pytest.mark.parametrize("name", ["dtype_counts", "fraud_rate_by_type", "fraud_rate_by_hour", "type_distribution", "class_balance", "dataset_statistics"])
def test_profiles_start_no_job_before_the_action(spark, name):
    tracker = spark.sparkContext.statusTracker()
    group = f"plan-{name}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        registry._profile_features(spark, SF_SMALL)
        registry._profile_features(spark, SF_SMALL)  # footers of the tables are read by now
        before = len(tracker.getJobIdsForGroup(group))
        registry.QUERIES[name](spark, SF_SMALL)
        # Reading the four tables' footers is Spark's own; no aggregate runs.
        assert len(tracker.getJobIdsForGroup(group)) - before <= 4
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_saved_run_scores_a_raw_ledger_alike(spark, tmp_path):
    ledger = registry._tx(spark, "/root/testdata/sf0.01")
    cfg = training.RunConfig(algo="logreg", use_smote=False, use_class_weights=True)
    model, _, prep = training.run(spark, ledger, cfg, out_path=str(tmp_path / "run"))
    from txrisk.operators import modeling

    want = {r["tx_id"]: round(r["probability"], 9) for r in modeling.score_batch(model, prep.test, cfg.threshold).collect()}
    got = {r["tx_id"]: round(r["probability"], 9) for r in training.score_ledger(spark, ledger, str(tmp_path / "run")).collect()}
    assert len(got) == ledger.count() and {k: got[k] for k in want} == want
    with pytest.raises(FileNotFoundError, match="bounds.*model"):
        load_all(spark, str(tmp_path / "nothing"))
