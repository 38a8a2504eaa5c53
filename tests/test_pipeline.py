"""End-to-end: stream = batch, save/load, entry contract and a DuckDB oracle subset."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from txrisk.operators import features as fo
from txrisk.operators import modeling
from txrisk.plans import training
from txrisk.plans.feature_plan import build_features
from txrisk.sources import params as params_io
from txrisk.sources.transactions import tpch_transactions
from txrisk.streaming.scoring import score_stream, scoring_frame


@pytest.fixture(scope="module")
def fitted(spark):
    ledger = tpch_transactions(spark, SF_SMALL)
    bounds = fo.fit_outlier_bounds(spark, ledger)
    cfg = training.RunConfig(params={"hidden_layers": [16], "epochs": 5})
    prep = training.prepare(spark, build_features(spark, ledger, bounds=bounds), cfg)
    rows, _ = training.rebalance(prep, cfg)
    model = training.fit(prep, cfg, rows)
    return ledger, bounds, prep, model


def test_stream_equals_batch(spark, fitted, tmp_shared):
    ledger, bounds, prep, model = fitted
    src, sink, ckpt = tmp_shared("src"), tmp_shared("sink"), tmp_shared("ckpt")
    ledger.repartition(3).write.parquet(src)
    q = score_stream(spark, src, sink, ckpt, bounds, prep.pre, model, max_files_per_trigger=1)
    q.awaitTermination()
    streamed = spark.read.parquet(sink).toPandas().sort_values("tx_id").reset_index(drop=True)
    batch = scoring_frame(spark, ledger, bounds, prep.pre, model).toPandas().sort_values("tx_id").reset_index(drop=True)
    assert len(streamed) == ledger.count()
    pd.testing.assert_frame_equal(streamed[batch.columns], batch, check_dtype=False)


def test_save_load_same_scores(spark, fitted, tmp_shared):
    _, bounds, prep, model = fitted
    path = tmp_shared("artifacts")
    params_io.save_params(path, {"bounds": bounds, "categories": prep.pre.categories, "stats": prep.pre.stats},
                          config={"scaler": "standard"}, model=model)
    tables, cfg = params_io.load_params(spark, path, config=True)
    loaded = params_io.load_model(path)
    assert cfg == {"scaler": "standard"} and set(tables) == {"bounds", "categories", "stats"}
    a = modeling.scored_table(model, prep.test).orderBy("id").toPandas()
    b = modeling.scored_table(loaded, prep.test).orderBy("id").toPandas()
    pd.testing.assert_frame_equal(a, b)
    hist = modeling.training_history(model).toPandas()
    assert len(hist) >= 2 and hist.loss.iloc[-1] <= hist.loss.iloc[0]


def test_entry_contract(spark):
    import __spark_entry__ as E

    out = E.entry(spark)
    assert set(out.columns) == {"type", "fraud_rate", "n"} and out.count() == 5
    assert set(E.oracle_sql()) <= set(E.queries())


ORACLE_SUBSET = [
    "feature_table", "describe", "quantiles", "histogram_by_class", "stratified_split", "stratified_kfold",
    "correlation_matrix", "target_correlation", "threshold_sweep", "roc_curve", "pr_curve", "evaluate",
    "preprocess", "robust_scale", "minority_knn", "smote", "dataset_fingerprint", "score_udf",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("orders", "customer", "lineitem", "supplier", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ORACLE_SUBSET)
def test_oracle(spark, duck, name):
    import __spark_entry__ as E
    from tools.oracle_check import digest

    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(c.lower() for c in sdf.columns) == sorted(c.lower() for c in dcols)
    assert len(srows) == len(drows)
    assert digest(srows, sdf.columns)[0] == digest(drows, dcols)[0]
