"""What training and scoring cost as rows grow: stored hashes, one shard in memory, chunks at scoring, one feature table."""

import tracemalloc
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from txrisk.operators import network, preprocess, sampling
from txrisk.operators.network import DenseNetwork, Layout, NetworkConfig
from txrisk.plans import feature_plan, registry, training


def test_split_over_written_rows_compares_a_stored_hash(spark):
    rows = spark.range(3000).select(F.col("id").alias("tx_id"), (F.col("id") % 7 == 0).cast("int").alias("isFraud"))
    written = sampling.stratified_split(rows, write="test-split")
    assert written.columns == ["tx_id", "isFraud", "split"]
    want = {r["tx_id"]: r["split"] for r in sampling.stratified_split(rows).collect()}
    assert {r["tx_id"]: r["split"] for r in written.collect()} == want
    # Every pass over a part of it reads the hash.
    plan = written.where(F.col("split") == "train")._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan and "conv(" not in plan


def test_scoring_memory_does_not_grow_with_the_rows():
    layout = Layout([10, 128, 16])
    theta, stats = layout.start(3)
    theta += 0.05 * np.random.default_rng(1).standard_normal(len(theta))
    x = np.random.default_rng(0).standard_normal((40_000, 10)).astype("f4")
    tracemalloc.start()
    got = network.logits(layout, theta, stats, x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20  # all rows at once: over 40 MB a layer
    h = x.astype(float)
    layers = layout.arrays(theta)
    for (w, b, gamma, beta), (mean, variance) in zip(layers[:-1], layout.running(stats)):
        h = (np.maximum(h @ w + b, 0.0) - mean) / np.sqrt(variance + network.BN_EPSILON) * gamma + beta
    assert np.abs(got - (h @ layers[-1][0] + layers[-1][1])[:, 0]).max() < 1e-9
    assert len(network.logits(layout, theta, stats, x[:0])) == 0


def test_a_task_gets_one_shard_at_a_time(spark):
    rows = spark.range(2000).select(F.col("id").alias("tx_id"), (F.col("id") / 2000).alias("a"), (F.col("id") % 2).cast("int").alias("isFraud"))
    blocks = network.shard_matrices(rows, ["a"], shard_rows=100)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    seen = [r["n"] for r in blocks.coalesce(1).mapInArrow(sizes, "n long").collect()]
    assert seen == [1] * 20
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != "1"  # the caller's session is as before


def test_every_shard_is_a_task_of_its_own(spark):
    """However the keys hash, no task of a pass has two shards while another has none."""
    rows = spark.range(3000).select(F.col("id").alias("tx_id"), (F.col("id") / 3000).alias("a"), (F.col("id") % 2).cast("int").alias("isFraud"))
    blocks = network.shard_matrices(rows, ["a"], shard_rows=100)
    per_task = [r["count"] for r in blocks.groupBy(F.spark_partition_id()).count().collect()]
    assert per_task == [1] * 30 and blocks.rdd.getNumPartitions() == 30
    assert spark.conf.get("spark.sql.files.openCostInBytes") != str(network.FILE_BYTES)


def test_scoring_queries_read_the_run_s_features(spark, monkeypatch):
    """The ledger is not joined, bounded and cleaned a second time for the rows that are scored."""
    rows = spark.range(50).select(
        F.col("id").alias("tx_id"), F.col("id").cast("double").alias("a"), (F.col("id") % 5 == 0).cast("int").alias("isFraud"),
        F.when(F.col("id") < 40, "train").otherwise("test").alias("split"),
    )
    pre = preprocess.fit_preprocessor(rows.where("split = 'train'").drop("split"))
    cfg = NetworkConfig.of({"hidden_layers": [4]})
    model = DenseNetwork(["a"], cfg, *Layout([1, 4]).start(0))
    prep = training.Prepared(pre, ["a"], rows, rows, rows, rows)

    def features(*_):
        raise AssertionError("features were built again")

    monkeypatch.setattr(registry, "_features", features)
    monkeypatch.setattr(registry, "_fitted", lambda *_: (model, prep, training.RunConfig()))
    assert registry.q_score_batch(spark, "unused").count() == 50
    assert registry.q_score_batch_consistency(spark, "unused").first()["n_keys"] == 50
    assert registry.q_score_udf_consistency(spark, "unused").first()["differences"] == 0


def test_the_written_ledger_has_no_account_names(spark, monkeypatch):
    from txrisk.schema import TRANSACTION_SCHEMA

    row = (1, 5, "A", 10.0, "C1", 20.0, 10.0, "M1", 0.0, 10.0, 0)
    ledger = spark.createDataFrame([row], TRANSACTION_SCHEMA) if len(TRANSACTION_SCHEMA) == len(row) else None
    assert ledger is not None
    kept = []
    monkeypatch.setattr(feature_plan, "tpch_transactions", lambda *_: ledger)
    monkeypatch.setattr(feature_plan, "materialize", lambda df, name: kept.append(df.columns) or df)
    assert feature_plan.tpch_feature_table(spark, "unused").count() == 1
    assert "amount" in kept[0] and not {"nameOrig", "nameDest"} & set(kept[0])


def _full_fit(spark, monkeypatch, query):
    """(result, epochs and rows of every fit) of a query over a tiny run without SMOTE; a fit is cut to one epoch here."""
    rows = spark.range(60).select(
        F.col("id").alias("tx_id"), F.col("id").cast("double").alias("a"), (F.col("id") % 5 == 0).cast("int").alias("isFraud"),
        F.when(F.col("id") < 30, "train").when(F.col("id") < 40, "val").otherwise("test").alias("split"),
    )
    pre = preprocess.fit_preprocessor(rows.where("split = 'train'").drop("split"))
    parts = [preprocess.transform(pre, rows.where(F.col("split") == p)) for p in ("train", "val", "test")]
    prep, seen, fit = training.Prepared(pre, ["a"], *parts, rows), [], network.fit_blocks

    def one_epoch(blocks, n_shards, cols, cfg, val_blocks=None, *more, **options):
        seen.append((cfg.epochs, val_blocks is None, sum(len(r["y"]) // 4 for r in blocks.collect())))
        return fit(blocks, n_shards, cols, replace(cfg, epochs=1), val_blocks, *more, **options)

    monkeypatch.setattr(registry, "_prepared", lambda spark, sf_dir, cfg=None: (prep, cfg or training.RunConfig()))
    monkeypatch.setattr(training, "rebalance", lambda prep, cfg: (prep.train, None))
    monkeypatch.setattr(network, "fit_blocks", one_epoch)
    return query(spark, "unused"), seen


def test_fit_classifier_trains_all_epochs(spark, monkeypatch):
    out, seen = _full_fit(spark, monkeypatch, registry.q_fit_classifier)
    assert seen == [(50, True, 30)] and out.count() == 20


def test_refit_trains_all_epochs_on_train_and_val(spark, monkeypatch):
    out, seen = _full_fit(spark, monkeypatch, registry.q_refit_on_train_val)
    assert seen == [(50, True, 40)] and out.count() == 20
