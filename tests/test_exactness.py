"""Distributed building blocks against plain single-machine answers."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txrisk.operators import correlation, imbalance, knn, sampling
from txrisk.operators import evaluation as ev
from txrisk.operators.quantiles import exact_quantiles
from txrisk.operators.selection import rank_cutoffs


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=3000), np.zeros(2000), rng.integers(0, 5, 1000).astype(float)])
    y = rng.exponential(size=len(x))
    y[::7] = np.nan
    pdf = pd.DataFrame({"x": x, "y": y})
    df = spark.createDataFrame(pdf).select(F.col("x"), F.nanvl("y", F.lit(None)).alias("y")).repartition(7)
    probs = [0.0, 0.005, 0.25, 0.5, 0.75, 0.995, 1.0]
    got = exact_quantiles(df, ["x", "y"], probs)
    for p in probs:
        assert got[("x", p)] == pytest.approx(np.percentile(x, 100 * p), rel=1e-12, abs=1e-12)
        assert got[("y", p)] == pytest.approx(np.nanpercentile(y, 100 * p), rel=1e-12, abs=1e-12)


def test_rank_cutoffs_match_sort(spark):
    rng = np.random.default_rng(2)
    n = 5000
    pdf = pd.DataFrame({"h": rng.integers(0, 1 << 60, n), "k": np.arange(n), "g": rng.integers(0, 2, n)})
    pdf.loc[:50, "h"] = pdf.loc[0, "h"]  # ties in h, broken by k
    df = spark.createDataFrame(pdf)
    targets = [(0, 0), (0, 100), (1, 7), (1, int((pdf.g == 1).sum()) - 1)]
    got = rank_cutoffs(df, "h", "k", "g", targets)
    for g, k in targets:
        part = pdf[pdf.g == g].sort_values(["h", "k"])
        assert got[(g, k)] == (int(part.iloc[k]["h"]), int(part.iloc[k]["k"]))


def _ledger(spark, n=3000, frac=0.05):
    rng = np.random.default_rng(3)
    return spark.createDataFrame(
        pd.DataFrame({"tx_id": np.arange(n) * 11 + 5, "isFraud": (rng.random(n) < frac).astype("int32")})
    )


def test_split_sizes_and_partition_independence(spark):
    base = _ledger(spark)
    counts = {r["isFraud"]: r["count"] for r in base.groupBy("isFraud").count().collect()}
    results = []
    for parts in (1, 4, 64):
        df = base.repartition(parts).orderBy(F.rand(parts))
        out = sampling.stratified_split(df, 0.2, 0.15, seed=42)
        results.append(sorted((r["tx_id"], r["split"]) for r in out.collect()))
    assert results[0] == results[1] == results[2]
    split = pd.DataFrame(results[0], columns=["tx_id", "split"])
    n = sum(counts.values())
    assert (split.split == "test").sum() == int(np.ceil(0.2 * n))
    rest = n - int(np.ceil(0.2 * n))
    assert (split.split == "val").sum() == int(np.ceil(0.15 / 0.8 * rest))


def test_kfold_and_subsample(spark):
    df = _ledger(spark)
    folds = sampling.stratified_kfold(df, 5, seed=1).toPandas()
    assert set(folds.fold) == set(range(5))
    per = folds.groupby(["isFraud", "fold"]).size().unstack()
    assert (per.max(axis=1) - per.min(axis=1) <= 1).all()
    sub = sampling.stratified_subsample(df, 500, seed=1)
    assert sub.count() == 500
    assert sampling.sample_n(df, 123, seed=9).count() == 123


def test_knn_matches_brute_force_with_duplicates(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 3)).round(1)
    x[10:200] = x[10]  # a hot duplicate vector
    pdf = pd.DataFrame(x, columns=["a", "b", "c"])
    pdf["id"] = np.arange(len(x)) * 3
    old = knn.BLOCK
    knn.BLOCK = 16
    try:
        got = knn.minority_knn(spark.createDataFrame(pdf), "id", ["a", "b", "c"], k=5).toPandas()
    finally:
        knn.BLOCK = old
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    nb = got.sort_values(["id", "rank"]).groupby("id")["neighbor_id"].apply(list).to_dict()
    for a in range(len(x)):
        exp = [int(i) for _, i in sorted((d[a, b], pdf.id[b]) for b in range(len(x)) if b != a)[:5]]
        assert nb[int(pdf.id[a])] == exp


def test_smote_rows_on_segments(spark):
    rng = np.random.default_rng(5)
    n = 400
    pdf = pd.DataFrame({"tx_id": np.arange(n), "a": rng.normal(size=n), "b": rng.normal(size=n)})
    pdf["isFraud"] = (np.arange(n) < 30).astype("int32")
    df = spark.createDataFrame(pdf)
    nn = knn.minority_knn(df.filter("isFraud = 1"), "tx_id", ["a", "b"], k=5)
    syn = imbalance.smote(df, "tx_id", ["a", "b"], ratio=0.3, k=5, seed=7, knn=nn).toPandas()
    assert len(syn) == int(0.3 * 370 - 30)
    mino = pdf[pdf.isFraud == 1][["a", "b"]].to_numpy()
    pairs = nn.toPandas()
    seg_ok = 0
    for _, r in syn.iterrows():
        p = np.array([r.a, r.b])
        for _, e in pairs.iterrows():
            a = pdf.loc[pdf.tx_id == e.id, ["a", "b"]].to_numpy()[0]
            b = pdf.loc[pdf.tx_id == e.neighbor_id, ["a", "b"]].to_numpy()[0]
            u = np.dot(p - a, b - a) / max(np.dot(b - a, b - a), 1e-300)
            if -1e-9 <= u <= 1 + 1e-9 and np.allclose(a + u * (b - a), p, atol=1e-9):
                seg_ok += 1
                break
    assert seg_ok == len(syn)
    assert mino.shape[0] == 30


def test_constant_and_pairwise_correlation(spark):
    pdf = pd.DataFrame({"x": [1.0] * 6, "y": [1.0, 2.0, 4.0, 3.0, 6.0, 5.0], "z": [2.0, 4.0, 8.0, 6.0, None, 10.0]})
    pdf["tx_id"] = range(6)
    df = spark.createDataFrame(pdf)
    got = {(r["feature_i"], r["feature_j"]): r["r"] for r in correlation.correlation_matrix(df, ["x", "y", "z"]).collect()}
    exp = pdf[["x", "y", "z"]].corr()
    assert got[("x", "y")] is None and got[("x", "x")] is None
    assert got[("y", "z")] == pytest.approx(exp.loc["y", "z"], abs=1e-12)
    kept, dropped = correlation.drop_collinear(df, 0.95)
    assert dropped == ["z"] and "z" not in kept.columns


def test_tie_scores_fixture(spark):
    s = spark.createDataFrame(
        [(i, y, p) for i, (p, y) in enumerate(zip([0.1, 0.4, 0.35, 0.8, 0.8], [0, 0, 1, 1, 0]))],
        "id long, y_true int, score double",
    )
    assert ev.average_precision(s) == pytest.approx(0.5)
    assert ev.auc_roc(s) == pytest.approx(0.583333333, abs=1e-8)


def test_scored_fixture_values(spark):
    from txrisk.sources.scored import scored_events

    s = scored_events(spark, "/root/testdata/sf0.01")
    assert ev.average_precision(s) == pytest.approx(0.362933949, abs=1e-9)
    assert ev.auc_roc(s) == pytest.approx(0.776184166, abs=1e-9)
    sweep = ev.threshold_sweep(s).toPandas()
    assert len(sweep) == 85
    pdf = s.toPandas()
    for t in (0.1, 0.5, 0.94):
        pred = pdf.score >= t
        row = sweep[np.isclose(sweep.threshold, t)].iloc[0]
        assert row.tp == int((pred & (pdf.y_true == 1)).sum()) and row.fp == int((pred & (pdf.y_true == 0)).sum())


def test_knn_prunes_on_real_features(spark):
    """On the real 36-column minority, bounds leave less than 5 % of the pairs to compare, and the result equals brute force."""
    import __spark_entry__ as entry_module  # noqa: F401  (registers the queries)
    from txrisk.plans import registry

    prepared, cols = registry._prepared_train(spark, "/root/testdata/sf0.1")
    minority = prepared.filter("isFraud = 1").select("tx_id", *cols).cache()
    pdf = minority.toPandas()
    x = pdf[cols].fillna(0.0).to_numpy(dtype=float)
    assert len(x) > 1500
    own, other = knn._own_cell, knn._other_cell
    acc = spark.sparkContext.accumulator(0)

    def counted(f, *args):
        before = knn.compared["pairs"]
        out = f(*args)
        acc.add(knn.compared["pairs"] - before)
        return out

    old = knn.BLOCK
    for block in (old, 64):
        start = acc.value
        knn.BLOCK, knn._own_cell, knn._other_cell = block, lambda k: lambda p: counted(own(k), p), lambda q, r: counted(other, q, r)
        try:
            got = knn.minority_knn(minority, "tx_id", cols, k=5).toPandas()
        finally:
            knn.BLOCK, knn._own_cell, knn._other_cell = old, own, other
        d = np.zeros((len(x), len(x)))
        for j in range(x.shape[1]):
            d += (x[:, j][:, None] - x[:, j][None, :]) ** 2
        ids = pdf["tx_id"].to_numpy()
        np.fill_diagonal(d, np.inf)
        nb = got.sort_values(["id", "rank"]).groupby("id")["neighbor_id"].apply(list).to_dict()
        for a in range(len(x)):
            assert ids[np.lexsort((ids, d[a]))[:5]].tolist() == nb[ids[a]]
        assert acc.value - start < 0.05 * len(x) ** 2


def test_smote_index_is_the_same_for_any_partitioning_and_key_type(spark):
    keys = [2**60 + k for k in range(300)]
    for values, kind in ((keys, "long"), ([f"id-{k}" for k in keys], "string")):
        want = None
        for n in (1, 7, 64):
            df = spark.createDataFrame([(v,) for v in values], f"k {kind}").repartition(n)
            got = sorted((r["idx"], r["k"]) for r in imbalance.dense_index(df, "k").collect())
            assert [i for i, _ in got] == list(range(300))
            want = want or got
            assert got == want
