"""Shapes of plans and work that must not change with the data: scans, generated rows, tasks of hot keys."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txrisk.functions import chunked_aggregates
from txrisk.operators import evaluation as ev
from txrisk.operators import profile, quantiles, selection
from txrisk.sources.transactions import with_content_key


def _plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_evaluation_reads_the_scored_rows_once(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"y_true": (rng.random(4000) < 0.2).astype(int), "score": rng.random(4000).round(3)})
    pdf.loc[:50, "score"] = np.nan
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    base = spark.createDataFrame(pdf).cache()
    base.count()
    scored = base.mapInArrow(count, base.schema)
    got = ev.evaluate(scored, 0.5).first()
    assert read.value == 4000
    # The same as from the single operators, each over the rows themselves.
    c = ev.confusion_matrix(base, 0.5).first()
    assert (got["true_negatives"], got["false_positives"], got["false_negatives"], got["true_positives"]) == tuple(c)
    best = ev.optimal_threshold(base).first()
    assert (got["optimal_threshold"], got["optimal_f1_score"]) == (best["threshold"], best["value"])
    assert got["auc_roc"] == pytest.approx(ev.auc_roc(base), abs=1e-12) and got["auc_pr"] == pytest.approx(ev.average_precision(base), abs=1e-12)


def test_wide_statistics_multiply_no_rows(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.normal(size=(500, 30)), columns=[f"c{i}" for i in range(30)])
    pdf["empty"] = np.nan
    df = spark.createDataFrame(pdf).select(*[F.nanvl(c, F.lit(None)).alias(c) for c in pdf.columns]).cache()
    out = {r["feature"]: r for r in profile.describe(df).collect()}
    want = pdf.describe().T
    for c in pdf.columns[:-1]:
        for a, b in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert out[c][a] == pytest.approx(want.loc[c, b], rel=1e-9)
    assert out["empty"]["count"] == 0 and out["empty"]["mean"] is None and out["empty"]["q50"] is None
    items = [{"n": F.count(c), "m": F.avg(c)} for c in pdf.columns]
    rows = chunked_aggregates(df, items, chunk=7)
    assert [r["at"] for r in rows] == list(range(31)) and rows[-1]["n"] == 0
    assert "Generate" not in _plan(df.agg(*[e.alias(f"{k}{i}") for i, x in enumerate(items) for k, e in x.items()]))


def test_thousand_targets_are_one_lookup(spark):
    rng = np.random.default_rng(2)
    n = 60_000
    pdf = pd.DataFrame({"h": rng.integers(0, 1 << 60, n), "k": np.arange(n), "g": rng.integers(0, 2, n)})
    df = spark.createDataFrame(pdf).cache()
    order = {g: part.sort_values(["h", "k"])[["h", "k"]].to_numpy() for g, part in pdf.groupby("g")}
    targets = [(g, int(r)) for g in (0, 1) for r in np.linspace(0, len(order[g]) - 1, 500)]
    plans = []
    inner = selection._in_places

    def seen(*args):
        out = inner(*args)
        plans.append(_plan(out))
        return out

    old, selection._in_places = selection._in_places, seen
    try:
        for limit in (selection.ROW_LIMIT, 20):
            keep, selection.ROW_LIMIT = selection.ROW_LIMIT, limit
            got = selection.rank_cutoffs(df, "h", "k", "g", targets)
            selection.ROW_LIMIT = keep
            assert all(got[(g, r)] == tuple(map(int, order[g][r])) for g, r in targets)
    finally:
        selection._in_places = old
    assert plans and all("Generate" not in p and "INSET" in p for p in plans)
    assert selection.rank_cutoffs(df, "h", "k", None, [(None, 5)])[(None, 5)] == tuple(map(int, pdf.sort_values(["h", "k"])[["h", "k"]].to_numpy()[5]))


def test_equal_rows_are_numbered_where_they_lie(spark):
    # A third of the rows are equal; no group that is numbered holds more than a partition's share of them.
    rows = [(1, "same", None)] * 4000 + [(i, f"r{i}", 1.0) for i in range(8000)] + [(7, "twice", 2.0)] * 2
    df = spark.createDataFrame(rows, "a long, b string, c double").repartition(16)
    keyed = with_content_key(df).cache()
    assert keyed.columns == ["a", "b", "c", "tx_id"] and keyed.count() == len(rows)
    assert keyed.select("tx_id").distinct().count() == len(rows)
    hot = [r[0] for r in keyed.where("b = 'same'").select("tx_id").collect()]
    assert sorted(int(k.split("-")[1]) for k in hot) == list(range(1, 4001))
    again = with_content_key(df.repartition(3))
    assert sorted(r[0] for r in again.select("tx_id").collect()) == sorted(r[0] for r in keyed.select("tx_id").collect())
    # Rows meet by content and partition; only counts meet by content alone.
    plan = _plan(keyed.select("tx_id"))
    assert "windowspecdefinition(_content" in plan and "_part" in plan


def test_quantiles_with_ties_and_infinities(spark):
    x = [-5.0] * 3 + [0.0, -0.0, 1.0, 1.0, 5.0, float("inf")]
    df = spark.createDataFrame([(v, None) for v in x], "x double, y double")
    got = quantiles.exact_quantiles(df, ["x", "y"], [0.0, 0.5, 0.75])
    assert got[("x", 0.0)] == -5.0 and got[("x", 0.5)] == 0.0 and got[("x", 0.75)] == 1.0 and got[("y", 0.5)] is None


def test_many_categories_are_never_spelled_out(spark, monkeypatch):
    from txrisk.operators import preprocess

    n = 100_000
    df = spark.range(n).select(
        F.col("id").alias("tx_id"), F.format_string("c%06d", F.col("id")).alias("type"), F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("x"),
        (F.col("id") % 2).cast("int").alias("isFraud"),
    )
    monkeypatch.setattr(preprocess.Preprocessor, "_categories", lambda self: pytest.fail("categories on the driver"))
    pre = preprocess.fit_preprocessor(df, categorical=["type"], numerical=["x"])
    assert pre.categories.count() == n and pre.categories.agg(F.max("position")).first()[0] == n - 1
    assert pre.categories.where(F.col("category") != F.format_string("c%06d", F.col("position"))).count() == 0
    odd = spark.createDataFrame([(-1, "never seen", 1.0, 0), (-2, None, None, 1)], "tx_id long, type string, x double, isFraud int")
    out = preprocess.transform_sparse(pre, df.unionByName(odd))
    assert out.columns == ["tx_id", "isFraud", "features"]
    plan = _plan(out)
    assert "Window" not in plan and "c000123" not in plan
    rows = {r["tx_id"]: r["features"] for r in out.where("tx_id in (-2, -1, 0, 1, 99999)").collect()}
    ones = {k: [i for i in v.indices.tolist() if i < n - 1] for k, v in rows.items()}
    assert all(v.size == n for v in rows.values())
    assert ones == {-2: [], -1: [], 0: [], 1: [0], 99999: [n - 2]}


def test_sparse_vectors_equal_the_wide_form(spark):
    from txrisk.operators import preprocess

    rng = np.random.default_rng(8)
    rows = [(i, rng.choice(["a", "b", "c", None]), rng.choice(["u", "v"]), float(rng.normal()) if i % 5 else None, i % 2) for i in range(400)]
    rows = [(i, None if t == "None" else t, str(u), x, y) for i, t, u, x, y in rows]
    df = spark.createDataFrame(rows, "tx_id long, type string, kind string, x double, isFraud int")
    pre = preprocess.fit_preprocessor(df.where("tx_id < 300"), categorical=["type", "kind"], numerical=["x"])
    wide = preprocess.with_features_vector(preprocess.transform(pre, df), pre.output_columns()).collect()
    want = {r["tx_id"]: r["features"].toArray().tolist() for r in wide}
    got = {r["tx_id"]: r["features"].toArray().tolist() for r in preprocess.transform_sparse(pre, df).collect()}
    assert got == want and len(got) == 400


def test_the_ledger_is_evaluated_once(spark, monkeypatch):
    from txrisk.plans import feature_plan

    read = spark.sparkContext.accumulator(0)
    ledger = feature_plan.tpch_transactions(spark, "/root/testdata/sf0.001").cache()
    n = ledger.count()

    def counted(*_):
        def run(batches):
            for b in batches:
                read.add(b.num_rows)
                yield b

        return ledger.mapInArrow(run, ledger.schema)

    monkeypatch.setattr(feature_plan, "tpch_transactions", counted)
    out = feature_plan.tpch_feature_table(spark, "unused")
    assert out.count() == n and out.agg(F.sum("amount")).first()[0] and read.value == n
