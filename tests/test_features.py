"""Null/NaN/zero rules of the feature code on hand-written rows."""

import math

import numpy as np

from txrisk.operators import features as fo
from txrisk.plans.feature_plan import build_features
from txrisk.schema import FEATURE_COLS, TRANSACTION_SCHEMA
from txrisk.sources.transactions import normalise_ledger

NAN = float("nan")


def _ledger(spark, rows):
    return normalise_ledger(spark.createDataFrame(rows, TRANSACTION_SCHEMA))


def test_nan_rows(spark):
    rows = [
        # tx_id, step, type, amount, nameOrig, oldOrg, newOrig, nameDest, oldDest, newDest, isFraud
        (1, -5, "A", NAN, "C1", -1.0, 0.0, None, None, 10.0, 0),
        (2, 29, None, 0.0, "C2", -5.0, NAN, "M1", 0.0, 0.0, 1),
        (3, 0, "B", -50.0, "C3", 100.0, 0.0, "M2", 5.0, 5.0, 0),
    ]
    out = {r["tx_id"]: r for r in build_features(spark, _ledger(spark, rows)).collect()}
    r1, r2, r3 = out[1], out[2], out[3]
    # NaN -> NULL on load: flags count it as missing, comparisons as false
    assert r1["amount"] is None and r1["log1p_amount"] is None
    assert r1["inconsistent_orig"] == 0 and r1["amount_equals_balance"] == 0 and r1["amount_is_round"] == 0
    assert r2["newbalanceOrig_miss"] == 1 and r2["any_balance_missing"] == 1
    assert r1["oldbalanceDest_miss"] == 1 and r3["any_balance_missing"] == 0
    # balance -1: amount / (balance + 1) is NULL instead of an error or inf; log1p(-1) NULL
    assert r1["amount_vs_balance_orig"] is None and r1["log1p_oldbalanceOrg"] is None
    # log1p of x < -1 is NULL
    assert r2["log1p_oldbalanceOrg"] is None
    # floor semantics for negative steps: -5 -> hour 19, day floor(-5/24) = -1 -> 29
    assert r1["hour_of_day"] == 19 and r1["day_of_month"] == 29 and r1["is_night"] == 0
    assert r2["hour_of_day"] == 5 and r2["is_night"] == 1 and r2["day_of_month"] == 1
    # negative amount clipped to 0, which counts as round
    assert r3["amount"] == 0.0 and r3["amount_is_round"] == 1
    # filled balances: NULL destination -> 0 -> new account
    assert r1["oldbalanceDest"] == 0.0 and r1["dest_account_new"] == 1
    assert r3["emptied_account"] == 1
    assert list(build_features(spark, _ledger(spark, rows)).columns)[1:-1] == FEATURE_COLS


def test_winsor_guard_needs_more_than_100(spark):
    base = [(i, 0, "A", 1.0, "C", float(i), 0.0, "M", 0.0, 0.0, 0) for i in range(100)]
    b100 = {r["column"]: r for r in fo.fit_outlier_bounds(spark, _ledger(spark, base)).collect()}
    assert b100["oldbalanceOrg"]["lo"] is None  # exactly 100 values: no clipping
    more = base + [(100, 0, "A", 1.0, "C", 1e9, 0.0, "M", 0.0, 0.0, 0)]
    b101 = {r["column"]: r for r in fo.fit_outlier_bounds(spark, _ledger(spark, more)).collect()}
    vals = np.array([float(i) for i in range(100)] + [1e9])
    assert math.isclose(b101["oldbalanceOrg"]["hi"], float(np.percentile(vals, 99.5)), rel_tol=1e-12)
    assert math.isclose(b101["oldbalanceOrg"]["lo"], float(np.percentile(vals, 0.5)), rel_tol=1e-12)
    clipped = fo.handle_outliers(spark, _ledger(spark, more)).agg({"oldbalanceOrg": "max"}).first()[0]
    assert clipped < 1e9


def test_csv_na_strings(spark, tmp_path):
    from txrisk.sources.transactions import load_transactions

    p = tmp_path / "ledger.csv"
    p.write_text(
        "tx_id,step,type,amount,nameOrig,oldbalanceOrg,newbalanceOrig,nameDest,oldbalanceDest,newbalanceDest,isFraud\n"
        "1,1,NA,NaN,C1,,abc,M1,1.5,2.5,0\n"
        "2,2,PAYMENT,10,C2,5,NA,NULL,1,1,1\n"
    )
    rows = {r["tx_id"]: r for r in load_transactions(spark, f"file://{p}").collect()}
    assert rows[1]["type"] is None and rows[1]["amount"] is None
    assert rows[1]["oldbalanceOrg"] is None and rows[1]["newbalanceOrig"] is None
    assert rows[2]["newbalanceOrig"] is None and rows[2]["nameDest"] is None and rows[2]["amount"] == 10.0
