"""Physical-plan properties: pruned scans, pushed filters, no cross joins in the operators."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_flagship_scan_is_pruned(spark):
    import __spark_entry__ as E

    text = plan_text(E.entry(spark))
    orders_schema = [ln for ln in text.splitlines() if "ReadSchema" in ln and "o_orderkey" in ln]
    assert orders_schema, text
    # fraud rate by type needs neither the order date nor the price
    assert all("o_orderdate" not in ln and "o_totalprice" not in ln for ln in orders_schema)
    assert "PushedFilters: [IsNotNull(o_custkey)]" in text


def _no_cross(df):
    text = plan_text(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, text


@pytest.mark.parametrize(
    "name", ["histogram_by_class", "threshold_sweep", "stratified_split", "roc_curve", "fraud_rate_by_indicators"]
)
def test_no_cross_joins(spark, name):
    import __spark_entry__ as E

    _no_cross(E.queries()[name](spark, SF_SMALL))


def test_knn_and_smote_plans_have_no_cross_joins(spark):
    import numpy as np
    import pandas as pd

    from txrisk.operators import knn

    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(rng.normal(size=(300, 3)), columns=["a", "b", "c"])
    pdf["id"] = np.arange(300)
    old = knn.BLOCK
    knn.BLOCK = 16  # several rounds of cuts
    try:
        _no_cross(knn._minority_knn(spark.createDataFrame(pdf), "id", ["a", "b", "c"], 5))
    finally:
        knn.BLOCK = old


def test_split_assignment_is_map_only(spark):
    from txrisk.operators import sampling

    df = spark.range(2000).select(F.col("id").alias("tx_id"), (F.col("id") % 37 == 0).cast("int").alias("isFraud"))
    text = plan_text(sampling.stratified_split(df))
    # the split itself adds no shuffle and no window over a class
    assert "Exchange" not in text and "Window" not in text, text
