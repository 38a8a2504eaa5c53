"""Flagship plan: ledger -> cleaned -> engineered feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txrisk.operators.features import clean, drop_unused, engineer
from txrisk.plans.persist import materialize
from txrisk.schema import KEY, TARGET
from txrisk.sources.transactions import extract_target, load_transactions, tpch_transactions


def order_columns(df: DataFrame) -> DataFrame:
    """Key first, label last, features in pipeline order between them."""
    head = [KEY] if KEY in df.columns else []
    tail = [TARGET] if TARGET in df.columns else []
    return df.select(*head, *[c for c in df.columns if c not in (KEY, TARGET)], *tail)


def build_features(spark: SparkSession, tx: DataFrame, bounds: DataFrame | None = None, clip: bool = True) -> DataFrame:
    """A2 -> B10 -> B11 on a ledger DataFrame.

    ``clip=False`` starts no job: for profiles that read no balance or column made from one.

    The label stays a column (rows are not aligned by position in Spark);
    ``extract_target`` only validates that it is there.
    """
    extract_target(tx)
    return order_columns(engineer(clean(spark, tx, bounds=bounds, clip=clip)))


def feature_table(spark: SparkSession, path: str, fmt: str | None = None, bounds: DataFrame | None = None) -> DataFrame:
    """B12 from a file: load -> target check -> clean -> engineer."""
    return build_features(spark, load_transactions(spark, path, fmt=fmt), bounds=bounds)


def tpch_feature_table(spark: SparkSession, sf_dir: str, bounds: DataFrame | None = None, clip: bool = True) -> DataFrame:
    """B12 from the test tables. Where bounds are fitted first, the ledger's joins run once, into a written table."""
    ledger = tpch_transactions(spark, sf_dir)
    if clip and bounds is None:
        ledger = materialize(drop_unused(ledger), "ledger")  # no feature is made of the account names
    return build_features(spark, ledger, bounds=bounds, clip=clip)
