"""Canonical schemas and column groups of the transaction ledger."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "tx_id"
TARGET = "isFraud"

# The raw ledger columns the feature code relies on.
BALANCE_COLS = ["oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]
NAME_COLS = ["nameOrig", "nameDest"]
INDICATOR_COLS = [
    "emptied_account",
    "inconsistent_orig",
    "inconsistent_dest",
    "dest_account_new",
    "amount_is_round",
]

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("tx_id", T.LongType(), True),
        T.StructField("step", T.LongType(), True),
        T.StructField("type", T.StringType(), True),
        T.StructField("amount", T.DoubleType(), True),
        T.StructField("nameOrig", T.StringType(), True),
        T.StructField("oldbalanceOrg", T.DoubleType(), True),
        T.StructField("newbalanceOrig", T.DoubleType(), True),
        T.StructField("nameDest", T.StringType(), True),
        T.StructField("oldbalanceDest", T.DoubleType(), True),
        T.StructField("newbalanceDest", T.DoubleType(), True),
        T.StructField("isFraud", T.IntegerType(), True),
    ]
)

# Engineered columns, in the order the pipeline appends them.
MISS_COLS = [f"{c}_miss" for c in BALANCE_COLS] + ["any_balance_missing"]
BALANCE_FEATURES = [
    "balance_change_orig",
    "balance_change_dest",
    "diff_orig",
    "diff_dest",
    "inconsistent_orig",
    "inconsistent_dest",
    "emptied_account",
    "dest_account_new",
]
AMOUNT_FEATURES = [
    "log1p_amount",
    "amount_vs_balance_orig",
    "amount_vs_balance_dest",
    "amount_equals_balance",
    "amount_is_round",
]
TEMPORAL_FEATURES = ["hour_of_day", "day_of_month", "is_night", "is_weekend"]
LOG_FEATURES = [f"log1p_{c}" for c in BALANCE_COLS]

FEATURE_COLS = (
    ["step", "type", "amount"]
    + BALANCE_COLS
    + MISS_COLS
    + BALANCE_FEATURES
    + AMOUNT_FEATURES
    + TEMPORAL_FEATURES
    + LOG_FEATURES
)
NUMERIC_FEATURES = [c for c in FEATURE_COLS if c != "type"]
CATEGORICAL_FEATURES = ["type"]

NUMERIC_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)


def numeric_columns(df, exclude=(KEY, TARGET)):
    """Numeric columns of ``df`` in schema order (what pandas' select_dtypes(number) keeps)."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude
    ]


def require_columns(df, cols, what="column"):
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Required {what}(s) not found in data: {missing}")
