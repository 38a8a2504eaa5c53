"""Cleaning and feature engineering.

Each step is a single ``select`` so that Catalyst collapses the whole chain
into one projection inside one whole-stage-codegen span. The only job
before the projection is the aggregate that fits the winsor bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.functions import chunked_aggregates, flag, safe_log1p, safe_ratio
from txrisk.operators.quantiles import exact_quantiles
from txrisk.plans.persist import passes_over
from txrisk.schema import BALANCE_COLS, NAME_COLS, require_columns

# Clipping percentiles and the minimum count of the reference.
WINSOR_LOW = 0.01
WINSOR_HIGH = 0.99
OUTLIER_LOW = 0.005
OUTLIER_HIGH = 0.995
OUTLIER_MIN_COUNT = 100  # clip only columns with MORE than this many non-null values

BOUNDS_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType(), False),
        T.StructField("lo", T.DoubleType(), True),
        T.StructField("hi", T.DoubleType(), True),
        T.StructField("n", T.LongType(), False),
    ]
)


def _replace(df: DataFrame, updates: dict) -> DataFrame:
    """Replace / append columns in one select, keeping the column order."""
    cols = [updates.pop(c).alias(c) if c in updates else F.col(c) for c in df.columns]
    cols += [expr.alias(name) for name, expr in updates.items()]
    return df.select(*cols)


def cast_types(df: DataFrame) -> DataFrame:
    """B1: ``type`` is categorical (string) when present."""
    if "type" not in df.columns:
        return df
    return _replace(df, {"type": F.col("type").cast("string")})


def missing_flags(df: DataFrame, cols=BALANCE_COLS) -> DataFrame:
    """B2: ``<c>_miss`` per present column, ``any_balance_missing`` when there is one."""
    present = [c for c in cols if c in df.columns]
    updates = {f"{c}_miss": F.col(c).isNull().cast("int") for c in present}
    if present:
        updates["any_balance_missing"] = F.greatest(*[F.col(c).isNull() for c in present] + [F.lit(False)]).cast("int")
    return _replace(df, updates)


def fit_winsor_bounds(
    spark: SparkSession,
    df: DataFrame,
    cols,
    p_low: float = WINSOR_LOW,
    p_high: float = WINSOR_HIGH,
    min_count: int = 0,
) -> DataFrame:
    """B3 fit: exact linearly interpolated quantiles per column as a small table.

    Columns with ``min_count`` or fewer non-null values get NULL bounds (no clipping).
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return spark.createDataFrame([], BOUNDS_SCHEMA)
    with passes_over(df.select(*cols)) as data:  # the ledger is read once, by the first of these passes
        counts = {c: int(r["n"]) for c, r in zip(cols, chunked_aggregates(data, [{"n": F.count(c)} for c in cols]))}
        eligible = [c for c in cols if counts[c] > min_count]
        q = exact_quantiles(data, eligible, [p_low, p_high], counts=counts) if eligible else {}
    rows = [
        (c, q.get((c, p_low)), q.get((c, p_high)), counts[c]) if c in eligible else (c, None, None, counts[c])
        for c in cols
    ]
    return spark.createDataFrame(rows, BOUNDS_SCHEMA)


def _clip(c, lo, hi):
    # when-chain, not greatest/least: those skip NULLs and would turn NULL into a bound.
    expr = F.col(c)
    out = None
    if lo is not None:
        out = F.when(expr < F.lit(lo), F.lit(lo))
    if hi is not None:
        cond = expr > F.lit(hi)
        out = out.when(cond, F.lit(hi)) if out is not None else F.when(cond, F.lit(hi))
    return expr if out is None else out.otherwise(expr)


def winsorize(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """B3 apply: clip each bounded column; NULLs stay NULL.

    The bounds table has one row per column (size fixed by the schema), so it
    is read on the driver and inlined as literals: no join, no shuffle.
    """
    spec = {r["column"]: (r["lo"], r["hi"]) for r in bounds.collect()}
    updates = {c: _clip(c, lo, hi) for c, (lo, hi) in spec.items() if c in df.columns}
    return _replace(df, updates)


def fit_outlier_bounds(spark: SparkSession, df: DataFrame, cols=BALANCE_COLS) -> DataFrame:
    """Bounds of ``handle_outliers``: 0.5 / 99.5 %, only for columns with > 100 values."""
    return fit_winsor_bounds(spark, df, cols, OUTLIER_LOW, OUTLIER_HIGH, min_count=OUTLIER_MIN_COUNT)


def handle_outliers(spark: SparkSession, df: DataFrame, cols=BALANCE_COLS, bounds: DataFrame | None = None) -> DataFrame:
    """Winsorize balances with stored or freshly fitted bounds; negative amounts -> 0."""
    if bounds is None:
        bounds = fit_outlier_bounds(spark, df, cols)
    out = winsorize(df, bounds)
    if "amount" in out.columns:
        out = _replace(out, {"amount": F.when(F.col("amount") < 0, F.lit(0.0)).otherwise(F.col("amount"))})
    return out


def balance_features(df: DataFrame, cols=BALANCE_COLS) -> DataFrame:
    """Balances filled with 0, changes, expected-vs-actual differences and flags."""
    require_columns(df, ["amount"] + list(BALANCE_COLS))
    filled = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in cols if c in df.columns}
    df = _replace(df, filled)
    ob, nb, od, nd, amt = (F.col(c) for c in ("oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest", "amount"))
    diff_orig = (ob - amt) - nb
    diff_dest = (od + amt) - nd
    return _replace(
        df,
        {
            "balance_change_orig": nb - ob,
            "balance_change_dest": nd - od,
            "diff_orig": diff_orig,
            "diff_dest": diff_dest,
            "inconsistent_orig": flag(F.abs(diff_orig) > 0.01),
            "inconsistent_dest": flag(F.abs(diff_dest) > 0.01),
            "emptied_account": flag((ob > 0) & (nb == 0)),
            "dest_account_new": flag(od == 0),
        },
    )


def amount_features(df: DataFrame) -> DataFrame:
    """Log amount, amount relative to balances, equality and roundness flags."""
    amt, ob, od = F.col("amount"), F.col("oldbalanceOrg"), F.col("oldbalanceDest")
    return _replace(
        df,
        {
            "log1p_amount": safe_log1p(amt),
            "amount_vs_balance_orig": safe_ratio(amt, ob + 1),
            "amount_vs_balance_dest": safe_ratio(amt, od + 1),
            "amount_equals_balance": flag(F.abs(amt - ob) < 0.01),
            "amount_is_round": flag(F.pmod(amt, F.lit(10000.0)) == 0),
        },
    )


def temporal_features(df: DataFrame) -> DataFrame:
    """Hour of day, day of a 30-day month, night and weekend flags (floor semantics)."""
    if "step" not in df.columns:
        return df
    step = F.col("step").cast("long")
    hour = F.pmod(step, F.lit(24))
    # (step - hour) is a multiple of 24, so the division is exact: floor division.
    day = F.pmod(((step - hour) / F.lit(24)).cast("long"), F.lit(30))
    return _replace(
        df,
        {
            "hour_of_day": hour.cast("long"),
            "day_of_month": day.cast("long"),
            "is_night": flag(hour.between(0, 5)),
            "is_weekend": flag(F.pmod(day, F.lit(7)).isin(0, 6)),
        },
    )


def log_transforms(df: DataFrame, cols=BALANCE_COLS) -> DataFrame:
    """``log1p_<c>`` for present columns (NULL where the argument is <= -1)."""
    return _replace(df, {f"log1p_{c}": safe_log1p(F.col(c)) for c in cols if c in df.columns})


def drop_unused(df: DataFrame, cols=NAME_COLS) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*[c for c in cols if c in df.columns])


def clean(spark: SparkSession, df: DataFrame, bounds: DataFrame | None = None, clip: bool = True) -> DataFrame:
    """Types -> missing flags (on raw values) -> outlier handling.

    Without ``clip`` the balances stay unclipped and no bounds are fitted: for results that don't read them.
    """
    df = cast_types(df)
    df = missing_flags(df, BALANCE_COLS)
    if not clip:
        return _replace(df, {"amount": F.when(F.col("amount") < 0, F.lit(0.0)).otherwise(F.col("amount"))}) if "amount" in df.columns else df
    return handle_outliers(spark, df, BALANCE_COLS, bounds=bounds)


def engineer(df: DataFrame) -> DataFrame:
    """Balance -> amount -> temporal -> log features, then drop the account names."""
    df = balance_features(df, BALANCE_COLS)
    df = amount_features(df)
    df = temporal_features(df)
    df = log_transforms(df, BALANCE_COLS)
    return drop_unused(df, NAME_COLS)
