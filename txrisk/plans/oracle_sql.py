"""DuckDB SQL twins of the Spark operators, used as the correctness oracle.

The driver registers the parquet tables as views; every statement here is
plain SQL over them. Spark and DuckDB outputs are compared after rounding
doubles to fixed decimals on both sides (``R`` below / ``round_doubles``).
"""

from __future__ import annotations

from txrisk.schema import BALANCE_COLS
from txrisk.sources.transactions import tpch_transactions_sql

DIGITS = 6


def R(expr: str, digits: int = DIGITS) -> str:
    """Rounded double; '+ 0.0' turns -0.0 into 0.0 as in the Spark twin."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


def tx_cte() -> str:
    return f"tx AS ({tpch_transactions_sql('duckdb')})"


def _clip(c: str) -> str:
    return f"CASE WHEN {c} < b.lo_{c} THEN b.lo_{c} WHEN {c} > b.hi_{c} THEN b.hi_{c} ELSE {c} END"


def features_ctes(source: str = "tx", p_low: float = 0.005, p_high: float = 0.995, min_count: int = 100) -> str:
    """CTEs ``bounds``, ``cleaned``, ``feat`` on top of the ledger CTE ``source``."""
    bounds = ",\n    ".join(
        f"CASE WHEN count({c}) > {min_count} THEN quantile_cont({c}, {p_low}) END AS lo_{c}, "
        f"CASE WHEN count({c}) > {min_count} THEN quantile_cont({c}, {p_high}) END AS hi_{c}"
        for c in BALANCE_COLS
    )
    miss = ",\n    ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_miss" for c in BALANCE_COLS)
    any_miss = " OR ".join(f"{c} IS NULL" for c in BALANCE_COLS)
    clipped = ",\n    ".join(f"coalesce({_clip(c)}, 0.0) AS {c}" for c in BALANCE_COLS)
    return f"""
bounds AS (
  SELECT
    {bounds}
  FROM {source}
),
cleaned AS (
  SELECT tx_id, step, CAST(type AS VARCHAR) AS type,
    CASE WHEN amount < 0 THEN 0.0 ELSE amount END AS amount,
    {clipped},
    {miss},
    CAST(({any_miss}) AS INTEGER) AS any_balance_missing,
    isFraud
  FROM {source}, bounds b
),
timed AS (
  SELECT *, CAST(((step % 24) + 24) % 24 AS BIGINT) AS hr,
         CAST((((step - ((step % 24) + 24) % 24) // 24) % 30 + 30) % 30 AS BIGINT) AS dy
  FROM cleaned
),
feat AS (
  SELECT tx_id, step, type, amount,
    oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest,
    oldbalanceOrg_miss, newbalanceOrig_miss, oldbalanceDest_miss, newbalanceDest_miss, any_balance_missing,
    newbalanceOrig - oldbalanceOrg AS balance_change_orig,
    newbalanceDest - oldbalanceDest AS balance_change_dest,
    (oldbalanceOrg - amount) - newbalanceOrig AS diff_orig,
    (oldbalanceDest + amount) - newbalanceDest AS diff_dest,
    CAST(coalesce(abs((oldbalanceOrg - amount) - newbalanceOrig) > 0.01, false) AS INTEGER) AS inconsistent_orig,
    CAST(coalesce(abs((oldbalanceDest + amount) - newbalanceDest) > 0.01, false) AS INTEGER) AS inconsistent_dest,
    CAST(coalesce(oldbalanceOrg > 0 AND newbalanceOrig = 0, false) AS INTEGER) AS emptied_account,
    CAST(coalesce(oldbalanceDest = 0, false) AS INTEGER) AS dest_account_new,
    CASE WHEN amount > -1 THEN ln(1 + amount) END AS log1p_amount,
    amount / nullif(oldbalanceOrg + 1, 0) AS amount_vs_balance_orig,
    amount / nullif(oldbalanceDest + 1, 0) AS amount_vs_balance_dest,
    CAST(coalesce(abs(amount - oldbalanceOrg) < 0.01, false) AS INTEGER) AS amount_equals_balance,
    CAST(coalesce(amount % 10000 = 0, false) AS INTEGER) AS amount_is_round,
    hr AS hour_of_day,
    dy AS day_of_month,
    CAST(coalesce(hr BETWEEN 0 AND 5, false) AS INTEGER) AS is_night,
    CAST(coalesce(dy % 7 IN (0, 6), false) AS INTEGER) AS is_weekend,
    CASE WHEN oldbalanceOrg > -1 THEN ln(1 + oldbalanceOrg) END AS log1p_oldbalanceOrg,
    CASE WHEN newbalanceOrig > -1 THEN ln(1 + newbalanceOrig) END AS log1p_newbalanceOrig,
    CASE WHEN oldbalanceDest > -1 THEN ln(1 + oldbalanceDest) END AS log1p_oldbalanceDest,
    CASE WHEN newbalanceDest > -1 THEN ln(1 + newbalanceDest) END AS log1p_newbalanceDest,
    isFraud
  FROM timed
)"""


def with_features(body: str) -> str:
    """Full statement: ledger + features CTEs, then ``body`` (which may add CTEs after a comma)."""
    return f"WITH {tx_cte()},{features_ctes()}\n{body}"
