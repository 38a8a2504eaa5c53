"""Registered queries: one Spark plan and (where SQL can say it) one DuckDB twin per operator.

Every query reads the driver's tables at ``sf_dir`` (or data Spark derives
from them) and runs over whole tables. Doubles are rounded to fixed
decimals on both sides so that last-bit differences of summation order do
not count as mismatches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.operators import features as feat_ops
from txrisk.operators import profile
from txrisk.plans.feature_plan import order_columns, tpch_feature_table
from txrisk.plans.oracle_sql import R, features_ctes, tx_cte, with_features
from txrisk.schema import BALANCE_COLS, INDICATOR_COLS, NUMERIC_FEATURES
from txrisk.sources.scored import scored_events, scored_sql
from txrisk.session import scratch_path
from txrisk.sources.transactions import extract_target, load_transactions, tpch_transactions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def round_doubles(df: DataFrame, digits: int = 6, per_column: dict | None = None) -> DataFrame:
    """Round double columns (and turn -0.0 into 0.0), as ``R`` does in the SQL twin."""
    per_column = per_column or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            d = per_column.get(f.name, digits)
            cols.append((F.round(F.col(f.name), d) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def sel_round(cols_double, cols_other=(), digits: int = 6, per_column: dict | None = None, prefix: str = "") -> str:
    per_column = per_column or {}
    parts = [f"{prefix}{c}" for c in cols_other]
    parts += [f"{R(prefix + c, per_column.get(c, digits))} AS {c}" for c in cols_double]
    return ", ".join(parts)


# Column groups of the ledger and of the feature table (for the SQL twins).
TX_DOUBLES = ["amount"] + BALANCE_COLS
TX_OTHER = ["tx_id", "step", "type", "nameOrig", "nameDest", "isFraud"]
FEAT_DOUBLES = [
    "amount", *BALANCE_COLS, "balance_change_orig", "balance_change_dest", "diff_orig", "diff_dest",
    "log1p_amount", "amount_vs_balance_orig", "amount_vs_balance_dest",
    "log1p_oldbalanceOrg", "log1p_newbalanceOrig", "log1p_oldbalanceDest", "log1p_newbalanceDest",
]
FEAT_OTHER = [
    "tx_id", "step", "type", *[f"{c}_miss" for c in BALANCE_COLS], "any_balance_missing",
    "inconsistent_orig", "inconsistent_dest", "emptied_account", "dest_account_new",
    "amount_equals_balance", "amount_is_round", "hour_of_day", "day_of_month", "is_night", "is_weekend", "isFraud",
]


def _features(spark, sf_dir):
    return tpch_feature_table(spark, sf_dir)


def _profile_features(spark, sf_dir):
    """Features for results that read no balance: planned without the job that fits the bounds."""
    return tpch_feature_table(spark, sf_dir, clip=False)


def _tx(spark, sf_dir):
    return tpch_transactions(spark, sf_dir)


# ---------------------------------------------------------------- A: sources
_LOADED = f"SELECT tx_id, step, type, nameOrig, nameDest, isFraud, {', '.join(R(c) + ' AS ' + c for c in TX_DOUBLES)} FROM tx"


def _ledger_files(spark, sf_dir):
    """The ledger as CSV, its columns in another order and one more, and as parquet."""
    tx = _tx(spark, sf_dir)
    csv, parquet = scratch_path(spark, "ledger") + ".csv", scratch_path(spark, "ledger") + ".parquet"
    tx.select("isFraud", F.lit("x").alias("channel"), *reversed([c for c in tx.columns if c != "isFraud"])).write.option("header", True).csv(csv)
    tx.write.parquet(parquet)
    return csv, parquet


@register(
    "load_transactions",
    f"WITH {tx_cte()}, l AS ({_LOADED}) SELECT 'csv' AS source, 'x' AS channel, * FROM l UNION ALL SELECT 'parquet', NULL, * FROM l",
)
def q_load_transactions(spark, sf_dir):
    csv, parquet = (load_transactions(spark, p) for p in _ledger_files(spark, sf_dir))
    both = csv.withColumn("source", F.lit("csv")).unionByName(parquet.withColumn("source", F.lit("parquet")), allowMissingColumns=True)
    return round_doubles(both.select("source", "channel", "tx_id", "step", "type", "nameOrig", "nameDest", "isFraud", *TX_DOUBLES))


@register("extract_target", f"WITH {tx_cte()} SELECT tx_id, isFraud FROM tx")
def q_extract_target(spark, sf_dir):
    return extract_target(load_transactions(spark, _ledger_files(spark, sf_dir)[0]))[1]


_DTYPE_SQL = with_features(
    "SELECT CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' "
    "WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS dtype, count(*) AS n_columns "
    "FROM (DESCRIBE SELECT * FROM feat) GROUP BY 1"
)


@register("dtype_counts", _DTYPE_SQL)
def q_dtype_counts(spark, sf_dir):
    return profile.dtype_counts(_profile_features(spark, sf_dir))


# ---------------------------------------------------------------- B: features
_CLEAN_OTHER = ["tx_id", "step", "type", "nameOrig", "nameDest", "isFraud"] + [f"{c}_miss" for c in BALANCE_COLS] + [
    "any_balance_missing"
]


def _clean_sql():
    clip = ", ".join(
        f"{R(f'CASE WHEN {c} < b.lo_{c} THEN b.lo_{c} WHEN {c} > b.hi_{c} THEN b.hi_{c} ELSE {c} END')} AS {c}"
        for c in BALANCE_COLS
    )
    miss = ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_miss" for c in BALANCE_COLS)
    any_miss = " OR ".join(f"{c} IS NULL" for c in BALANCE_COLS)
    return (
        f"WITH {tx_cte()},{features_ctes()}\n"
        f"SELECT tx_id, step, type, nameOrig, nameDest, isFraud, {miss}, "
        f"CAST(({any_miss}) AS INTEGER) AS any_balance_missing, "
        f"{R('CASE WHEN amount < 0 THEN 0.0 ELSE amount END')} AS amount, {clip} FROM tx, bounds b"
    )


@register("clean", _clean_sql())
def q_clean(spark, sf_dir):
    return round_doubles(feat_ops.clean(spark, _tx(spark, sf_dir)))


@register(
    "missing_flags",
    f"WITH {tx_cte()} SELECT tx_id, "
    + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_miss" for c in BALANCE_COLS)
    + ", CAST((" + " OR ".join(f"{c} IS NULL" for c in BALANCE_COLS) + ") AS INTEGER) AS any_balance_missing FROM tx",
)
def q_missing_flags(spark, sf_dir):
    df = feat_ops.missing_flags(_tx(spark, sf_dir))
    return df.select("tx_id", *[f"{c}_miss" for c in BALANCE_COLS], "any_balance_missing")


_WINSOR_COLS = ["amount"] + BALANCE_COLS


def _winsor_sql():
    b = ", ".join(
        f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}" for c in _WINSOR_COLS
    )
    clip = ", ".join(
        f"{R(f'CASE WHEN {c} < b.lo_{c} THEN b.lo_{c} WHEN {c} > b.hi_{c} THEN b.hi_{c} ELSE {c} END')} AS {c}"
        for c in _WINSOR_COLS
    )
    return f"WITH {tx_cte()}, b AS (SELECT {b} FROM tx) SELECT tx_id, {clip} FROM tx, b"


@register("winsorize", _winsor_sql())
def q_winsorize(spark, sf_dir):
    tx = _tx(spark, sf_dir)
    bounds = feat_ops.fit_winsor_bounds(spark, tx, _WINSOR_COLS)
    return round_doubles(feat_ops.winsorize(tx, bounds).select("tx_id", *_WINSOR_COLS))


def _outliers_sql():
    clip = ", ".join(
        f"{R(f'CASE WHEN {c} < b.lo_{c} THEN b.lo_{c} WHEN {c} > b.hi_{c} THEN b.hi_{c} ELSE {c} END')} AS {c}"
        for c in BALANCE_COLS
    )
    return (
        f"WITH {tx_cte()},{features_ctes()}\n"
        f"SELECT tx_id, {R('CASE WHEN amount < 0 THEN 0.0 ELSE amount END')} AS amount, {clip} FROM tx, bounds b"
    )


@register("handle_outliers", _outliers_sql())
def q_handle_outliers(spark, sf_dir):
    df = feat_ops.handle_outliers(spark, _tx(spark, sf_dir))
    return round_doubles(df.select("tx_id", "amount", *BALANCE_COLS))


def _feat_subset(cols_double, cols_other):
    return with_features(f"SELECT {sel_round(cols_double, ['tx_id', *cols_other])} FROM feat")


_BAL_D = ["balance_change_orig", "balance_change_dest", "diff_orig", "diff_dest", *BALANCE_COLS]
_BAL_O = ["inconsistent_orig", "inconsistent_dest", "emptied_account", "dest_account_new"]


@register("balance_features", _feat_subset(_BAL_D, _BAL_O))
def q_balance_features(spark, sf_dir):
    df = feat_ops.balance_features(feat_ops.clean(spark, _tx(spark, sf_dir)))
    return round_doubles(df.select("tx_id", *_BAL_D, *_BAL_O))


_AMT_D = ["log1p_amount", "amount_vs_balance_orig", "amount_vs_balance_dest"]
_AMT_O = ["amount_equals_balance", "amount_is_round"]


@register("amount_features", _feat_subset(_AMT_D, _AMT_O))
def q_amount_features(spark, sf_dir):
    df = feat_ops.amount_features(feat_ops.balance_features(feat_ops.clean(spark, _tx(spark, sf_dir))))
    return round_doubles(df.select("tx_id", *_AMT_D, *_AMT_O))


_TMP_O = ["step", "hour_of_day", "day_of_month", "is_night", "is_weekend"]


@register("temporal_features", _feat_subset([], _TMP_O))
def q_temporal_features(spark, sf_dir):
    return feat_ops.temporal_features(_tx(spark, sf_dir)).select("tx_id", *_TMP_O)


_LOG_D = [f"log1p_{c}" for c in BALANCE_COLS]


@register("log_transforms", _feat_subset(_LOG_D, []))
def q_log_transforms(spark, sf_dir):
    df = feat_ops.log_transforms(feat_ops.balance_features(feat_ops.clean(spark, _tx(spark, sf_dir))))
    return round_doubles(df.select("tx_id", *_LOG_D))


_FEATURE_TABLE_SQL = with_features(f"SELECT {sel_round(FEAT_DOUBLES, FEAT_OTHER)} FROM feat")


@register("engineer", _FEATURE_TABLE_SQL)
def q_engineer(spark, sf_dir):
    return round_doubles(order_columns(feat_ops.engineer(feat_ops.clean(spark, _tx(spark, sf_dir)))))


@register("feature_table", _FEATURE_TABLE_SQL)
def q_feature_table(spark, sf_dir):
    return round_doubles(_features(spark, sf_dir))


# ---------------------------------------------------------------- D: profile
@register(
    "dataset_statistics",
    with_features(
        "SELECT count(*) AS n_samples, CAST(33 AS BIGINT) AS n_features, "
        f"{R('avg(isFraud)')} AS fraud_rate, count(*) FILTER (WHERE isFraud = 1) AS n_fraud, "
        "count(*) FILTER (WHERE isFraud = 0) AS n_legitimate FROM feat"
    ),
)
def q_dataset_statistics(spark, sf_dir):
    return round_doubles(profile.dataset_statistics(_profile_features(spark, sf_dir)))


@register(
    "class_balance",
    with_features(
        f"SELECT isFraud AS label, count(*) AS n, {R('count(*) / sum(count(*)) OVER ()')} AS share "
        "FROM feat GROUP BY isFraud"
    ),
)
def q_class_balance(spark, sf_dir):
    return round_doubles(profile.class_balance(_profile_features(spark, sf_dir)))


def _long_numeric(cols, source="feat", name="long_num", keys=()):
    casts = ", ".join([*keys, *(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)])
    on = ", ".join(cols)
    return f"{name} AS (SELECT * FROM (SELECT {casts} FROM {source}) UNPIVOT INCLUDE NULLS (x FOR feature IN ({on})))"


@register(
    "describe",
    with_features(
        f", {_long_numeric(NUMERIC_FEATURES)}\n"
        "SELECT feature, count(x) AS count, "
        f"{R('avg(x)', 4)} AS mean, {R('stddev_samp(x)', 4)} AS std, {R('min(x)')} AS min, "
        f"{R('quantile_cont(x, 0.25)')} AS q25, {R('quantile_cont(x, 0.5)')} AS q50, "
        f"{R('quantile_cont(x, 0.75)')} AS q75, {R('max(x)')} AS max FROM long_num GROUP BY feature"
    ),
)
def q_describe(spark, sf_dir):
    df = profile.describe(_features(spark, sf_dir), NUMERIC_FEATURES)
    return round_doubles(df, per_column={"mean": 4, "std": 4})


_ALL_FEAT = ["tx_id", *[c for c in FEAT_OTHER if c not in ("tx_id", "isFraud")], *FEAT_DOUBLES]


@register(
    "missing_counts",
    with_features(
        ", wide AS (SELECT "
        + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _ALL_FEAT)
        + " FROM feat)\n"
        + "SELECT feature, n_missing FROM wide UNPIVOT (n_missing FOR feature IN ("
        + ", ".join(_ALL_FEAT)
        + ")) WHERE n_missing > 0"
    ),
)
def q_missing_counts(spark, sf_dir):
    return profile.missing_counts(_features(spark, sf_dir), _ALL_FEAT)


@register("type_distribution", with_features("SELECT type, count(*) AS n FROM feat GROUP BY type"))
def q_type_distribution(spark, sf_dir):
    return profile.type_distribution(_profile_features(spark, sf_dir))


def _rate_sql(col, percent):
    rate = "avg(isFraud) * 100.0" if percent else "avg(isFraud)"
    return with_features(f"SELECT {col}, {R(rate)} AS fraud_rate, count(*) AS n FROM feat GROUP BY {col}")


@register("fraud_rate_by_type", _rate_sql("type", False))
def q_fraud_rate_by_type(spark, sf_dir):
    return round_doubles(profile.fraud_rate_by(_profile_features(spark, sf_dir), "type"))


@register("fraud_rate_by_hour", _rate_sql("hour_of_day", True))
def q_fraud_rate_by_hour(spark, sf_dir):
    return round_doubles(profile.fraud_rate_by(_profile_features(spark, sf_dir), "hour_of_day", percent=True))


@register("fraud_rate_by_day", _rate_sql("day_of_month", True))
def q_fraud_rate_by_day(spark, sf_dir):
    return round_doubles(profile.fraud_rate_by(_profile_features(spark, sf_dir), "day_of_month", percent=True))


@register(
    "fraud_rate_by_indicators",
    with_features(
        ", ind AS (SELECT * FROM (SELECT isFraud, "
        + ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in INDICATOR_COLS)
        + " FROM feat) UNPIVOT (value FOR indicator IN ("
        + ", ".join(INDICATOR_COLS)
        + ")))\n"
        + f"SELECT indicator, value, {R('avg(isFraud)')} AS fraud_rate, count(*) AS n FROM ind GROUP BY indicator, value"
    ),
)
def q_fraud_rate_by_indicators(spark, sf_dir):
    return round_doubles(profile.fraud_rate_by_indicators(_features(spark, sf_dir)))


# The columns and bin counts the exploratory analysis plots.
HIST_COLS = ["amount", "log1p_amount", "balance_change_orig", "balance_change_dest", "hour_of_day", "day_of_month"]
HIST_BINS = 50
CLASS_HIST_COLS = ["log1p_amount", "balance_change_orig", "emptied_account", "is_night"]
CLASS_HIST_BINS = 30


def _hist_sql(cols, bins, by=None):
    keys = f"{by}, " if by else ""
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    using = f"feature, {by}" if by else "feature"
    return with_features(
        f", long AS (SELECT * FROM (SELECT {keys}{casts} FROM feat) UNPIVOT (x FOR feature IN ({', '.join(cols)}))),\n"
        f"ranges AS (SELECT feature, {keys}min(x) AS lo, max(x) AS hi FROM long GROUP BY ALL),\n"
        f"binned AS (SELECT feature, {keys}CASE WHEN r.hi = r.lo THEN {bins // 2} "
        f"ELSE CAST(least(floor((x - r.lo) / (r.hi - r.lo) * {float(bins)}), {bins - 1}) AS INTEGER) END AS bin "
        f"FROM long JOIN ranges r USING ({using})),\n"
        f"counts AS (SELECT feature, {keys}bin, count(*) AS n FROM binned GROUP BY ALL),\n"
        f"grid AS (SELECT feature, {keys}lo, hi, CAST(b AS INTEGER) AS bin FROM ranges, range(0, {bins}) t(b))\n"
        f"SELECT feature, {keys}bin, {R(f'lo + (hi - lo) * bin / {float(bins)}')} AS bin_lo, "
        f"{R(f'lo + (hi - lo) * (bin + 1) / {float(bins)}')} AS bin_hi, coalesce(n, 0) AS n "
        f"FROM grid LEFT JOIN counts USING ({using}, bin)"
    )


@register("histogram", _hist_sql(HIST_COLS, HIST_BINS))
def q_histogram(spark, sf_dir):
    return round_doubles(profile.histogram(_features(spark, sf_dir), HIST_COLS, HIST_BINS))


@register("histogram_by_class", _hist_sql(CLASS_HIST_COLS, CLASS_HIST_BINS, by="isFraud"))
def q_histogram_by_class(spark, sf_dir):
    return round_doubles(profile.histogram(_features(spark, sf_dir), CLASS_HIST_COLS, CLASS_HIST_BINS, by="isFraud"))


QUANTILE_PROBS = [0.005, 0.01, 0.25, 0.5, 0.75, 0.99, 0.995]


def _quantiles_sql():
    plist = "[" + ", ".join(f"CAST({p} AS DOUBLE)" for p in QUANTILE_PROBS) + "]"
    return (
        f"WITH {tx_cte()}, {_long_numeric(TX_DOUBLES, 'tx')},\n"
        f"q AS (SELECT feature, quantile_cont(x, {plist}) AS qs FROM long_num GROUP BY feature),\n"
        f"u AS (SELECT feature, unnest({plist}) AS p, unnest(qs) AS v FROM q)\n"
        f"SELECT feature, p, {R('v')} AS value FROM u"
    )


@register("quantiles", _quantiles_sql())
def q_quantiles(spark, sf_dir):
    return round_doubles(profile.quantiles(_tx(spark, sf_dir), TX_DOUBLES, QUANTILE_PROBS))


# ---------------------------------------------------------------- B13/B14 on scored rows
@register(
    "risk_level",
    f"WITH s AS ({scored_sql('duckdb')}) SELECT id, CASE WHEN score > 0.7 THEN 'HIGH' "
    "WHEN score > 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM s",
)
def q_risk_level(spark, sf_dir):
    from txrisk.functions import risk_level

    return scored_events(spark, sf_dir).select("id", risk_level("score").alias("risk_level"))


@register(
    "decide",
    f"WITH s AS ({scored_sql('duckdb')}) SELECT id, CAST(coalesce(score >= 0.5, false) AS INTEGER) AS y_pred FROM s",
)
def q_decide(spark, sf_dir):
    from txrisk.functions import decide

    return scored_events(spark, sf_dir).select("id", decide("score", 0.5).alias("y_pred"))


# ---------------------------------------------------------------- E/G: splits and samples
from txrisk.operators import sampling  # noqa: E402

SEED = 42
TEST_SIZE = 0.2
VAL_SIZE = 0.15
SUBSAMPLE_N = 5000
SAMPLE_N = 10000
FOLDS = 5


def hash_sql(key: str = "tx_id", seed: int = SEED) -> str:
    return f"('0x' || substr(md5(concat_ws(':', '{seed}', CAST({key} AS VARCHAR))), 1, 15))::BIGINT"


def approx_mode_sql(src: str, cnt: str, draws: str, out: str) -> str:
    """CTE ``out``(isFraud, cnt, q): floor + largest remainder (ties: smaller label first).

    ``draws`` may use ``tot`` (the sum of ``cnt`` over all classes).
    """
    return f"""{out} AS (
  SELECT isFraud, {cnt}, CAST(fl AS BIGINT) + CASE WHEN rr <= need THEN 1 ELSE 0 END AS q FROM (
    SELECT *, row_number() OVER (ORDER BY cont - fl DESC, isFraud) AS rr,
           dr - sum(fl) OVER () AS need FROM (
      SELECT *, floor(cont) AS fl FROM (
        SELECT isFraud, {cnt}, dr, {cnt} * dr / tot AS cont FROM (
          SELECT isFraud, {cnt}, tot, {draws} AS dr FROM (
            SELECT isFraud, {cnt}, sum({cnt}) OVER () AS tot FROM {src}))))))"""


def split_ctes(src: str = "tx") -> str:
    val_ratio = f"(CAST({VAL_SIZE} AS DOUBLE) / (1 - CAST({TEST_SIZE} AS DOUBLE)))"
    return f""", hashed AS (SELECT tx_id, isFraud, {hash_sql()} AS h FROM {src}),
cnt AS (SELECT isFraud, count(*) AS n_c FROM hashed GROUP BY isFraud),
{approx_mode_sql('cnt', 'n_c', f'tot - ceil(CAST({TEST_SIZE} AS DOUBLE) * tot)', 'tr1')},
rest AS (SELECT isFraud, q AS n_r, n_c - q AS test_q FROM tr1),
{approx_mode_sql('rest', 'n_r', f'tot - ceil({val_ratio} * tot)', 'tr2')},
quota AS (SELECT r.isFraud, r.test_q, t.n_r - t.q AS val_q FROM rest r JOIN tr2 t USING (isFraud)),
ranked AS (SELECT tx_id, isFraud, row_number() OVER (PARTITION BY isFraud ORDER BY h, tx_id) AS rk FROM hashed),
splitted AS (
  SELECT tx_id, isFraud, CASE WHEN rk <= test_q THEN 'test' WHEN rk <= test_q + val_q THEN 'val' ELSE 'train' END AS split
  FROM ranked JOIN quota USING (isFraud))"""


def _split(spark, sf_dir):
    return sampling.stratified_split(_tx(spark, sf_dir).select("tx_id", "isFraud"), TEST_SIZE, VAL_SIZE, SEED)


@register("stratified_split", f"WITH {tx_cte()}{split_ctes()} SELECT tx_id, isFraud, split FROM splitted")
def q_stratified_split(spark, sf_dir):
    return _split(spark, sf_dir)


@register(
    "split_report",
    f"WITH {tx_cte()}{split_ctes()} SELECT split, count(*) AS n, count(*) FILTER (WHERE isFraud = 1) AS n_fraud, "
    f"{R('avg(isFraud)')} AS fraud_rate, {R('count(*) / sum(count(*)) OVER ()')} AS share FROM splitted GROUP BY split",
)
def q_split_report(spark, sf_dir):
    return round_doubles(sampling.split_report(_split(spark, sf_dir)))


@register(
    "union_splits",
    f"WITH {tx_cte()}{split_ctes()} SELECT tx_id, split FROM splitted WHERE split IN ('train', 'val')",
)
def q_union_splits(spark, sf_dir):
    return sampling.union_splits(_split(spark, sf_dir)).select("tx_id", "split")


HOLDOUT_SIZE = 0.15


@register(
    "holdout",
    f"""WITH {tx_cte()}{split_ctes()}, hashed2 AS (SELECT tx_id, isFraud, {hash_sql(seed=SEED + 1)} AS h FROM splitted WHERE split = 'train'),
cnt2 AS (SELECT isFraud, count(*) AS n_c FROM hashed2 GROUP BY isFraud),
{approx_mode_sql('cnt2', 'n_c', f'tot - ceil(CAST({HOLDOUT_SIZE} AS DOUBLE) * tot)', 'q2')},
ranked2 AS (SELECT tx_id, isFraud, row_number() OVER (PARTITION BY isFraud ORDER BY h, tx_id) AS rk FROM hashed2)
SELECT tx_id, isFraud, CASE WHEN rk <= n_c - q THEN 'holdout' ELSE 'fit' END AS part FROM ranked2 JOIN q2 USING (isFraud)""",
)
def q_holdout(spark, sf_dir):
    return sampling.holdout(_split(spark, sf_dir).filter(F.col("split") == "train").drop("split"), HOLDOUT_SIZE, SEED)


@register(
    "stratified_subsample",
    f"""WITH {tx_cte()}, hashed AS (SELECT tx_id, isFraud, {hash_sql()} AS h FROM tx),
cnt AS (SELECT isFraud, count(*) AS n_c FROM hashed GROUP BY isFraud),
{approx_mode_sql('cnt', 'n_c', str(SUBSAMPLE_N), 'qs')},
ranked AS (SELECT tx_id, isFraud, row_number() OVER (PARTITION BY isFraud ORDER BY h, tx_id) AS rk FROM hashed)
SELECT tx_id, isFraud FROM ranked JOIN qs USING (isFraud) WHERE rk <= q""",
)
def q_stratified_subsample(spark, sf_dir):
    return sampling.stratified_subsample(_tx(spark, sf_dir).select("tx_id", "isFraud"), SUBSAMPLE_N, SEED)


@register(
    "stratified_kfold",
    f"""WITH {tx_cte()}, hashed AS (SELECT tx_id, isFraud, {hash_sql()} AS h FROM tx),
cnt AS (SELECT isFraud, count(*) AS n_c, sum(count(*)) OVER (ORDER BY isFraud) - count(*) AS st FROM hashed GROUP BY isFraud),
alloc AS (
  SELECT isFraud, i AS fold,
         CASE WHEN st + n_c > st + ((i - st) % {FOLDS} + {FOLDS}) % {FOLDS}
              THEN (st + n_c - 1 - (st + ((i - st) % {FOLDS} + {FOLDS}) % {FOLDS})) // {FOLDS} + 1 ELSE 0 END AS n_f
  FROM cnt, range(0, {FOLDS}) t(i)),
ends AS (SELECT isFraud, fold, sum(n_f) OVER (PARTITION BY isFraud ORDER BY fold) AS e FROM alloc),
ranked AS (SELECT tx_id, isFraud, row_number() OVER (PARTITION BY isFraud ORDER BY h, tx_id) AS rk FROM hashed)
SELECT tx_id, isFraud, CAST(min(fold) AS INTEGER) AS fold FROM ranked JOIN ends USING (isFraud) WHERE rk <= e GROUP BY tx_id, isFraud""",
)
def q_stratified_kfold(spark, sf_dir):
    return sampling.stratified_kfold(_tx(spark, sf_dir).select("tx_id", "isFraud"), FOLDS, SEED)


@register(
    "sample_n",
    f"WITH {tx_cte()} SELECT tx_id FROM tx ORDER BY {hash_sql()}, tx_id LIMIT {SAMPLE_N}",
)
def q_sample_n(spark, sf_dir):
    return sampling.sample_n(_tx(spark, sf_dir).select("tx_id"), SAMPLE_N, SEED)


# ---------------------------------------------------------------- C: correlations
from txrisk.operators import correlation  # noqa: E402

# Key columns of the correlation overview and its sizes.
CORR_KEYS = ["amount", "balance_change_orig", "balance_change_dest", "inconsistent_orig", "inconsistent_dest"]
CORR_TOP_K = 8
CORR_LIMIT = 20
HIGH_CORR = 0.9
COLLINEAR = 0.95


def corr_ctes(cols) -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    pos = ", ".join(f"('{c}', {i})" for i, c in enumerate(cols))
    return f""", long_c AS (SELECT tx_id, feature, x FROM (SELECT tx_id, {casts} FROM feat)
  UNPIVOT INCLUDE NULLS (x FOR feature IN ({', '.join(cols)}))),
pos AS (SELECT feature, CAST(idx AS INTEGER) AS idx FROM (VALUES {pos}) t(feature, idx)),
cm AS (SELECT a.feature AS feature_i, b.feature AS feature_j, corr(a.x, b.x) AS r
       FROM long_c a JOIN long_c b USING (tx_id) GROUP BY ALL),
cmx AS (SELECT cm.feature_i, cm.feature_j, pi.idx AS i, pj.idx AS j,
               CASE WHEN r IS NULL OR isnan(r) THEN NULL ELSE greatest(-1.0, least(1.0, r)) END AS r
        FROM cm JOIN pos pi ON pi.feature = cm.feature_i JOIN pos pj ON pj.feature = cm.feature_j)"""


def _corr(spark, sf_dir, cols=NUMERIC_FEATURES):
    return correlation.correlation_matrix(_features(spark, sf_dir), list(cols))


@register(
    "correlation_matrix",
    with_features(f"{corr_ctes(NUMERIC_FEATURES)} SELECT feature_i, feature_j, i, j, {R('r')} AS r FROM cmx"),
)
def q_correlation_matrix(spark, sf_dir):
    return round_doubles(_corr(spark, sf_dir))


@register(
    "high_corr_pairs",
    with_features(
        f"{corr_ctes(NUMERIC_FEATURES)} SELECT feature_i, feature_j, {R('r')} AS r FROM cmx "
        f"WHERE i < j AND abs(r) > {HIGH_CORR}"
    ),
)
def q_high_corr_pairs(spark, sf_dir):
    return round_doubles(correlation.high_corr_pairs(_corr(spark, sf_dir), HIGH_CORR))


_KEYS_SQL = ", ".join(f"'{c}'" for c in CORR_KEYS)


@register(
    "top_correlated",
    with_features(
        f"""{corr_ctes(NUMERIC_FEATURES)},
ranked AS (SELECT feature_i, feature_j, j, row_number() OVER (PARTITION BY feature_i ORDER BY abs(r) DESC, j) AS rk
           FROM cmx WHERE feature_i IN ({_KEYS_SQL}) AND r IS NOT NULL),
picked AS (SELECT feature_j AS feature, j AS pos, min(rk) AS best_rank FROM ranked WHERE rk <= {CORR_TOP_K} GROUP BY ALL),
own AS (SELECT feature, idx AS pos, 0 AS best_rank FROM pos WHERE feature IN ({_KEYS_SQL})),
best AS (SELECT feature, pos, min(best_rank) AS best_rank FROM (SELECT * FROM picked UNION ALL SELECT * FROM own) GROUP BY ALL)
SELECT feature, CAST(best_rank AS INTEGER) AS best_rank FROM best ORDER BY best_rank, pos LIMIT {CORR_LIMIT}"""
    ),
)
def q_top_correlated(spark, sf_dir):
    return correlation.top_correlated(_corr(spark, sf_dir), CORR_KEYS, CORR_TOP_K, CORR_LIMIT)


@register(
    "drop_collinear",
    with_features(
        f"{corr_ctes(NUMERIC_FEATURES)} SELECT DISTINCT feature_j AS feature FROM cmx WHERE i < j AND abs(r) > {COLLINEAR}"
    ),
)
def q_drop_collinear(spark, sf_dir):
    df = _features(spark, sf_dir)
    _, dropped = correlation.drop_collinear(df, COLLINEAR)
    return spark.createDataFrame([(c,) for c in dropped], "feature string")


_TC_COLS = NUMERIC_FEATURES + ["isFraud"]


@register(
    "target_correlation",
    with_features(
        f"{corr_ctes(_TC_COLS)} SELECT feature_i AS feature, {R('r')} AS r, "
        f"CAST(row_number() OVER (ORDER BY r DESC NULLS LAST, i) AS INTEGER) AS position "
        f"FROM cmx WHERE feature_j = 'isFraud'"
    ),
)
def q_target_correlation(spark, sf_dir):
    return round_doubles(correlation.target_correlation(_features(spark, sf_dir), list(NUMERIC_FEATURES)))


# ---------------------------------------------------------------- J: evaluation of scored tables
from txrisk.operators import evaluation as ev  # noqa: E402

THRESHOLD = 0.5


def _scored(spark, sf_dir):
    return scored_events(spark, sf_dir)


def eval_ctes(threshold: float = THRESHOLD) -> str:
    return f"""WITH s AS ({scored_sql('duckdb')}),
g AS (SELECT score, CAST(sum(y_true) AS BIGINT) AS tp, CAST(count(*) - sum(y_true) AS BIGINT) AS fp FROM s GROUP BY score),
c AS (SELECT score, tp, fp,
        sum(tp) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ctp,
        sum(fp) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cfp,
        lead(tp) OVER (ORDER BY score DESC) AS ntp, lead(fp) OVER (ORDER BY score DESC) AS nfp,
        row_number() OVER (ORDER BY score DESC) AS rn, count(*) OVER () AS cnt,
        sum(tp) OVER () AS P, sum(fp) OVER () AS N FROM g),
rk AS (SELECT sum(fp * (ctp - tp / 2.0)) / (max(P) * max(N)) AS auc_roc,
              sum(tp * ctp / (ctp + cfp)) / max(P) AS auc_pr FROM c),
cmx AS (SELECT count(*) FILTER (WHERE y_true = 0 AND NOT coalesce(score >= {threshold}, false)) AS tn,
               count(*) FILTER (WHERE y_true = 0 AND coalesce(score >= {threshold}, false)) AS fp,
               count(*) FILTER (WHERE y_true = 1 AND NOT coalesce(score >= {threshold}, false)) AS fn,
               count(*) FILTER (WHERE y_true = 1 AND coalesce(score >= {threshold}, false)) AS tp FROM s),
th AS (SELECT CAST(i AS DOUBLE) / 100.0 AS threshold FROM range({ev.GRID_START}, {ev.GRID_END + 1}) t(i)),
sw AS (SELECT threshold, tp, fp, fn,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
         CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1
       FROM (SELECT threshold,
               count(*) FILTER (WHERE y_true = 1 AND score >= threshold) AS tp,
               count(*) FILTER (WHERE y_true = 0 AND score >= threshold) AS fp,
               count(*) FILTER (WHERE y_true = 1 AND NOT coalesce(score >= threshold, false)) AS fn
             FROM th, s GROUP BY threshold)),
best AS (SELECT threshold, f1 FROM sw ORDER BY f1 DESC, threshold ASC LIMIT 1),
mx AS (SELECT CAST(tp + tn AS DOUBLE) / (tn + fp + fn + tp) AS accuracy,
              CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
              CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
              CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1_score,
              tn, fp, fn, tp FROM cmx)"""


@register("confusion_matrix", eval_ctes() + " SELECT tn, fp, fn, tp FROM cmx")
def q_confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(_scored(spark, sf_dir), THRESHOLD)


@register("auc_roc", eval_ctes() + f" SELECT {R('auc_roc')} AS auc_roc FROM rk")
def q_auc_roc(spark, sf_dir):
    return round_doubles(spark.createDataFrame([(ev.auc_roc(_scored(spark, sf_dir)),)], "auc_roc double"))


@register("average_precision", eval_ctes() + f" SELECT {R('auc_pr')} AS average_precision FROM rk")
def q_average_precision(spark, sf_dir):
    return round_doubles(spark.createDataFrame([(ev.average_precision(_scored(spark, sf_dir)),)], "average_precision double"))


_METRICS_SELECT = (
    f"{R('accuracy')} AS accuracy, {R('precision')} AS precision, {R('recall')} AS recall, {R('f1_score')} AS f1_score, "
    f"{R('auc_roc')} AS auc_roc, {R('auc_pr')} AS auc_pr, tn AS true_negatives, fp AS false_positives, "
    "fn AS false_negatives, tp AS true_positives"
)


@register("classification_metrics", eval_ctes() + f" SELECT {_METRICS_SELECT} FROM mx, rk")
def q_classification_metrics(spark, sf_dir):
    return round_doubles(ev.classification_metrics(_scored(spark, sf_dir), THRESHOLD))


@register(
    "threshold_sweep",
    eval_ctes() + f" SELECT {R('threshold')} AS threshold, tp, fp, fn, {R('precision')} AS precision, "
    f"{R('recall')} AS recall, {R('f1')} AS f1 FROM sw",
)
def q_threshold_sweep(spark, sf_dir):
    return round_doubles(ev.threshold_sweep(_scored(spark, sf_dir)))


@register(
    "optimal_threshold",
    eval_ctes() + f" SELECT 'f1' AS metric, {R('threshold')} AS threshold, {R('f1')} AS value FROM best",
)
def q_optimal_threshold(spark, sf_dir):
    return round_doubles(ev.optimal_threshold(_scored(spark, sf_dir), "f1"))


@register(
    "roc_curve",
    eval_ctes()
    + f""" SELECT 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr, 'inf'::DOUBLE AS threshold
UNION ALL
SELECT {R('cfp / N')} AS fpr, {R('ctp / P')} AS tpr, {R('score')} AS threshold FROM c
WHERE rn = 1 OR rn = cnt OR ntp <> tp OR nfp <> fp""",
)
def q_roc_curve(spark, sf_dir):
    return round_doubles(ev.roc_curve(_scored(spark, sf_dir)))


@register(
    "pr_curve",
    eval_ctes()
    + f""" SELECT {R('ctp / P')} AS recall, {R('ctp / (ctp + cfp)')} AS precision, {R('score')} AS threshold FROM c
UNION ALL SELECT 0.0::DOUBLE, 1.0::DOUBLE, NULL::DOUBLE""",
)
def q_pr_curve(spark, sf_dir):
    return round_doubles(ev.pr_curve(_scored(spark, sf_dir)))


def _report_sql():
    def r4(e):
        return R(f"round({e}, 4)")

    return eval_ctes() + f""",
pc AS (SELECT tn, fp, fn, tp, tn + fp AS s0, tp + fn AS s1, tn + fp + fn + tp AS n,
  CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0,
  CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0,
  CASE WHEN 2 * tn + fn + fp > 0 THEN 2 * tn / (2 * tn + fn + fp) ELSE 0.0 END AS f0,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM cmx)
SELECT 'Legitimate' AS label, {r4('p0')} AS precision, {r4('r0')} AS recall, {r4('f0')} AS f1, s0 AS support FROM pc
UNION ALL SELECT 'Fraud', {r4('p1')}, {r4('r1')}, {r4('f1')}, s1 FROM pc
UNION ALL SELECT 'accuracy', NULL, NULL, {r4('CAST(tp + tn AS DOUBLE) / n')}, n FROM pc
UNION ALL SELECT 'macro avg', {r4('(p0 + p1) / 2')}, {r4('(r0 + r1) / 2')}, {r4('(f0 + f1) / 2')}, n FROM pc
UNION ALL SELECT 'weighted avg', {r4('(p0 * s0 + p1 * s1) / n')}, {r4('(r0 * s0 + r1 * s1) / n')}, {r4('(f0 * s0 + f1 * s1) / n')}, n FROM pc"""


@register("classification_report", _report_sql())
def q_classification_report(spark, sf_dir):
    return round_doubles(ev.classification_report(_scored(spark, sf_dir), THRESHOLD))


@register(
    "evaluate",
    eval_ctes()
    + f" SELECT {_METRICS_SELECT}, {R('best.threshold')} AS optimal_threshold, {R('best.f1')} AS optimal_f1_score, "
    f"{R(str(THRESHOLD))} AS threshold FROM mx, rk, best",
)
def q_evaluate(spark, sf_dir):
    return round_doubles(ev.evaluate(_scored(spark, sf_dir), THRESHOLD))


# ---------------------------------------------------------------- F/H1/A3: preprocessing, weights, params
from txrisk.operators import imbalance, preprocess  # noqa: E402
from txrisk.session import scratch_path  # noqa: E402
from txrisk.sources import params as params_io  # noqa: E402


def _split_features(spark, sf_dir):
    # Several passes follow (cut-offs, fits, transforms): write the feature table and its hash once.
    return sampling.stratified_split(_features(spark, sf_dir), TEST_SIZE, VAL_SIZE, SEED, write="split-features")


def _train_features(spark, sf_dir):
    return _split_features(spark, sf_dir).filter(F.col("split") == "train").drop("split")


def train_ctes() -> str:
    return f"""{split_ctes('feat')},
train AS (SELECT feat.* FROM feat JOIN splitted USING (tx_id, isFraud) WHERE split = 'train')"""


def _stats_ctes(scaler: str) -> str:
    if scaler == "standard":
        body = "avg(x) AS center, CASE WHEN stddev_pop(x) IS NULL OR stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS scale"
    else:
        iqr = "quantile_cont(x, 0.75) - quantile_cont(x, 0.25)"
        body = f"quantile_cont(x, 0.5) AS center, CASE WHEN ({iqr}) IS NULL OR ({iqr}) = 0 THEN 1.0 ELSE {iqr} END AS scale"
    return f"""{train_ctes()}, {_long_numeric(NUMERIC_FEATURES, 'train', 'train_long')},
stats AS (SELECT feature, {body} FROM train_long GROUP BY feature),
cats AS (SELECT type AS category, CAST(row_number() OVER (ORDER BY type) - 1 AS INTEGER) AS position
         FROM (SELECT DISTINCT type FROM train WHERE type IS NOT NULL))"""


def _scaler_sql(scaler: str) -> str:
    return with_features(f"{_stats_ctes(scaler)} SELECT feature, {R('center')} AS center, {R('scale')} AS scale FROM stats")


@register("standard_scale", _scaler_sql("standard"))
def q_standard_scale(spark, sf_dir):
    return round_doubles(preprocess.fit_standard(_train_features(spark, sf_dir), list(NUMERIC_FEATURES)))


@register("robust_scale", _scaler_sql("robust"))
def q_robust_scale(spark, sf_dir):
    return round_doubles(preprocess.fit_robust(_train_features(spark, sf_dir), list(NUMERIC_FEATURES)))


def _onehot_long(pre, df):
    cols = [c for c in pre.output_columns() if c not in pre.numerical]
    wide = df.select("tx_id", *preprocess.one_hot_columns(pre))
    return wide.unpivot(["tx_id"], cols, "feature", "value")


_ONEHOT_SQL = with_features(
    f"""{_stats_ctes('standard')}
SELECT tx_id, 'type_' || category AS feature, CAST(coalesce(feat.type = category, false) AS DOUBLE) AS value
FROM feat, cats WHERE position > 0"""
)


@register("one_hot", _ONEHOT_SQL)
def q_one_hot(spark, sf_dir):
    split = _split_features(spark, sf_dir)
    pre = preprocess.fit_preprocessor(split.filter(F.col("split") == "train"), numerical=[])
    return _onehot_long(pre, split)


_PREPROCESS_SQL = with_features(
    f"""{_stats_ctes('standard')}, {_long_numeric(NUMERIC_FEATURES, 'feat', 'all_long', keys=('tx_id',))}
SELECT tx_id, 'type_' || category AS feature, CAST(coalesce(feat.type = category, false) AS DOUBLE) AS value
FROM feat, cats WHERE position > 0
UNION ALL
SELECT tx_id, feature, {R('(x - center) / scale')} AS value FROM all_long JOIN stats USING (feature)"""
)


@register("preprocess", _PREPROCESS_SQL)
def q_preprocess(spark, sf_dir):
    split = _split_features(spark, sf_dir)
    pre = preprocess.fit_preprocessor(split.filter(F.col("split") == "train"), numerical=list(NUMERIC_FEATURES))
    out = preprocess.transform(pre, split)
    long = out.unpivot(["tx_id"], pre.output_columns(), "feature", "value")
    return round_doubles(long)


@register("params_roundtrip", _scaler_sql("standard"))
def q_params_roundtrip(spark, sf_dir):
    train = _train_features(spark, sf_dir)
    pre = preprocess.fit_preprocessor(train, numerical=list(NUMERIC_FEATURES))
    path = scratch_path(spark, "params")
    params_io.save_params(path, {"categories": pre.categories, "stats": pre.stats}, config={"scaler": pre.scaler})
    tables, cfg = params_io.load_params(spark, path, ("categories", "stats"), config=True)
    assert cfg == {"scaler": "standard"}
    return round_doubles(tables["stats"])


@register(
    "class_weights",
    with_features(
        f"{train_ctes()} SELECT isFraud AS label, count(*) AS n, "
        f"{R('sum(count(*)) OVER () / (count(*) OVER () * count(*))')} AS weight FROM train GROUP BY isFraud"
    ),
)
def q_class_weights(spark, sf_dir):
    return round_doubles(imbalance.class_weights(_train_features(spark, sf_dir)))


# ---------------------------------------------------------------- H2/H3: minority kNN and SMOTE
from txrisk.operators import knn as knn_ops  # noqa: E402

KNN_K = 5
SMOTE_RATIO = 0.3


def prep_ctes() -> str:
    """``prep_long``(tx_id, feature, value): standard-scaled features + one-hot, unrounded, NULL -> 0."""
    return f"""{_stats_ctes('standard')}, {_long_numeric(NUMERIC_FEATURES, 'feat', 'all_long', keys=('tx_id',))},
prep_long AS (
  SELECT tx_id, 'type_' || category AS feature, CAST(coalesce(feat.type = category, false) AS DOUBLE) AS value
  FROM feat, cats WHERE position > 0
  UNION ALL
  SELECT tx_id, feature, coalesce((x - center) / scale, 0.0) AS value FROM all_long JOIN stats USING (feature)),
mino AS (SELECT tx_id FROM splitted WHERE split = 'train' AND isFraud = 1),
ml AS (SELECT p.tx_id, p.feature, p.value FROM prep_long p JOIN mino USING (tx_id)),
pairs AS (SELECT a.tx_id AS id, b.tx_id AS nid, sum((a.value - b.value) * (a.value - b.value)) AS d2
          FROM ml a JOIN ml b ON a.feature = b.feature AND a.tx_id <> b.tx_id GROUP BY a.tx_id, b.tx_id),
knn AS (SELECT id, nid, d2, row_number() OVER (PARTITION BY id ORDER BY d2, nid) AS rank FROM pairs)"""


def _prepared_train(spark, sf_dir):
    split = _split_features(spark, sf_dir)
    train = split.filter(F.col("split") == "train")
    pre = preprocess.fit_preprocessor(train, numerical=list(NUMERIC_FEATURES))
    return preprocess.transform(pre, train), pre.output_columns()


@register(
    "minority_knn",
    with_features(
        f"{prep_ctes()} SELECT id, CAST(rank AS INTEGER) AS rank, nid AS neighbor_id, {R('sqrt(d2)')} AS distance "
        f"FROM knn WHERE rank <= {KNN_K}"
    ),
)
def q_minority_knn(spark, sf_dir):
    prepared, cols = _prepared_train(spark, sf_dir)
    minority = prepared.filter(F.col("isFraud") == 1)
    return round_doubles(knn_ops.minority_knn(minority, "tx_id", cols, k=KNN_K, seed=SEED))


def _u(tag: str) -> str:
    return (
        f"CAST(('0x' || substr(md5(concat_ws(':', '{SEED}', CAST(i AS VARCHAR), '{tag}')), 1, 8))::BIGINT AS DOUBLE)"
        " / CAST(4294967296.0 AS DOUBLE)"
    )


@register(
    "smote",
    with_features(
        f"""{prep_ctes()},
cls_cnt AS (SELECT count(*) FILTER (WHERE isFraud = 1) AS n_min, count(*) FILTER (WHERE isFraud = 0) AS n_maj
        FROM splitted WHERE split = 'train'),
midx AS (SELECT tx_id AS mid, row_number() OVER (ORDER BY {hash_sql()}, tx_id) - 1 AS idx FROM mino),
syn AS (SELECT i AS syn_id, CAST(floor({_u('sample')} * (n_min * {KNN_K})) AS BIGINT) AS pick, {_u('gap')} AS gap
        FROM cls_cnt, range(0, CAST(trunc(CAST({SMOTE_RATIO} AS DOUBLE) * n_maj - n_min) AS BIGINT)) t(i)),
syn2 AS (SELECT syn_id, pick // {KNN_K} AS idx, pick % {KNN_K} + 1 AS rank, gap FROM syn),
based AS (SELECT s.syn_id, s.gap, m.mid, k.nid FROM syn2 s JOIN midx m USING (idx) JOIN knn k ON k.id = m.mid AND k.rank = s.rank)
SELECT b.syn_id, a.feature, {R('a.value + b.gap * (n.value - a.value)')} AS value
FROM based b JOIN ml a ON a.tx_id = b.mid JOIN ml n ON n.tx_id = b.nid AND n.feature = a.feature"""
    ),
)
def q_smote(spark, sf_dir):
    prepared, cols = _prepared_train(spark, sf_dir)
    syn = imbalance.smote(prepared, "tx_id", cols, ratio=SMOTE_RATIO, k=KNN_K, seed=SEED)
    return round_doubles(syn.unpivot(["syn_id"], cols, "feature", "value"))


# ---------------------------------------------------------------- I/K: models, scoring, stream
from txrisk.operators import modeling  # noqa: E402
from txrisk.plans import training  # noqa: E402
from txrisk.sources import metrics_sink  # noqa: E402


def _prepared(spark, sf_dir, cfg=None):
    cfg = cfg or training.RunConfig()
    return training.prepare(spark, _features(spark, sf_dir), cfg), cfg


def _fitted(spark, sf_dir, cfg=None):
    prep, cfg = _prepared(spark, sf_dir, cfg)
    rows, wcol = training.rebalance(prep, cfg)
    return training.fit(prep, cfg, rows, wcol), prep, cfg


def _all_features(prep):
    """The run's written feature table, all splits together: the ledger is not joined and cleaned a second time."""
    return prep.raw.drop("split")


#: Fixed value: the reference's built-in number of epochs (its patience is the network's default).
FULL_EPOCHS = 50


@register("fit_classifier")
def q_fit_classifier(spark, sf_dir):
    """The whole training without validation, so all epochs are run."""
    model, prep, _ = _fitted(spark, sf_dir, training.RunConfig(params={"epochs": FULL_EPOCHS}))
    return modeling.scored_table(model, prep.test)


@register("score_batch")
def q_score_batch(spark, sf_dir):
    model, prep, cfg = _fitted(spark, sf_dir)
    return modeling.score_batch(model, preprocess.transform(prep.pre, _all_features(prep)), cfg.threshold)


def _contradictions(scored, threshold):
    """One row: scored rows, distinct keys, and rows whose decision or risk band contradicts their probability."""
    p = F.col("probability")
    band = F.when(p > 0.7, "HIGH").when(p > 0.3, "MEDIUM").otherwise("LOW")
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("tx_id").alias("n_keys"),
        F.count_if((p >= threshold).cast("int") != F.col("is_fraud").cast("int")).alias("wrong_decisions"),
        F.count_if(F.col("risk_level") != band).alias("wrong_bands"),
        F.count_if(p.isNull() | (p < 0) | (p > 1) | (F.col("threshold_used") != threshold)).alias("wrong_values"),
    )


_CONSISTENT = f"WITH {tx_cte()} SELECT count(*) AS n_rows, count(DISTINCT tx_id) AS n_keys, 0::BIGINT AS wrong_decisions, 0::BIGINT AS wrong_bands, 0::BIGINT AS wrong_values FROM tx"


@register("score_batch_consistency", _CONSISTENT)
def q_score_batch_consistency(spark, sf_dir):
    cfg = training.RunConfig(algo="logreg", use_smote=False, use_class_weights=True)
    model, prep, cfg = _fitted(spark, sf_dir, cfg)
    return _contradictions(modeling.score_batch(model, preprocess.transform(prep.pre, _all_features(prep)), cfg.threshold), cfg.threshold)


@register("training_history")
def q_training_history(spark, sf_dir):
    prep, cfg = _prepared(spark, sf_dir, training.RunConfig(params={"epochs": 10}))
    rows, wcol = training.rebalance(prep, cfg)
    return modeling.training_history(training.fit(prep, cfg, rows, wcol, val=prep.val))


@register("refit_on_train_val")
def q_refit_on_train_val(spark, sf_dir):
    """The whole training again on train and validation rows, so all epochs are run."""
    prep, cfg = _prepared(spark, sf_dir, training.RunConfig(params={"epochs": FULL_EPOCHS}))
    model, merged = training.refit_on_train_val(prep, cfg)
    return modeling.scored_table(model, merged.test)


@register("refit_statistics", _scaler_sql("standard").replace("WHERE split = 'train')", "WHERE split IN ('train', 'val'))"))
def q_refit_statistics(spark, sf_dir):
    """The scaler that belongs to the refitted model: statistics of training and validation rows together."""
    prep, cfg = _prepared(spark, sf_dir, training.RunConfig(use_smote=False, use_class_weights=True))
    _, merged = training.refit_on_train_val(prep, cfg)
    return round_doubles(merged.pre.stats)


@register("fit_with_validation")
def q_fit_with_validation(spark, sf_dir):
    prep, cfg = _prepared(spark, sf_dir, training.RunConfig(params={"epochs": FULL_EPOCHS}))
    rows, wcol = training.rebalance(prep, cfg)
    model = modeling.fit_with_validation(rows, prep.val, prep.cols, cfg.params, weight_col=wcol, seed=cfg.seed)
    return modeling.training_history(model)


@register("tune")
def q_tune(spark, sf_dir):
    from txrisk.operators import search

    # Scaler, categories and SMOTE are fitted inside the search, without its holdout.
    _, trials = search.tune(_train_features(spark, sf_dir), seed=SEED)
    return search.trials_frame(spark, trials)


def _relational_probability(spark, model, rows):
    """tx_id, p: the network as joins and sums over its exported weights, without any of its code."""
    weights = model.weights_table(spark).cache()
    part = lambda k, name: weights.where((F.col("layer") == k) & (F.col("part") == name))
    x = rows.select("tx_id", F.posexplode(F.array(*[F.coalesce(F.col(c), F.lit(0.0)) for c in model.cols])).alias("i", "x"))
    for k in range(len(model.cfg.hidden_layers) + 1):
        z = x.join(part(k, "kernel").select("i", "j", "value"), "i").groupBy("tx_id", "j").agg(F.sum(F.col("x") * F.col("value")).alias("z"))
        z = z.join(part(k, "bias").select("j", F.col("value").alias("bias")), "j").withColumn("z", F.col("z") + F.col("bias"))
        if k == len(model.cfg.hidden_layers):
            return z.select("tx_id", (1.0 / (1.0 + F.exp(-F.col("z")))).alias("p"))
        for name in ("gamma", "beta", "mean", "variance"):
            z = z.join(part(k, name).select("j", F.col("value").alias(name)), "j")
        normal = (F.greatest(F.col("z"), F.lit(0.0)) - F.col("mean")) / F.sqrt(F.col("variance") + 0.001) * F.col("gamma") + F.col("beta")
        x = z.select("tx_id", F.col("j").alias("i"), normal.alias("x"))


@register(
    "network_consistency",
    with_features(f"{split_ctes('feat')} SELECT count(*) AS n_rows, 0::BIGINT AS wrong_probabilities, true AS same_loss FROM splitted WHERE split = 'test'"),
)
def q_network_consistency(spark, sf_dir):
    """Test rows, those whose probability differs from the exported weights' by over 1e-9, and the two losses."""
    cfg = training.RunConfig(use_smote=False, use_class_weights=True, params={"hidden_layers": [16, 8], "epochs": 3})
    model, prep, _ = _fitted(spark, sf_dir, cfg)
    scored = modeling.scored_table(model, prep.test)
    both = scored.join(_relational_probability(spark, model, prep.test), F.col("id") == F.col("tx_id"))
    loss = lambda p: F.avg(F.when(F.col("y_true") == 1, -F.log(p)).otherwise(-F.log(1.0 - p)))
    out = both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs(F.col("score") - F.col("p")) > 1e-9).alias("wrong_probabilities"),
        loss(F.col("score")).alias("a"), loss(F.col("p")).alias("b"),
    )
    return out.select("n_rows", "wrong_probabilities", (F.abs(F.col("a") - F.col("b")) <= 1e-9 * F.greatest(F.lit(1.0), F.abs("b"))).alias("same_loss"))


def _differences(a, b):
    """Rows of a, keys of a, and rows whose probability in b is missing or differs by over 1e-9."""
    both = a.select("tx_id", F.col("probability").alias("p")).join(b.select("tx_id", F.col("probability").alias("q")), "tx_id", "left")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("tx_id").alias("n_keys"),
        F.count_if(F.coalesce(F.abs(F.col("p") - F.col("q")) > 1e-9, F.lit(True))).alias("differences"),
    )


_NO_DIFFERENCES = f"WITH {tx_cte()} SELECT count(*) AS n_rows, count(DISTINCT tx_id) AS n_keys, 0::BIGINT AS differences FROM tx"


@register("score_udf_consistency", _NO_DIFFERENCES)
def q_score_udf_consistency(spark, sf_dir):
    """K1: the exported bundle (scaler, categories, weights) on raw features against batch scoring, whole ledger."""
    model, prep, cfg = _fitted(spark, sf_dir, training.RunConfig(use_smote=False, use_class_weights=True))
    features = _all_features(prep)
    batch = modeling.score_batch(model, preprocess.transform(prep.pre, features), cfg.threshold)
    return _differences(features.select("tx_id", modeling.bundle_score(model, prep.pre, spark).alias("probability")), batch)


@register("score_stream_consistency", _NO_DIFFERENCES)
def q_score_stream_consistency(spark, sf_dir):
    """The stream's scores against batch scoring with the same stored parameters, whole ledger."""
    cfg = training.RunConfig(use_smote=False, use_class_weights=True)
    streamed, batch = _streamed(spark, sf_dir, cfg)
    return _differences(streamed, batch)


def _streamed(spark, sf_dir, cfg):
    """(scores of the stream, scores of the batch plan) by one fitted run."""
    from txrisk.operators.features import fit_outlier_bounds
    from txrisk.plans.feature_plan import build_features
    from txrisk.streaming.scoring import score_stream, scoring_frame

    ledger = _tx(spark, sf_dir)
    bounds = fit_outlier_bounds(spark, ledger)
    prep = training.prepare(spark, build_features(spark, ledger, bounds=bounds), cfg)
    rows, wcol = training.rebalance(prep, cfg)
    model = training.fit(prep, cfg, rows, wcol)
    # The whole ledger arrives as files; the stream scores every row with stored bounds and parameters.
    src, sink, ckpt = (scratch_path(spark, n) for n in ("stream-src", "stream-sink", "stream-ckpt"))
    ledger.write.parquet(src)
    q = score_stream(spark, src, sink, ckpt, bounds, prep.pre, model)
    q.awaitTermination()
    return spark.read.parquet(sink), scoring_frame(spark, spark.read.parquet(src), bounds, prep.pre, model)


@register("score_stream")
def q_score_stream(spark, sf_dir):
    return _streamed(spark, sf_dir, training.RunConfig())[0]


_UDF_COLS = ["log1p_amount", "inconsistent_orig", "emptied_account", "is_night"]
# Coefficients of the stand-in logistic model scored through the batch UDF.
_UDF_CENTER = [11.0, 0.5, 0.3, 0.25]
_UDF_SCALE = [1.5, 0.5, 0.45, 0.43]
_UDF_WEIGHTS = [0.8, 1.2, -0.7, 0.4]
_UDF_BIAS = -3.0


def _udf_sql():
    terms = " + ".join(
        f"coalesce((CAST({c} AS DOUBLE) - {m}) / {s}, 0.0) * {w}"
        for c, m, s, w in zip(_UDF_COLS, _UDF_CENTER, _UDF_SCALE, _UDF_WEIGHTS)
    )
    return with_features(f"SELECT tx_id, {R(f'1.0 / (1.0 + exp(-(({terms}) + ({_UDF_BIAS}))))')} AS score FROM feat")


@register("score_udf", _udf_sql())
def q_score_udf(spark, sf_dir):
    fn = modeling.logistic_predict_fn(_UDF_CENTER, _UDF_SCALE, _UDF_WEIGHTS, _UDF_BIAS)
    udf = modeling.score_udf(fn, len(_UDF_COLS))
    df = _features(spark, sf_dir)
    arr = F.array(*[F.col(c).cast("double") for c in _UDF_COLS])
    return round_doubles(df.select("tx_id", udf(arr).alias("score")))


_EVAL_METRICS = [
    "accuracy", "precision", "recall", "f1_score", "auc_roc", "auc_pr", "true_negatives", "false_positives",
    "false_negatives", "true_positives", "optimal_threshold", "optimal_f1_score", "threshold",
]


@register(
    "write_metrics",
    eval_ctes()
    + f""", er AS (SELECT CAST(accuracy AS DOUBLE) AS accuracy, CAST(precision AS DOUBLE) AS precision,
  CAST(recall AS DOUBLE) AS recall, CAST(f1_score AS DOUBLE) AS f1_score, CAST(auc_roc AS DOUBLE) AS auc_roc,
  CAST(auc_pr AS DOUBLE) AS auc_pr, CAST(tn AS DOUBLE) AS true_negatives, CAST(fp AS DOUBLE) AS false_positives,
  CAST(fn AS DOUBLE) AS false_negatives, CAST(tp AS DOUBLE) AS true_positives,
  CAST(best.threshold AS DOUBLE) AS optimal_threshold, CAST(best.f1 AS DOUBLE) AS optimal_f1_score,
  CAST({THRESHOLD} AS DOUBLE) AS threshold FROM mx, rk, best)
SELECT metric, {R('value')} AS value FROM er UNPIVOT (value FOR metric IN ({', '.join(_EVAL_METRICS)}))""",
)
def q_write_metrics(spark, sf_dir):
    metrics = ev.evaluate(_scored(spark, sf_dir), THRESHOLD)
    path = scratch_path(spark, "metrics")
    metrics_sink.write_metrics(metrics, path)
    back = spark.read.schema("metric string, value double").json(path)
    return round_doubles(back)


def _fingerprint_sql():
    parts = []
    for c in ["tx_id", "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest",
              "oldbalanceDest", "newbalanceDest", "isFraud"]:
        text = f"CAST({c} AS VARCHAR)"
        if c in TX_DOUBLES:
            dec = f"CAST({c} AS DECIMAL(38,6))"
            text = f"CAST({dec} AS VARCHAR) || '~' || CAST(CAST(floor(({c} - CAST({dec} AS DOUBLE)) * CAST(1152921504606846976 AS DOUBLE)) AS BIGINT) AS VARCHAR)"
        parts.append(f"coalesce(CAST(length({text}) AS VARCHAR) || ':' || {text}, '-')")
    half = lambda at: f"sum(CAST(('0x' || substr(h, {at}, 15))::BIGINT AS DECIMAL(38,0)))"
    return (
        f"WITH {tx_cte()}, rows_ AS (SELECT md5(concat_ws('|', {', '.join(parts)})) AS h FROM tx),\n"
        f"hs AS (SELECT count(*) AS n_rows, CAST({half(1)} AS DECIMAL(38,0)) AS hash_sum, CAST({half(17)} AS DECIMAL(38,0)) AS hash_sum2 FROM rows_)\n"
        "SELECT n_rows, hash_sum, hash_sum2, substr(md5(CAST(n_rows AS VARCHAR) || ':' || CAST(hash_sum AS VARCHAR) || ':' || CAST(hash_sum2 AS VARCHAR)), 1, 16) AS fingerprint FROM hs"
    )


@register("dataset_fingerprint", _fingerprint_sql())
def q_dataset_fingerprint(spark, sf_dir):
    return metrics_sink.dataset_fingerprint(_tx(spark, sf_dir))
