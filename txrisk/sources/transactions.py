"""Transaction ledgers: file loader (A1), target check (A2) and the test-table mapping.

The mapping turns the driver's TPC-H-like tables into a ledger with the
schema of ``txrisk.schema.TRANSACTION_SCHEMA``. It is written once as SQL
text; only the day-difference function and the table references differ
between Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.functions import nan_to_null
from txrisk.plans.persist import materialize
from txrisk.schema import KEY, TARGET, TRANSACTION_SCHEMA, require_columns

_MAPPING_SQL = """
WITH first_line AS (
  SELECT l_orderkey, min(l_suppkey) AS first_suppkey
  FROM {lineitem}
  GROUP BY l_orderkey
),
base AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice,
         CAST(o.o_orderdate AS DATE) AS odate, o.o_orderpriority,
         c.c_acctbal, s.s_suppkey, s.s_acctbal
  FROM {orders} o
  JOIN {customer} c ON o.o_custkey = c.c_custkey
  LEFT JOIN first_line f ON f.l_orderkey = o.o_orderkey
  LEFT JOIN {supplier} s ON s.s_suppkey = f.first_suppkey
),
priced AS (
  SELECT *,
         CASE WHEN o_orderkey % 50 = 3 THEN -o_totalprice
              WHEN o_orderkey % 40 = 1 THEN floor(o_totalprice / 10000) * 10000.0
              ELSE o_totalprice END AS amount,
         c_acctbal * 50 AS old_orig,
         CASE WHEN o_orderkey % 30 = 0 THEN 0.0 * s_acctbal ELSE s_acctbal END AS old_dest
  FROM base
)
SELECT CAST(o_orderkey AS BIGINT) AS tx_id,
       CAST({days} * 24 + o_orderkey % 24 AS BIGINT) AS step,
       o_orderpriority AS type,
       CAST(amount AS DOUBLE) AS amount,
       'C' || CAST(o_custkey AS STRING) AS nameOrig,
       CAST(old_orig AS DOUBLE) AS oldbalanceOrg,
       CAST(CASE WHEN o_orderstatus = 'F' THEN old_orig - amount
                 WHEN o_orderstatus = 'O' THEN 0.0
                 ELSE old_orig END AS DOUBLE) AS newbalanceOrig,
       'M' || CAST(s_suppkey AS STRING) AS nameDest,
       CAST(old_dest AS DOUBLE) AS oldbalanceDest,
       CAST(CASE WHEN o_orderstatus IN ('F', 'O') THEN old_dest + amount
                 ELSE old_dest END AS DOUBLE) AS newbalanceDest,
       CAST(CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'
                  AND old_orig > 0 AND o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS INT) AS isFraud
FROM priced
"""

_TABLES = ("orders", "customer", "lineitem", "supplier")


def tpch_transactions_sql(dialect: str, sf_dir: str | None = None) -> str:
    """The mapping as SQL text for ``dialect`` in {"spark", "duckdb"}."""
    if dialect == "spark":
        days = "datediff(odate, DATE '1995-01-01')"
        tables = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in _TABLES}
    elif dialect == "duckdb":
        days = "date_diff('day', DATE '1995-01-01', odate)"
        tables = {t: t for t in _TABLES}
    else:
        raise ValueError(f"Unknown dialect: {dialect}")
    return _MAPPING_SQL.format(days=days, **tables)


def tpch_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger derived from orders/customer/lineitem/supplier of ``sf_dir``."""
    return spark.sql(tpch_transactions_sql("spark", sf_dir))


# Strings pandas.read_csv reads as missing by default.
PANDAS_NA_STRINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]


def normalise_ledger(df: DataFrame, schema: T.StructType = TRANSACTION_SCHEMA, na_strings: bool = False) -> DataFrame:
    """Cast to ``schema`` (extra columns pass through) and turn NaN, and with ``na_strings`` NA texts, into NULL."""
    cols = []
    wanted = {f.name: f.dataType for f in schema.fields}
    for name in df.columns:
        c = F.col(name)
        dtype = wanted.get(name)
        if dtype is not None:
            c = c.cast(dtype)
        actual = dtype or df.schema[name].dataType
        if isinstance(actual, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c)
        elif na_strings and isinstance(actual, T.StringType):
            c = F.when(~c.isin(PANDAS_NA_STRINGS), c)
        cols.append(c.alias(name))
    return df.select(*cols)


def load_transactions(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TRANSACTION_SCHEMA,
    fmt: str | None = None,
    derive_key: bool = True,
) -> DataFrame:
    """Read a ledger from parquet or CSV (A1).

    The format follows the suffix (case-insensitive) unless ``fmt`` is given,
    which also allows whole directories. Any other suffix is a ValueError.
    CSV columns are found by the names in the header, in any order; columns
    that the schema doesn't name stay as text. A ledger without the key column
    gets one from its rows' content (:func:`with_content_key`) unless
    ``derive_key`` is off.
    """
    if fmt is None:
        lower = str(path).lower().rstrip("/")
        if lower.endswith(".parquet"):
            fmt = "parquet"
        elif lower.endswith(".csv"):
            fmt = "csv"
        else:
            suffix = lower[lower.rfind("."):] if "." in lower.rsplit("/", 1)[-1] else ""
            raise ValueError(f"Ledgers are read from .parquet or .csv, not '{suffix}'")
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "csv":
        # The header gives the order, the schema the types: no inference pass; malformed numbers
        # become NULL (PERMISSIVE); files whose header differs from the first one's fail.
        types = {f.name: f.dataType for f in schema.fields}
        names = spark.read.option("header", True).csv(path).columns
        df = (
            spark.read.schema(T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names]))
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", "PERMISSIVE")
            .option("nanValue", "NaN")
            .csv(path)
        )
    else:
        raise ValueError(f"Ledgers are read as parquet or csv, not '{fmt}'")
    df = normalise_ledger(df, schema, na_strings=fmt == "csv")
    return with_content_key(df) if derive_key and KEY not in df.columns else df


def with_content_key(df: DataFrame, key: str = KEY) -> DataFrame:
    """``df`` with a text key from the md5 of each row's content and the number among its equals.

    Equal rows are interchangeable, so the keys do not depend on partitioning or file order. They are numbered
    where they lie, per partition of the ledger, and the counts of the partitions before are added, so that no
    task gets all rows of one content. The ledger is written first: counts and numbers see the same partitions.
    """
    parts = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in map(F.col, sorted(df.columns))]
    content = F.md5(F.concat_ws("|", *parts))
    place = ["_content", "_part"]
    placed = materialize(df.withColumn("_content", content).withColumn("_part", F.spark_partition_id()), "keyless")
    nth = F.row_number().over(Window.partitionBy(*place).orderBy("_content"))
    before = F.sum("_n").over(Window.partitionBy("_content").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = placed.groupBy(*place).agg(F.count(F.lit(1)).alias("_n")).select(*place, F.coalesce(before, F.lit(0)).alias("_before"))
    keyed = placed.withColumn("_nth", nth).join(counts, place)
    number = (F.col("_nth") + F.col("_before")).cast("string")
    return keyed.select(*df.columns, F.concat_ws("-", "_content", number).alias(key))


def extract_target(df: DataFrame, target_col: str = TARGET, key: str = KEY):
    """Split into (features, labels) (A2); both keep the row key.

    A missing target is a ValueError, raised when the plan is built.
    """
    if target_col not in df.columns:
        raise ValueError(f"The ledger has no label column '{target_col}'")
    require_columns(df, [key], "key column")
    return df.drop(target_col), df.select(key, target_col)
