"""Profiling aggregates of the exploratory analysis.

All are single aggregates over the (cached) feature table that return small
tables. Group-wise rates use ``groupBy().agg`` so that Spark combines
partial aggregates map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.functions import chunked_aggregates
from txrisk.operators.quantiles import exact_quantiles
from txrisk.schema import INDICATOR_COLS, KEY, TARGET, numeric_columns, require_columns


def dataset_statistics(df: DataFrame, target: str = TARGET, key: str = KEY) -> DataFrame:
    """n_samples, n_features, fraud_rate, n_fraud, n_legitimate (one row)."""
    require_columns(df, [target])
    n_features = len([c for c in df.columns if c not in (target, key)])
    y = F.col(target)
    return df.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.lit(n_features).cast("long").alias("n_features"),
        F.avg(y.cast("double")).alias("fraud_rate"),
        F.count_if(y == 1).alias("n_fraud"),
        F.count_if(y == 0).alias("n_legitimate"),
    )


def class_balance(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows and share per class, largest class first."""
    counts = df.groupBy(F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    # The grouped table has one row per class: the total over it is tiny.
    total = F.sum("n").over(Window.partitionBy())
    return counts.select("label", "n", (F.col("n") / total).alias("share")).orderBy(F.desc("n"))


def describe(df: DataFrame, cols=None) -> DataFrame:
    """D3: pandas ``describe().T`` per numeric column (sample std, exact linear quartiles)."""
    from txrisk.plans.persist import passes_over

    cols = cols or numeric_columns(df)
    with passes_over(df.select(*cols)) as data:  # one stats pass + the quantile passes
        return _describe(data, cols)


def _describe(df: DataFrame, cols) -> DataFrame:
    spark = df.sparkSession
    x = [F.col(c).cast("double") for c in cols]
    stats = chunked_aggregates(df, [
        {"n": F.count(c), "m": F.avg(c), "s": F.stddev_samp(c), "lo": F.min(c), "hi": F.max(c)} for c in x
    ])  # one row per column
    counts = {c: int(r["n"]) for c, r in zip(cols, stats)}
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], counts=counts)
    rows = [(c, counts[c], r["m"], r["s"], r["lo"], q[(c, 0.25)], q[(c, 0.5)], q[(c, 0.75)], r["hi"]) for c, r in zip(cols, stats)]
    schema = T.StructType(
        [T.StructField("feature", T.StringType(), False), T.StructField("count", T.LongType(), False)]
        + [T.StructField(n, T.DoubleType(), True) for n in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    )
    return spark.createDataFrame(rows, schema)


def missing_counts(df: DataFrame, cols=None) -> DataFrame:
    """NULL count per column, only columns that have NULLs."""
    cols = cols or [c for c in df.columns if c != TARGET]
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot([], cols, "feature", "n_missing")
    return long.filter(F.col("n_missing") > 0)


def type_distribution(df: DataFrame, col: str = "type") -> DataFrame:
    """Rows per transaction type, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"))


def fraud_rate_by(df: DataFrame, col: str, percent: bool = False, target: str = TARGET) -> DataFrame:
    """Mean label per group (times 100 when ``percent``)."""
    rate = F.avg(F.col(target).cast("double"))
    if percent:
        rate = rate * 100.0
    return df.groupBy(col).agg(rate.alias("fraud_rate"), F.count(F.lit(1)).alias("n"))


def fraud_rate_by_indicators(df: DataFrame, indicators=INDICATOR_COLS, target: str = TARGET) -> DataFrame:
    """Mean label per value of each 0/1 indicator: one unpivot + one shuffle for all."""
    present = [c for c in indicators if c in df.columns]
    long = df.select(*[F.col(c).cast("int").alias(c) for c in present], F.col(target)).unpivot(
        [target], present, "indicator", "value"
    )
    return long.groupBy("indicator", "value").agg(
        F.avg(F.col(target).cast("double")).alias("fraud_rate"), F.count(F.lit(1)).alias("n")
    )


def _bin_expr(x, lo, hi, bins: int):
    """0-based equal-width bin of x in [lo, hi]; the maximum falls in the last bin."""
    raw = F.floor((x - lo) / (hi - lo) * F.lit(float(bins)))
    return F.when(hi == lo, F.lit(bins // 2)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, cols, bins: int = 50, by: str | None = None) -> DataFrame:
    """Equal-width histogram from min to max per column (and per ``by`` group).

    One min/max aggregate, then one grouped count of (column[, group], bin);
    every bin of the range is reported, empty ones with count 0.
    """
    spark = df.sparkSession
    keys = [by] if by else []
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(keys, list(cols), "feature", "x")
    long = long.filter(F.col("x").isNotNull())
    ranges = long.groupBy("feature", *keys).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    # ranges holds one row per column (and group): a size fixed by the schema and class count.
    binned = long.join(F.broadcast(ranges), ["feature", *keys]).select(
        "feature", *keys, _bin_expr(F.col("x"), F.col("lo"), F.col("hi"), bins).alias("bin")
    )
    counts = binned.groupBy("feature", *keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = ranges.select("feature", *keys, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counts, ["feature", *keys, "bin"], "left").select(
        "feature",
        *keys,
        "bin",
        (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bin") / F.lit(float(bins))).alias("bin_lo"),
        (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("bin") + 1) / F.lit(float(bins))).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"),
    )


def quantiles(df: DataFrame, cols, probs) -> DataFrame:
    """Exact linearly interpolated quantiles as (column, p, value)."""
    spark = df.sparkSession
    q = exact_quantiles(df, list(cols), list(probs))
    rows = [(c, float(p), q[(c, p)]) for c in cols for p in probs]
    schema = "feature string, p double, value double"
    return spark.createDataFrame(rows, schema)


def dtype_counts(df: DataFrame) -> DataFrame:
    """Number of columns per data type, read from the schema (no job)."""
    spark = df.sparkSession
    counts: dict[str, int] = {}
    for f in df.schema.fields:
        name = f.dataType.simpleString()
        counts[name] = counts.get(name, 0) + 1
    return spark.createDataFrame(sorted(counts.items()), "dtype string, n_columns long")
