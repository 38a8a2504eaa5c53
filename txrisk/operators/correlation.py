"""Pearson correlations over column pairs.

Pairwise-complete moments for all k x k column pairs come from one
``mapInPandas`` pass (per Arrow batch: k x k matrix products of the value
and presence matrices, summed per partition) and one ``groupBy(i, j).sum``
over k^2 rows per partition. Values are shifted by each column's minimum
first, so a constant column gives an exact zero variance (NULL r) and large
magnitudes do not cancel. The driver only ever sees k^2 rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.operators.sampling import sample_n
from txrisk.schema import KEY, TARGET, numeric_columns

_MOMENT_FIELDS = ["n", "sx", "sy", "sxx", "syy", "sxy"]
MOMENT_SCHEMA = T.StructType(
    [T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType())]
    + [T.StructField(f, T.DoubleType()) for f in _MOMENT_FIELDS]
)


def _moments_fn(k: int, shift: np.ndarray):
    def run(batches):
        acc = None
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64", na_value=np.nan)
            m = ~np.isnan(x)
            xs = np.where(m, x - shift, 0.0)
            mf = m.astype("float64")
            part = (mf.T @ mf, xs.T @ mf, (xs * xs).T @ mf, xs.T @ xs)
            acc = part if acc is None else tuple(a + b for a, b in zip(acc, part))
        if acc is None:
            return
        n, sx, sxx, sxy = acc
        ii, jj = np.meshgrid(np.arange(k), np.arange(k), indexing="ij")
        yield pd.DataFrame(
            {
                "i": ii.ravel().astype("int32"),
                "j": jj.ravel().astype("int32"),
                "n": n.ravel(),
                "sx": sx.ravel(),  # sum of x_i where both present
                "sy": sx.T.ravel(),  # sum of x_j where both present
                "sxx": sxx.ravel(),
                "syy": sxx.T.ravel(),
                "sxy": sxy.ravel(),
            }
        )

    return run


def pairwise_moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy) summed over rows where both columns are non-null."""
    from txrisk.functions import chunked_aggregates
    from txrisk.plans.persist import passes_over

    k = len(cols)
    with passes_over(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])) as data:
        mins = chunked_aggregates(data, [{"m": F.min(c)} for c in data.columns])  # k rows
        shift = np.array([r["m"] if r["m"] is not None else 0.0 for r in mins], dtype="float64")
        parts = data.mapInPandas(_moments_fn(k, shift), MOMENT_SCHEMA)
        # Summed inside the block (k^2 rows), so the persisted input can be released afterwards.
        return _sum_moments(parts)


def _sum_moments(parts: DataFrame) -> DataFrame:
    """Sum the per-partition moments and bring the k^2 result rows into a local table."""
    spark = parts.sparkSession
    summed = parts.groupBy("i", "j").agg(*[F.sum(f).alias(f) for f in _MOMENT_FIELDS]).collect()  # k^2 rows
    return spark.createDataFrame(summed, MOMENT_SCHEMA)


def correlation_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Long table (feature_i, feature_j, r) over all ordered pairs, r NULL when undefined."""
    cols = cols or numeric_columns(df)
    spark = df.sparkSession
    mom = pairwise_moments(df, cols)
    names = spark.createDataFrame(list(enumerate(cols)), "idx int, name string")  # k rows
    n, sx, sy, sxx, syy, sxy = (F.col(c) for c in _MOMENT_FIELDS)
    cov = n * sxy - sx * sy
    vx = n * sxx - sx * sx
    vy = n * syy - sy * sy
    # pandas clips r into [-1, 1]; the clip stays inside the when (greatest/least skip NULLs)
    r = F.when((n >= 2) & (vx > 0) & (vy > 0), F.least(F.greatest(cov / F.sqrt(vx * vy), F.lit(-1.0)), F.lit(1.0)))
    ni = names.select(F.col("idx").alias("i"), F.col("name").alias("feature_i"))
    nj = names.select(F.col("idx").alias("j"), F.col("name").alias("feature_j"))
    return (
        mom.select("i", "j", r.alias("r"))
        .join(F.broadcast(ni), "i")
        .join(F.broadcast(nj), "j")
        .select("feature_i", "feature_j", "i", "j", "r")
    )


def high_corr_pairs(corr: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Pairs i < j (column order) with |r| > threshold."""
    return corr.filter((F.col("i") < F.col("j")) & (F.abs(F.col("r")) > threshold)).select("feature_i", "feature_j", "r")


def top_correlated(corr: DataFrame, keys: list[str], k: int = 8, limit: int = 20, min_columns: int = 20) -> DataFrame:
    """Per key column the k largest |r| (itself included), union, at most ``limit``.

    Applies only when there are more than ``min_columns`` columns; otherwise
    every column is kept. Output (feature, best_rank) ordered by best rank,
    then column order.
    """
    n_cols = corr.select("i").distinct().count()  # k rows
    names = corr.select(F.col("feature_i").alias("feature"), F.col("i").alias("pos")).distinct()
    if n_cols <= min_columns:
        return names.select("feature", F.lit(0).alias("best_rank"), "pos").orderBy("pos").drop("pos")
    w = Window.partitionBy("feature_i").orderBy(F.desc_nulls_last(F.abs(F.col("r"))), F.col("j"))
    ranked = (
        corr.filter(F.col("feature_i").isin(keys) & F.col("r").isNotNull())
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
    )
    picked = ranked.groupBy(F.col("feature_j").alias("feature"), F.col("j").alias("pos")).agg(F.min("rank").alias("best_rank"))
    own = names.filter(F.col("feature").isin(keys)).select("feature", F.lit(0).alias("best_rank"), "pos")
    best = picked.unionByName(own).groupBy("feature", "pos").agg(F.min("best_rank").alias("best_rank"))
    return best.orderBy("best_rank", "pos").limit(limit).select("feature", "best_rank")


def drop_collinear_columns(corr: DataFrame, cols: list[str], threshold: float = 0.95, exclude=()) -> list[str]:
    """C4 decision: j is dropped if some earlier column i has |r_ij| > threshold."""
    pairs = corr.filter((F.col("i") < F.col("j")) & (F.abs(F.col("r")) > threshold)).select("j").distinct().collect()
    hit = {int(r["j"]) for r in pairs}  # at most k rows
    return [c for idx, c in enumerate(cols) if idx in hit and c not in set(exclude)]


def drop_collinear(
    df: DataFrame, threshold: float = 0.95, sample_size: int | None = None, seed: int = 42, exclude=(), key: str = KEY
):
    """C4: (df without the collinear columns, list of dropped columns)."""
    cols = numeric_columns(df, exclude=(key, TARGET))
    if len(cols) < 2:
        return df, []
    basis = sample_n(df, sample_size, seed, key=key) if sample_size is not None else df
    corr = correlation_matrix(basis, cols)
    dropped = drop_collinear_columns(corr, cols, threshold, exclude)
    return df.drop(*dropped), dropped


def target_correlation(df: DataFrame, cols: list[str] | None = None, target: str = TARGET) -> DataFrame:
    """R of each numeric column (and the label itself) with the label, largest first."""
    cols = (cols or numeric_columns(df)) + [target]
    corr = correlation_matrix(df, cols)
    t = len(cols) - 1
    w = Window.orderBy(F.desc_nulls_last("r"), F.col("i"))  # k rows: one partition is fine
    return (
        corr.filter(F.col("j") == t)
        .select(F.col("feature_i").alias("feature"), "i", "r")
        .withColumn("position", F.row_number().over(w))
        .drop("i")
    )
