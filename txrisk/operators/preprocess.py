"""Fit/transform preprocessing (F1-F4): one-hot encoding and scaling.

Fitting produces small parameter tables (categories per column, centre and
scale per column). Transforming reads them (their size is bounded by the
number of columns and categories, checked) and applies one projection with
literals: no join, no shuffle. Vectors are only built at the ML edge.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.functions import chunked_aggregates
from txrisk.operators.prefix import grouped_positions
from txrisk.operators.quantiles import exact_quantiles
from txrisk.plans.persist import materialize
from txrisk.schema import CATEGORICAL_FEATURES, KEY, TARGET, numeric_columns

SCALERS = ("standard", "robust")

CATEGORY_SCHEMA = "feature string, category string, position int"
STATS_SCHEMA = "feature string, center double, scale double"


@dataclass
class Preprocessor:
    categorical: list[str]
    numerical: list[str]
    scaler: str
    categories: DataFrame  # feature, category, position (sorted; position 0 is dropped)
    stats: DataFrame  # feature, center, scale

    def output_columns(self) -> list[str]:
        cats = self._categories()
        return [f"{c}_{v}" for c in self.categorical for v in cats.get(c, [])[1:]] + list(self.numerical)

    def _categories(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for r in sorted(self.categories.collect(), key=lambda r: (r["feature"], r["position"])):
            out.setdefault(r["feature"], []).append(r["category"])
        return out


def fit_categories(df: DataFrame, cols: list[str]) -> DataFrame:
    """F2 fit: distinct non-null categories per column, sorted ascending; any number of them."""
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], CATEGORY_SCHEMA)
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "feature", "category")
    found = long.where(F.col("category").isNotNull()).distinct()
    # A feature's categories are numbered across as many tasks as they fill.
    numbered = grouped_positions(found, "feature", ["category"], name="categories")
    return materialize(numbered.select("feature", "category", F.col("position").cast("int").alias("position")), "categories")


def _category_counts(pre: "Preprocessor") -> dict[str, int]:
    return {r["feature"]: r["n"] for r in pre.categories.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per column


def _with_positions(pre: "Preprocessor", df: DataFrame) -> DataFrame:
    """``df`` with ``_i0``, ``_i1``, ...: the position of each categorical value, null where it is unknown or NULL."""
    for k, c in enumerate(pre.categorical):
        own = pre.categories.where(F.col("feature") == c).select(F.col("category").alias(f"_c{k}"), F.col("position").alias(f"_i{k}"))
        df = df.join(own, F.col(c).cast("string") == F.col(f"_c{k}"), "left").drop(f"_c{k}")
    return df


def one_hot_sparse(pre: "Preprocessor", df: DataFrame) -> DataFrame:
    """``df`` with the one-hot block in sparse form: ``hot_size`` and the sorted ``hot_indices`` that are 1.

    The categories are joined, not spelled out, so their number may grow with the data. The first category of
    each column has no index, unknown and NULL values have none either.
    """
    widths, out, indices, base = _category_counts(pre), _with_positions(pre, df), [], 0
    for k, c in enumerate(pre.categorical):
        indices.append(F.when(F.col(f"_i{k}") > 0, F.col(f"_i{k}") - 1 + base))
        base += max(0, widths.get(c, 0) - 1)
    hot = F.array_compact(F.array(*indices)) if indices else F.array().cast("array<int>")
    return out.withColumn("hot_size", F.lit(base)).withColumn("hot_indices", hot).drop(*[f"_i{k}" for k in range(len(indices))])


def transform_sparse(pre: "Preprocessor", df: DataFrame, passthrough=(KEY, TARGET), out: str = "features") -> DataFrame:
    """F1/F2 with any number of categories: one ML vector per row, the one-hot block sparse, then the scaled numbers.

    The columns of the vector are those of :func:`transform`, in the same order. Categories are joined and the
    vectors are put together on the JVM: neither the plan nor the driver ever holds a category. Missing scaled
    numbers are 0, the scaled mean.
    """
    keep = [c for c in passthrough if c in df.columns]
    widths = _category_counts(pre)
    rows, blocks = _with_positions(pre, df), []
    for k, c in enumerate(pre.categorical):
        n = widths.get(c, 0)
        if n < 2:  # no column
            continue
        # The first category, unknown and missing values take the last place, which the encoder drops.
        place = F.when(F.col(f"_i{k}") > 0, F.col(f"_i{k}") - 1).otherwise(n - 1).cast("double")
        rows = rows.withColumn(f"_i{k}", place)
        # Fitted on the largest place alone, the encoder knows the size of the block.
        largest = df.sparkSession.createDataFrame([(float(n - 1),)], f"_i{k} double")
        encoder = OneHotEncoder(inputCols=[f"_i{k}"], outputCols=[f"_v{k}"], dropLast=True).fit(largest)
        rows = encoder.transform(rows)
        blocks.append(f"_v{k}")
    scaled = [F.coalesce(c, F.lit(0.0)).alias(f"_n{j}") for j, c in enumerate(scaled_columns(pre))]
    rows = rows.select(*keep, *blocks, *scaled)
    assembled = VectorAssembler(inputCols=[*blocks, *[f"_n{j}" for j in range(len(scaled))]], outputCol=out).transform(rows)
    return assembled.select(*keep, out)


def fit_standard(df: DataFrame, cols: list[str]) -> DataFrame:
    """F3 fit: mean and population std (NULLs ignored); std 0 -> 1."""
    if not cols:
        return df.sparkSession.createDataFrame([], STATS_SCHEMA)
    stats = chunked_aggregates(df, [{"m": F.avg(c), "s": F.stddev_pop(c)} for c in (F.col(name).cast("double") for name in cols)])
    rows = [(c, r["m"], 1.0 if (r["s"] is None or r["s"] == 0.0) else r["s"]) for c, r in zip(cols, stats)]
    return df.sparkSession.createDataFrame(rows, STATS_SCHEMA)


def fit_robust(df: DataFrame, cols: list[str]) -> DataFrame:
    """F4 fit: median and interquartile range (exact, linear); IQR 0 -> 1."""
    if not cols:
        return df.sparkSession.createDataFrame([], STATS_SCHEMA)
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    rows = []
    for c in cols:
        lo, med, hi = q[(c, 0.25)], q[(c, 0.5)], q[(c, 0.75)]
        iqr = None if lo is None else hi - lo
        rows.append((c, med, 1.0 if (iqr is None or iqr == 0.0) else iqr))
    return df.sparkSession.createDataFrame(rows, STATS_SCHEMA)


def fit_preprocessor(
    train: DataFrame, categorical=None, numerical=None, scaler: str = "standard", key: str = KEY, target: str = TARGET
) -> Preprocessor:
    """F1 fit on the training rows only."""
    if scaler not in SCALERS:
        raise ValueError(f"Unknown scaler: {scaler}")
    categorical = [c for c in (categorical if categorical is not None else CATEGORICAL_FEATURES) if c in train.columns]
    numerical = numerical if numerical is not None else [c for c in numeric_columns(train, exclude=(key, target))]
    cats = fit_categories(train, categorical)
    stats = (fit_standard if scaler == "standard" else fit_robust)(train, numerical)
    return Preprocessor(categorical, list(numerical), scaler, cats, stats)


def one_hot_columns(pre: Preprocessor) -> list:
    """``<col>_<category>`` for every category but the first; unknown/NULL -> all zeros."""
    cols = []
    for c, values in pre._categories().items():
        for v in values[1:]:
            cols.append(F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("double"), F.lit(0.0)).alias(f"{c}_{v}"))
    return cols


def scaled_columns(pre: Preprocessor) -> list:
    stats = {r["feature"]: (r["center"], r["scale"]) for r in pre.stats.collect()}  # one row per column
    out = []
    for c in pre.numerical:
        center, scale = stats[c]
        x = F.col(c).cast("double")
        out.append(((x - F.lit(center if center is not None else 0.0)) / F.lit(scale)).alias(c))
    return out


def transform(pre: Preprocessor, df: DataFrame, passthrough=(KEY, TARGET)) -> DataFrame:
    """F1 transform: categorical block, numeric block, then the passthrough columns."""
    keep = [c for c in passthrough if c in df.columns]
    return df.select(*one_hot_columns(pre), *scaled_columns(pre), *keep)


def with_features_vector(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Dense ML vector of ``cols``; NULL (e.g. log of a negative balance) becomes 0 = the scaled mean."""
    arr = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    return df.withColumn(out, array_to_vector(arr))
