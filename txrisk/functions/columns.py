"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def flag(cond: Column) -> Column:
    """0/1 int flag; a NULL comparison counts as false (pandas: NaN compares False)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def nan_to_null(col) -> Column:
    """NaN -> NULL so that comparisons behave like pandas (Spark: NaN > x is true)."""
    return F.nanvl(_c(col), F.lit(None).cast("double"))


def safe_log1p(col) -> Column:
    """log1p for x > -1, NULL otherwise (pandas gives NaN / -inf there)."""
    c = _c(col)
    return F.when(c > -1, F.log1p(c))


def safe_ratio(num, den) -> Column:
    """num / den, NULL for a zero denominator instead of an ANSI error or inf."""
    return F.try_divide(_c(num), _c(den))


def decide(prob, threshold: float) -> Column:
    """Predicted class: probability >= threshold (NaN counts as not reaching it)."""
    return flag(nan_to_null(prob) >= F.lit(float(threshold)))


# Risk bands of the scorer (strict >).
RISK_HIGH = 0.7
RISK_MEDIUM = 0.3


def risk_level(prob) -> Column:
    p = nan_to_null(prob)  # Spark orders NaN above every number; the bands must not
    return (
        F.when(p > RISK_HIGH, F.lit("HIGH"))
        .when(p > RISK_MEDIUM, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def hash_key(seed, *parts) -> Column:
    """60-bit non-negative integer from md5('seed:part1:part2...').

    Deterministic per key and independent of partitioning; used as the
    random order of rows for exact, reproducible sampling.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def hash_uniform(seed, *parts) -> Column:
    """Uniform [0, 1) double from the first 8 hex digits of md5('seed:parts')."""
    text = F.concat_ws(":", F.lit(str(seed)), *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


#: Columns (or other items) whose aggregates are generated as one unit of code.
CHUNK_ITEMS = 12


def chunked_aggregates(df, items: list[dict[str, Column]], chunk: int = CHUNK_ITEMS) -> list:
    """One row of aggregates per item: items are dicts of the same names to aggregate expressions of the same types.

    Each chunk of items is an aggregate of its own over the columns it names, with partial sums per task in
    generated code, and all chunks run as one job; rows are never multiplied. The driver gets one row per item.
    """
    parts = []
    for a in range(0, len(items), chunk):
        some = items[a:a + chunk]
        row = df.agg(*[e.alias(f"{k}_{i}") for i, item in enumerate(some) for k, e in item.items()])
        packed = [F.struct(F.lit(a + i).alias("at"), *[F.col(f"{k}_{i}").alias(k) for k in item]) for i, item in enumerate(some)]
        parts.append(row.select(F.array(*packed).alias("items")))
    rows = reduce(lambda x, y: x.unionByName(y), parts).collect() if parts else []
    return sorted((x for r in rows for x in r["items"]), key=lambda x: x["at"])
