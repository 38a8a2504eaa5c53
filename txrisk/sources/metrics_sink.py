"""Metric sink (A4) and data-version fingerprint (A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def metrics_long(metrics: DataFrame, run_id: str | None = None) -> DataFrame:
    """One-row metrics -> (metric, value) rows of its numeric columns."""
    num = [f.name for f in metrics.schema.fields if isinstance(f.dataType, (T.DoubleType, T.LongType, T.IntegerType))]
    long = metrics.select(*[F.col(c).cast("double").alias(c) for c in num]).unpivot([], num, "metric", "value")
    return long if run_id is None else long.withColumn("run_id", F.lit(run_id))


def write_metrics(metrics: DataFrame, path: str, run_id: str | None = None) -> None:
    """Append the run's metrics as JSON lines (one small file per run)."""
    metrics_long(metrics, run_id).coalesce(1).write.mode("append").json(path)


NULL_MARK = "-"


def _canonical(df: DataFrame, name: str):
    dt = df.schema[name].dataType
    c = F.col(name)
    text = c.cast("string")
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        # Six decimals, and what they leave in steps of 2^-60: no digit is dropped, in any engine's notation.
        dec = c.cast("decimal(38,6)")
        rest = F.floor((c.cast("double") - dec.cast("double")) * F.lit(float(2**60))).cast("long")
        text = F.concat(dec.cast("string"), F.lit("~"), rest.cast("string"))
    # With its length, so that no two rows share a text.
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(NULL_MARK))


def dataset_fingerprint(df: DataFrame) -> DataFrame:
    """A5: order-insensitive content hash: (n_rows, hash_sum, hash_sum2, fingerprint).

    Two 60-bit halves of each row's md5 over the lengths and texts of its values are summed, partially and then
    finally: the same rows in any order or partitioning give the same fingerprint.
    """
    row_text = F.concat_ws("|", *[_canonical(df, c) for c in df.columns])
    rows = df.select(F.md5(row_text).alias("h"))

    def half(at):
        h = F.conv(F.substring("h", at, 15), 16, 10).cast("decimal(38,0)")
        return F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)")

    agg = rows.agg(F.count(F.lit(1)).alias("n_rows"), half(1).alias("hash_sum"), half(17).alias("hash_sum2"))
    text = F.concat_ws(":", *[F.col(c).cast("string") for c in ("n_rows", "hash_sum", "hash_sum2")])
    return agg.select("n_rows", "hash_sum", "hash_sum2", F.substring(F.md5(text), 1, 16).alias("fingerprint"))
