"""Distributed running sums and positions in a global order (building block P2).

A window without PARTITION BY moves every row into one task. Instead the
ordered table is cut into equal-frequency range buckets (edges from
``percentile_approx``; equal values never straddle an edge), each bucket
gets the totals of all buckets before it from a small table of at most
``MAX_BUCKETS`` rows, and the running sum runs per bucket.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 50_000
MIN_BUCKETS = 8
MAX_BUCKETS = 65_536


def descending_running_sums(
    df: DataFrame, order_col: str, sum_cols: list[str], lead_cols: list[str] = (), n_rows: int | None = None
) -> DataFrame:
    """Add ``cum_<c>`` (sum over rows with order_col >= this row's, inclusive, assuming unique
    order values) and ``next_<c>`` (value of the next row in descending order) columns.

    Also adds ``is_first`` / ``is_last`` flags of the global order.
    """
    n_rows = df.count() if n_rows is None else n_rows
    b = max(MIN_BUCKETS, min(MAX_BUCKETS, math.ceil(n_rows / ROWS_PER_BUCKET)))
    probs = [i / b for i in range(1, b)]
    edges = df.agg(F.percentile_approx(F.col(order_col).cast("double"), probs, max(10000, 4 * b)).alias("e")).first()["e"]
    inner = sorted({float(e) for e in (edges or []) if e > -math.inf}) or [0.0]  # Bucketizer needs at least three splits
    splits = [-math.inf] + inner + [math.inf]
    bucketed = Bucketizer(splits=splits, inputCol=order_col, outputCol="_bucket").transform(
        df.withColumn(order_col, F.col(order_col).cast("double"))
    )

    # One row per bucket (at most MAX_BUCKETS): totals, offsets and the head row of each bucket.
    head = F.max_by(F.struct(*[F.col(c) for c in lead_cols]), F.col(order_col)) if lead_cols else F.lit(None)
    per_bucket = bucketed.groupBy("_bucket").agg(
        *[F.sum(c).alias(f"_tot_{c}") for c in sum_cols], head.alias("_head")
    )
    wb = Window.orderBy(F.desc("_bucket"))  # small table: one partition is fine
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_bucket.select(
        "_bucket",
        *[F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
        F.lead("_head").over(wb).alias("_next_head"),
        (F.row_number().over(wb) == 1).alias("_first_bucket"),
        (F.lead("_bucket").over(wb).isNull()).alias("_last_bucket"),
    )

    w = Window.partitionBy("_bucket").orderBy(F.desc(order_col))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = bucketed.join(F.broadcast(per_bucket), "_bucket")
    out = joined.select(
        *df.columns,
        *[(F.col(f"_off_{c}") + F.sum(c).over(running)).alias(f"cum_{c}") for c in sum_cols],
        *[F.coalesce(F.lead(c).over(w), F.col("_next_head")[c]).alias(f"next_{c}") for c in lead_cols],
        (F.col("_first_bucket") & (F.row_number().over(w) == 1)).alias("is_first"),
        (F.col("_last_bucket") & F.lead(order_col).over(w).isNull()).alias("is_last"),
    )
    return out


def grouped_positions(df: DataFrame, group: str, order: list[str], out: str = "position", name: str = "positions") -> DataFrame:
    """``df`` with each row's 0-based position in its group, in ``order`` (nulls first).

    A range sort numbers the rows where they lie; a group's offsets in its partitions are sums over one row per
    partition, so a group of any size fills as many tasks as it needs. The sorted rows are written once.
    """
    from txrisk.plans.persist import materialize

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in [group, *order]]
    placed = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_nr", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("_part", F.shiftright("_nr", 33)), name)
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    runs = placed.groupBy(group, "_part").agg(F.min("_nr").alias("_head"), F.count(F.lit(1)).alias("_n"))
    runs = runs.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), (before - F.col("_head")).alias("_shift"))
    both = placed.join(runs, placed[group].eqNullSafe(runs["_g"]) & (placed["_part"] == runs["_p"]))
    return both.select(*df.columns, (F.col("_nr") + F.col("_shift")).alias(out))
