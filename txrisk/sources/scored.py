"""Scored tables (id, y_true, score) derived from the driver's ``events`` table.

This is the input shape of every evaluation operator; any model output
with a key, a 0/1 label and a probability has it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCORED_SQL = """
SELECT CAST(event_id AS BIGINT) AS id,
       CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INT) AS y_true,
       (value + 40.0 * CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)
         / (value + 40.0 * CASE WHEN event_type = 'error' THEN 1 ELSE 0 END + 50.0) AS score
FROM {events}
"""


def scored_sql(dialect: str, sf_dir: str | None = None) -> str:
    events = f"parquet.`{sf_dir}/events.parquet`" if dialect == "spark" else "events"
    return SCORED_SQL.format(events=events)


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    y = F.when(F.col("event_type") == "error", F.lit(1)).otherwise(F.lit(0))
    v = F.col("value") + F.lit(40.0) * y
    return ev.select(
        F.col("event_id").cast("long").alias("id"),
        y.cast("int").alias("y_true"),
        (v / (v + F.lit(50.0))).alias("score"),
    )
