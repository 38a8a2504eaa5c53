"""Scoring a stream of transactions (I5) with Structured Streaming.

Incoming ledger files are read with ``readStream`` and a fixed schema,
cleaned and engineered with the *stored* winsor bounds (no fitting on the
stream), preprocessed with the stored parameter tables and scored by the
fitted model. The query is stateless (map-only), so it needs no
watermark; progress is kept in the checkpoint location, which makes
restarts exactly-once for the file sink.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from txrisk.operators import features as feat_ops
from txrisk.operators import modeling, preprocess
from txrisk.operators.network import DenseNetwork
from txrisk.plans.feature_plan import order_columns
from txrisk.schema import KEY, TRANSACTION_SCHEMA
from txrisk.sources.transactions import normalise_ledger


def scoring_frame(
    spark: SparkSession, ledger: DataFrame, bounds: DataFrame, pre: preprocess.Preprocessor,
    model: DenseNetwork | PipelineModel, threshold: float = 0.5, key: str = KEY,
) -> DataFrame:
    """The per-row scoring plan, valid for batch and streaming ledgers alike."""
    feats = order_columns(feat_ops.engineer(feat_ops.clean(spark, normalise_ledger(ledger), bounds=bounds)))
    prepared = preprocess.transform(pre, feats, passthrough=(key,))
    return modeling.score_batch(model, prepared, threshold, key=key)


def score_stream(
    spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str, bounds: DataFrame,
    pre: preprocess.Preprocessor, model: DenseNetwork | PipelineModel, threshold: float = 0.5, available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the scoring stream from parquet files in ``source_dir`` to parquet in ``sink_dir``."""
    reader = spark.readStream.schema(TRANSACTION_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    scored = scoring_frame(spark, stream, bounds, pre, model, threshold)
    writer = scored.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start(sink_dir)
