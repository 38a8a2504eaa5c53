"""Persisted fitted state (A3): parameter tables, config and the fitted model.

Everything is written below one directory (on a cluster: a shared
filesystem path, e.g. under ``spark.checkpoint.dir``). Loading checks every
expected part first and reports all missing ones together.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from txrisk.operators.network import DenseNetwork

PARAM_TABLES = ("bounds", "categories", "stats")


def save_params(path: str, tables: dict[str, DataFrame], config: dict | None = None, model=None) -> None:
    spark = next(iter(tables.values())).sparkSession if tables else None
    for name, df in tables.items():
        df.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")
    if config is not None and spark is not None:
        spark.createDataFrame([(json.dumps(config, sort_keys=True),)], "config string").coalesce(1).write.mode(
            "overwrite"
        ).json(f"{path}/config")
    if isinstance(model, DenseNetwork):
        model.save(SparkSession.active(), f"{path}/model")
    elif model is not None:
        model.write().overwrite().save(f"{path}/model")


def load_params(spark: SparkSession, path: str, tables=PARAM_TABLES, config: bool = False):
    """(tables dict, config dict or None). Missing parts -> one FileNotFoundError naming all."""
    found, missing = {}, []
    for name in tables:
        try:
            found[name] = spark.read.parquet(f"{path}/{name}")
        except AnalysisException:
            missing.append(name)
    cfg = None
    if config:
        try:
            cfg = json.loads(spark.read.json(f"{path}/config").first()["config"])
        except AnalysisException:
            missing.append("config")
    if missing:
        raise FileNotFoundError(f"Missing artifacts in {path}: {missing}")
    return found, cfg


def load_all(spark: SparkSession, path: str):
    """(tables, config, model); the error of a missing part names every missing one, the model too."""
    missing = []
    tables, config, model = {}, None, None
    try:
        tables, config = load_params(spark, path, config=True)
    except FileNotFoundError as e:
        missing.append(str(e))
    try:
        model = load_model(path)
    except FileNotFoundError as e:
        missing.append(str(e))
    if missing:
        raise FileNotFoundError("; ".join(missing))
    return tables, config, model


def load_model(path: str):
    from py4j.protocol import Py4JJavaError
    from pyspark.ml import PipelineModel

    try:
        return DenseNetwork.load(SparkSession.active(), f"{path}/model")
    except AnalysisException:  # no network there: a pipeline, or nothing
        pass
    try:
        return PipelineModel.load(f"{path}/model")
    except (AnalysisException, Py4JJavaError) as e:
        if "Path does not exist" not in str(e) and "Input path does not exist" not in str(e) and "PATH_NOT_FOUND" not in str(e):
            raise
        raise FileNotFoundError(f"Missing artifacts in {path}: ['model']") from e
