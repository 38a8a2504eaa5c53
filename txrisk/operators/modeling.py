"""Model fitting and scoring.

The default model is the dense network of ``operators.network``. MLlib
estimators (distributed gradient aggregation per iteration) can take its
place: a multilayer perceptron, logistic regression or gradient boosted
trees. Options MLlib does not have (dropout, L2 or batch norm in the
perceptron, class weights with it) raise instead of being ignored. The
fitted artefact is a ``DenseNetwork``, or one ``PipelineModel`` (NULL
filling, vector assembly, classifier); both can be saved and loaded.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.functions import decide, risk_level
from txrisk.operators import network, preprocess
from txrisk.operators.network import DenseNetwork
from txrisk.schema import KEY, TARGET

ALGOS = ("dense", "mlp", "logreg", "gbt")
# Defaults of the reference training configuration.
DEFAULTS = {
    "hidden_layers": [256, 128, 64, 32],
    "epochs": 1,
    "batch_size": 512,
    "learning_rate": 0.001,
    "l2_reg": 0.001,
}
_MLP_UNSUPPORTED = ("dropout_rate", "l2_reg", "activation", "batch_norm")


def _quote(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _fill_stage(cols: list[str]) -> SQLTransformer:
    """NULL -> 0.0 for every feature (0 is the scaled mean); other columns pass through."""
    filled = ", ".join(f"coalesce(CAST({_quote(c)} AS DOUBLE), 0.0) AS {_quote('f__' + c)}" for c in cols)
    return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")


def _classifier(algo: str, params: dict, n_features: int, label: str, weight_col: str | None, seed: int):
    if algo not in ALGOS:
        raise ValueError(f"Unknown algorithm: {algo}")
    p = {**DEFAULTS, **params}
    if algo == "mlp":
        bad = [k for k in _MLP_UNSUPPORTED if k in params]
        if bad:
            raise ValueError(f"Options not supported by the perceptron: {bad}")
        if weight_col:
            raise ValueError("The perceptron has no row weights; use SMOTE or another algorithm")
        solver = params.get("solver", "l-bfgs")
        return MultilayerPerceptronClassifier(
            featuresCol="features", labelCol=label, layers=[n_features, *p["hidden_layers"], 2],
            maxIter=int(p["epochs"]), blockSize=int(p["batch_size"]), stepSize=float(p["learning_rate"]),
            solver=solver, seed=seed,
        )
    if algo == "logreg":
        kw = dict(featuresCol="features", labelCol=label, maxIter=int(params.get("epochs", 100)),
                  regParam=float(p["l2_reg"]), elasticNetParam=0.0)
        if weight_col:
            kw["weightCol"] = weight_col
        return LogisticRegression(**kw)
    kw = dict(featuresCol="features", labelCol=label, maxIter=int(params.get("epochs", 20)),
              maxDepth=int(params.get("max_depth", 5)), stepSize=float(params.get("learning_rate", 0.1)), seed=seed)
    if weight_col:
        kw["weightCol"] = weight_col
    if params.get("validation_col"):
        kw["validationIndicatorCol"] = params["validation_col"]
        kw["validationTol"] = float(params.get("validation_tol", 0.01))
    return GBTClassifier(**kw)


def fit_classifier(
    train: DataFrame, cols: list[str], algo: str = "dense", params: dict | None = None, label: str = TARGET,
    weight_col: str | None = None, seed: int = 42, val: DataFrame | None = None, key: str = KEY, state_dir: str | None = None,
) -> DenseNetwork | PipelineModel:
    """Fit on prepared rows; a network, or fill -> assemble -> classifier as one PipelineModel.

    ``val`` (early stopping) and ``state_dir`` (resumable training) are options of the network.
    """
    params = params or {}
    if algo == "dense":
        return network.fit_network(train, cols, params, val, label, weight_col, key, seed, state_dir)
    if val is not None or state_dir is not None:
        raise ValueError(f"{algo} is fitted without validation rows and saved states")
    est = _classifier(algo, params, len(cols), label, weight_col, seed)
    pipe = Pipeline(stages=[
        _fill_stage(cols),
        VectorAssembler(inputCols=["f__" + c for c in cols], outputCol="features"),
        est,
    ])
    data = train.withColumn(label, F.col(label).cast("double"))
    return pipe.fit(data)


def probability(model: DenseNetwork | PipelineModel, df: DataFrame) -> DataFrame:
    """Model output with a ``probability_fraud`` double column (class 1)."""
    if isinstance(model, DenseNetwork):
        return model.probability(df)
    out = model.transform(df)
    return out.withColumn("probability_fraud", vector_to_array(F.col("probability"))[1])


def score_batch(model: DenseNetwork | PipelineModel, df: DataFrame, threshold: float = 0.5, key: str = KEY) -> DataFrame:
    """I4: key, probability, is_fraud (p >= threshold), risk_level, threshold_used. Map-only."""
    scored = probability(model, df)
    p = F.col("probability_fraud")
    return scored.select(
        F.col(key), p.alias("probability"), decide(p, threshold).alias("is_fraud"),
        risk_level(p).alias("risk_level"), F.lit(float(threshold)).alias("threshold_used"),
    )


def scored_table(model: DenseNetwork | PipelineModel, df: DataFrame, key: str = KEY, label: str = TARGET) -> DataFrame:
    """(id, y_true, score): the input of every evaluation operator."""
    return probability(model, df).select(
        F.col(key).alias("id"), F.col(label).cast("int").alias("y_true"), F.col("probability_fraud").alias("score")
    )


def training_history(model: DenseNetwork | PipelineModel) -> DataFrame:
    """Loss, average precision and AUC of training and validation per epoch; MLlib models keep the loss only."""
    from pyspark.sql import SparkSession

    if isinstance(model, DenseNetwork):
        return model.history_table(SparkSession.active())
    clf = model.stages[-1]
    if not clf.hasSummary:
        raise ValueError(f"{type(clf).__name__} keeps no training summary")
    summary = clf.summary() if callable(clf.summary) else clf.summary  # a method in some versions
    hist = list(summary.objectiveHistory)
    return SparkSession.active().createDataFrame([(i, float(v)) for i, v in enumerate(hist)], "iteration int, loss double")


def fit_with_validation(
    train: DataFrame, val: DataFrame, cols: list[str], params: dict | None = None, label: str = TARGET, key: str = KEY,
    weight_col: str | None = None, seed: int = 42, state_dir: str | None = None,
) -> DenseNetwork:
    """Train while the validation average precision improves; the best epoch's weights are restored."""
    return network.fit_network(train, cols, params, val, label, weight_col, key, seed, state_dir)


# ---------------------------------------------------------------- K1: foreign models as batch UDFs
def logistic_predict_fn(center, scale, weights, bias):
    """make_predict_fn for predict_batch_udf: scaling + logistic model, loaded once per worker."""
    c = np.asarray(center, dtype="float64")
    s = np.asarray(scale, dtype="float64")
    w = np.asarray(weights, dtype="float64")

    def make():
        def predict(x: np.ndarray) -> np.ndarray:
            z = np.nan_to_num((x - c) / s, nan=0.0) @ w + bias
            return 1.0 / (1.0 + np.exp(-z))

        return predict

    return make


def score_udf(make_predict_fn, n_features: int, batch_size: int = 4096):
    """K1: Arrow-batched scoring UDF over an array<double> of features."""
    return predict_batch_udf(
        make_predict_fn, return_type=T.DoubleType(), batch_size=batch_size, input_tensor_shapes=[[n_features]]
    )


def bundle_score(model: DenseNetwork, pre: "preprocess.Preprocessor", spark) -> Column:
    """K1: probability of raw (unscaled, uncategorised) feature rows by one exported bundle.

    Centres, scales, categories and weights go to the executors in one broadcast of bounded size (columns,
    categories and weights), are unpacked once per worker, and Arrow batches are scored by matrix products.
    Missing numbers count as the scaled mean, unknown and missing categories as none.
    """
    import pandas as pd

    stats = {r["feature"]: (r["center"], r["scale"]) for r in pre.stats.collect()}  # one row per column
    center = np.array([stats[c][0] if stats[c][0] is not None else 0.0 for c in pre.numerical])
    scale = np.array([stats[c][1] for c in pre.numerical])
    known = pre._categories()
    codes = [{v: k for k, v in enumerate(known.get(c, [])[1:])} for c in pre.categorical]
    if pre.output_columns() != model.cols:
        raise ValueError("the model was fitted on other columns than the preprocessor gives")
    shared = spark.sparkContext.broadcast((center, scale, codes, model.cfg, model.theta, model.stats, model.cols))

    def score(batches):
        center, scale, codes, cfg, theta, stats, cols = shared.value
        net = DenseNetwork(cols, cfg, theta, stats)
        for rows in batches:
            x = np.vstack(rows["x"].to_numpy()).astype(float) if len(rows) else np.zeros((0, len(center)))
            parts = []
            for k, code in enumerate(codes):
                hot = np.zeros((len(rows), len(code)))
                at = np.array([code.get(v, -1) for v in rows[f"c{k}"]], dtype=int)
                known = np.flatnonzero(at >= 0)
                hot[known, at[known]] = 1.0
                parts.append(hot)
            yield pd.Series(net.probabilities(np.hstack([*parts, np.nan_to_num((x - center) / scale, nan=0.0)])))

    numbers = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in pre.numerical])
    categories = [F.col(c).cast("string").alias(f"c{k}") for k, c in enumerate(pre.categorical)]
    udf = F.pandas_udf(score, T.DoubleType(), F.PandasUDFType.SCALAR_ITER)
    return udf(F.struct(numbers.alias("x"), *categories))
