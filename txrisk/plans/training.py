"""Training run: features -> split -> preprocess -> rebalance -> fit -> evaluate -> refit -> save.

Every step is a Spark job over the whole ledger; the driver only holds
parameter tables and metric rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.operators import evaluation, imbalance, modeling, preprocess, sampling, search
from txrisk.operators.correlation import drop_collinear
from txrisk.operators.features import fit_outlier_bounds
from txrisk.plans.feature_plan import build_features
from txrisk.plans.persist import materialize
from txrisk.schema import KEY, TARGET


@dataclass
class RunConfig:
    test_size: float = 0.2
    val_size: float = 0.15
    seed: int = 42
    scaler: str = "standard"
    use_smote: bool = True
    smote_ratio: float = 0.3
    use_class_weights: bool = False
    algo: str = "dense"
    params: dict | None = None
    drop_collinear: bool = False
    corr_threshold: float = 0.95
    corr_sample_size: int | None = None
    corr_exclude: tuple[str, ...] = ()
    threshold: float = 0.5
    tune: bool = False
    tune_options: dict | None = None


@dataclass
class Prepared:
    pre: preprocess.Preprocessor
    cols: list[str]
    train: DataFrame
    val: DataFrame
    test: DataFrame
    raw: DataFrame  # features with their split, before preprocessing


def prepare(spark: SparkSession, features: DataFrame, cfg: RunConfig) -> Prepared:
    if cfg.use_smote and cfg.use_class_weights:
        raise ValueError("SMOTE and class weights cannot be used together")
    # Many passes follow (correlations, split cut-offs, fits, transforms, SMOTE): write the feature table once;
    # the split itself is then a cheap projection over the written table and its stored hash.
    if cfg.drop_collinear:
        features, _ = drop_collinear(materialize(features, "features"), cfg.corr_threshold, cfg.corr_sample_size, cfg.seed, cfg.corr_exclude)
    return _fitted_splits(sampling.stratified_split(features, cfg.test_size, cfg.val_size, cfg.seed, write="split-features"), cfg)


def _fitted_splits(split: DataFrame, cfg: RunConfig) -> Prepared:
    train_raw = split.filter(F.col("split") == "train").drop("split")
    pre = preprocess.fit_preprocessor(train_raw, scaler=cfg.scaler)
    cols = pre.output_columns()

    def part(name):
        return preprocess.transform(pre, split.filter(F.col("split") == name)).persist(StorageLevel.MEMORY_AND_DISK)

    return Prepared(pre, cols, part("train"), part("val"), part("test"), split)


def with_scaler(prep: Prepared, cfg: RunConfig) -> Prepared:
    """The same splits under the scaler of ``cfg``."""
    if prep.pre.scaler == cfg.scaler:
        return prep
    release(prep)
    return _fitted_splits(prep.raw, cfg)


def release(prep: Prepared, *more: DataFrame) -> None:
    """Let go of the persisted splits and other rows of a run."""
    for df in (prep.train, prep.val, prep.test, *more):
        df.unpersist(blocking=False)


def rebalance(prep: Prepared, cfg: RunConfig):
    """(training rows, weight column or None) after SMOTE or class weights."""
    if cfg.use_smote:
        # The fit makes several passes: keep the oversampled rows instead of re-running kNN + SMOTE.
        rows = imbalance.oversample(prep.train, KEY, prep.cols, ratio=cfg.smote_ratio, seed=cfg.seed)
        return rows.persist(StorageLevel.MEMORY_AND_DISK), None
    if cfg.use_class_weights:
        w = imbalance.class_weights(prep.train)
        return imbalance.with_class_weights(prep.train, w), "weight"
    return prep.train, None


def fit(prep: Prepared, cfg: RunConfig, rows: DataFrame | None = None, weight_col: str | None = None, val: DataFrame | None = None, state_dir: str | None = None):
    """The configured model on ``rows`` (default: the training rows); with ``val`` it stops early."""
    rows = rows if rows is not None else prep.train
    return modeling.fit_classifier(rows, prep.cols, cfg.algo, cfg.params or {}, weight_col=weight_col, seed=cfg.seed, val=val, state_dir=state_dir)


def tuned(prep: Prepared, cfg: RunConfig) -> RunConfig:
    """``cfg`` with the options that the search over the training rows finds best."""
    best, _ = search.tune(prep.raw.filter(F.col("split") == "train").drop("split"), seed=cfg.seed, **(cfg.tune_options or {}))
    own = ("scaler", "use_smote", "smote_ratio")
    params = {**(cfg.params or {}), **{k: v for k, v in best.items() if k not in own}}
    weights = cfg.use_class_weights and not best["use_smote"]
    return replace(cfg, params=params, use_class_weights=weights, tune=False, **{k: best[k] for k in own})


def refit_on_train_val(prep: Prepared, cfg: RunConfig):
    """Same settings, scaler, categories and model fitted again on train + val (G1).

    Returns the model and the prepared splits that belong to it.
    """
    both_raw = prep.raw.filter(F.col("split").isin("train", "val")).drop("split")
    pre = preprocess.fit_preprocessor(both_raw, scaler=cfg.scaler)

    def part(rows):
        return preprocess.transform(pre, rows)

    both = part(both_raw).persist(StorageLevel.MEMORY_AND_DISK)
    test = part(prep.raw.filter(F.col("split") == "test"))
    merged = Prepared(pre, pre.output_columns(), both, part(prep.raw.filter(F.col("split") == "val")), test, prep.raw)
    rows, wcol = rebalance(merged, cfg)
    model = fit(merged, cfg, rows, wcol)
    for df in (rows, both):  # the splits stay readable, they are only not kept any more
        df.unpersist(blocking=False)
    return model, merged


def run(spark: SparkSession, ledger: DataFrame, cfg: RunConfig | None = None, out_path: str | None = None):
    """Whole training run; returns (final model, metrics row DataFrame, prepared splits)."""
    from txrisk.sources import params as params_io

    cfg = cfg or RunConfig()
    bounds = fit_outlier_bounds(spark, ledger)
    features = build_features(spark, ledger, bounds=bounds)
    prep = prepare(spark, features, cfg)
    if cfg.tune:
        cfg = tuned(prep, cfg)
        prep = with_scaler(prep, cfg)
    rows, wcol = rebalance(prep, cfg)
    model = fit(prep, cfg, rows, wcol, val=prep.val if cfg.algo == "dense" else None)
    metrics = evaluation.evaluate(modeling.scored_table(model, prep.test), cfg.threshold)
    release(prep, rows)
    final, merged = refit_on_train_val(prep, cfg)
    if out_path:
        params_io.save_params(
            out_path, {"bounds": bounds, "categories": merged.pre.categories, "stats": merged.pre.stats},
            config={
                "scaler": cfg.scaler, "algo": cfg.algo, "threshold": cfg.threshold, "columns": merged.cols,
                "categorical": merged.pre.categorical, "numerical": merged.pre.numerical,
            },
            model=final,
        )
    return final, metrics, merged


def load_run(spark: SparkSession, path: str):
    """(model, preprocessor, bounds, config) of a saved run; one error names all missing parts."""
    from txrisk.sources import params as params_io

    tables, config, model = params_io.load_all(spark, path)
    pre = preprocess.Preprocessor(config["categorical"], config["numerical"], config["scaler"], tables["categories"], tables["stats"])
    return model, pre, tables["bounds"], config


def score_ledger(spark: SparkSession, ledger: DataFrame, path: str) -> DataFrame:
    """Scores of a raw ledger by a saved run: its bounds, categories, scaler, model and threshold."""
    model, pre, bounds, config = load_run(spark, path)
    features = build_features(spark, ledger, bounds=bounds)
    return modeling.score_batch(model, preprocess.transform(pre, features), config["threshold"])
