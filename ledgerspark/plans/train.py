"""Training: features, split, transforms, search, fit, evaluation."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ledgerspark.operators.evaluate import auc_from_probability, configured_metrics, metrics
from ledgerspark.operators.features import add_features
from ledgerspark.operators.models import predict, train_model
from ledgerspark.operators.prep import TabularPrep
from ledgerspark.operators.split import SPLIT, split_by_conf
from ledgerspark.operators.tune import random_search
from ledgerspark.plans.score import score_features
from ledgerspark.sources.artifacts import ScoringModel
from ledgerspark.sources.datasets import read_version, write_dataset
from ledgerspark.sources.scratch import scratch_path


@dataclass
class TrainResult:
    model: ScoringModel
    splits: DataFrame  # featurised rows with their split
    metrics: DataFrame  # one row per held-out split
    trials: DataFrame | None  # parameter search, if it ran
    report: DataFrame | None = None  # validation, if it only warned


def stored(df: DataFrame, conf: dict[str, Any], name: str,
           partition_by: list[str] | None = None) -> DataFrame:
    """Write under the artifact root, or to scratch if there is none; read back."""
    spark = df.sparkSession
    root = conf.get("artifacts", {}).get("root") or scratch_path(spark, "train")
    path = write_dataset(df, root, name, partition_by)
    return read_version(spark, root, name, int(path.rsplit("=", 1)[-1]))


def train(df: DataFrame, conf: dict[str, Any], id_col, featurised: bool = False,
          parallelism: int = 4) -> TrainResult:
    """Split, fit transforms on the training rows, search, fit and evaluate.

    The features of a row depend on that row only, so they are computed once and
    stored by split; every later pass reads the one partition it needs.
    """
    target, model_conf = conf["target"], model_settings(conf)
    kind, params = model_conf["name"], dict(model_conf.get("params", {}))
    marked = split_by_conf(df, conf, id_col)
    marked = marked if featurised else add_features(marked)
    splits = stored(marked, conf, "engineered_splits", [SPLIT])
    fit_rows = splits.where(F.col(SPLIT) == "train")
    prep = TabularPrep.from_conf(conf).fit(fit_rows)
    features = prep.output_names
    vectors = prep.append_vector(splits, "features", features).select(
        "features", F.col(f"`{target}`"), SPLIT)
    fit_vectors = vectors.where(F.col(SPLIT) == "train").persist(StorageLevel.MEMORY_AND_DISK)
    trials = None
    try:
        search = model_conf.get("bayesian_optimization") or {}
        if search.get("enabled") and conf.get("data_split", {}).get("valid_size", 0.2) > 0:
            valid = vectors.where(F.col(SPLIT) == "valid").persist(StorageLevel.MEMORY_AND_DISK)
            try:
                found = random_search(fit_vectors, valid, kind, params, search,
                                      label=target, parallelism=parallelism)
            finally:
                valid.unpersist()
            params.update(found.best)
            trials = found.trials
        classifier = train_model(
            fit_vectors, kind, params, label=target,
            threshold=conf.get("inference", {}).get("threshold"))
    finally:
        fit_vectors.unpersist()
    model = ScoringModel(prep, features, classifier, kind, params)
    cfg = conf.get("artifacts", {})
    if cfg.get("root"):
        write_dataset(
            prep.transform(splits, [*_ids(id_col), target, SPLIT]),
            cfg["root"], "preprocessed_data", [SPLIT])
    path = cfg.get("model_path") or model_conf.get("save_path")
    if path or cfg.get("root"):
        model.save(df.sparkSession, path or f"{cfg['root'].rstrip('/')}/model")
    held_out = predict(vectors.where(F.col(SPLIT) != "train"), classifier, "features")
    measured = configured_metrics(metrics(held_out, target, "prediction", by=SPLIT), conf)
    return TrainResult(model, splits, measured, trials)


def model_settings(conf: dict[str, Any]) -> dict[str, Any]:
    """The settings of the model that is named.

    Where ``model`` holds a block under that name, what the block says (``params``,
    ``bayesian_optimization``, ``save_path``) goes before what stands beside the name.
    """
    shared = conf["model"]
    own = shared.get(shared["name"])
    return {**shared, **own} if isinstance(own, dict) else shared


def _ids(id_col) -> list[str]:
    return [id_col] if isinstance(id_col, str) else list(id_col)


def evaluate_saved(table: DataFrame, model: ScoringModel, conf: dict[str, Any],
                   featurised: bool = True) -> DataFrame:
    """Metrics of a saved model on a held-out table, one row.

    Adds ``auc_roc_proba``, the AUC of the probabilities, next to that of the
    hard labels.
    """
    target = conf["target"]
    rows = table if featurised else add_features(table)
    scored = score_features(rows, model)
    hard = configured_metrics(metrics(scored, target, "prediction"), conf)
    if "prediction_proba" not in scored.columns:
        return hard.withColumn("auc_roc_proba", F.lit(None).cast("double"))
    soft = auc_from_probability(scored, target, "prediction_proba").first()
    return hard.withColumn("auc_roc_proba", F.lit(soft[0]).cast("double"))
