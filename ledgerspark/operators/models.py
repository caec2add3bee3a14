"""Tree classifiers by name, with weights for rare classes."""

from __future__ import annotations

import logging
from typing import Any

from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.split import class_counts

logger = logging.getLogger(__name__)

WEIGHT = "_weight"
MAX_BINS = 128
CHECKPOINT_ROUNDS = 10
# Boosting passes over its rows some 1,000 times, a search some 200; a task of a pass should have about so many.
TASK_ROWS = 20_000

MODEL_REGISTRY = {
    "decision_tree": DecisionTreeClassifier,
    "random_forest": RandomForestClassifier,
    "xgboost": GBTClassifier,
}

# What each published parameter is called here.  A name without an entry for a
# learner has no counterpart there.
_COMMON = {
    "max_depth": "maxDepth",
    "min_samples_leaf": "minInstancesPerNode",
    "gamma": "minInfoGain",
    "random_state": "seed",
}
_PARAMETERS = {
    "decision_tree": {**_COMMON, "criterion": "impurity"},
    "random_forest": {
        **_COMMON, "criterion": "impurity", "n_estimators": "numTrees",
        "subsample": "subsamplingRate", "colsample_bytree": "featureSubsetStrategy",
    },
    "xgboost": {
        **_COMMON, "n_estimators": "maxIter", "learning_rate": "stepSize",
        "subsample": "subsamplingRate", "colsample_bytree": "featureSubsetStrategy",
    },
}
_WEIGHTING = ("class_weight", "scale_pos_weight")
_WHOLE = ("maxDepth", "minInstancesPerNode", "seed", "numTrees", "maxIter")


def spark_params(kind: str, params: dict[str, Any]) -> dict[str, Any]:
    """Published parameters under Spark's names; those without one are logged."""
    if kind not in MODEL_REGISTRY:
        raise ValueError(f"No learner is called {kind!r}; there are {sorted(MODEL_REGISTRY)}")
    out: dict[str, Any] = {}
    for name, value in params.items():
        if name in _WEIGHTING:
            continue
        target = _PARAMETERS[kind].get(name)
        if target is None:
            if value not in (0, None):
                logger.warning("Parameter %s=%s has no counterpart for %s", name, value, kind)
            continue
        if target == "featureSubsetStrategy":
            value = "all" if float(value) >= 1 else str(float(value))
        elif target in _WHOLE:
            value = int(value)
        elif target != "impurity":
            value = float(value)
        out[target] = value
    return out


def has_effect(kind: str, name: str) -> bool:
    """Whether a published parameter changes anything for a learner here."""
    return name in _WEIGHTING or name in _PARAMETERS[kind]


def balanced_weights(counts: dict) -> dict:
    """Rows / (classes * rows of the class)."""
    total = sum(counts.values())
    return {k: total / (len(counts) * n) for k, n in counts.items()}


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """The balanced weights as a table: label, n_rows, weight."""
    per_class = df.groupBy(F.col(f"`{label}`").alias("label")).agg(
        F.count(F.lit(1)).alias("n_rows"))
    total = per_class.agg(F.sum("n_rows").alias("n"), F.count(F.lit(1)).alias("k")).first()
    weight = F.lit(float(total["n"] or 0)) / (F.lit(total["k"]) * F.col("n_rows"))
    return per_class.select("label", "n_rows", weight.alias("weight"))


def weight_column(df: DataFrame, label: str, params: dict[str, Any]) -> Column | None:
    """The weight of a row under ``class_weight`` / ``scale_pos_weight``, if any."""
    y = F.col(f"`{label}`")
    weight: Column | None = None
    scheme = params.get("class_weight")
    if scheme == "balanced":
        scheme = balanced_weights(class_counts(df, label))
    if isinstance(scheme, dict):
        weight = F.lit(1.0)
        for k, w in scheme.items():
            weight = F.when(y == F.lit(k), F.lit(float(w))).otherwise(weight)
    if params.get("scale_pos_weight") not in (None, 1):
        positive = F.when(y == 1, F.lit(float(params["scale_pos_weight"]))).otherwise(F.lit(1.0))
        weight = positive if weight is None else weight * positive
    return weight


def train_model(df: DataFrame, kind: str, params: dict[str, Any], *, label: str,
                features: str = "features", threshold: float | None = None) -> Model:
    """Fit a learner by name on a table with a vector and a label."""
    settings = spark_params(kind, params)
    weight = weight_column(df, label, params)
    columns = [F.col(features), F.col(f"`{label}`").cast("double").alias("_label")]
    if weight is not None:
        columns.append(weight.alias(WEIGHT))
        settings["weightCol"] = WEIGHT
    # Boosting adds a tree per round: errors per row are written to the checkpoint folder every
    # few rounds, so the lineage of a late tree does not reach back to the first.  Node ids kept
    # per row would add a stored table per level, to save a walk of a few steps down the tree.
    learner = MODEL_REGISTRY[kind](
        featuresCol=features, labelCol="_label", maxBins=MAX_BINS, cacheNodeIds=kind == "random_forest",
        checkpointInterval=CHECKPOINT_ROUNDS, **settings)
    if threshold is not None and threshold != 0.5:
        learner = learner.setThresholds([1 - threshold, threshold])
    rows = df.select(*columns)
    return learner.fit(spread(rows) if kind == "xgboost" else rows)


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores, where the fullest task would hold much more than its share of them.

    A task's share is ``TASK_ROWS`` rows at least.  Of a file the rows lie in few tasks if it has few
    row groups, however many splits it has, so the rows are counted and not the tasks.
    """
    sizes = [n for _, n in df.groupBy(F.spark_partition_id()).count().collect()]  # a row per task
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, -(-sum(sizes) // TASK_ROWS))
    return df.repartition(wanted) if 2 * max(sizes, default=0) * wanted > 3 * sum(sizes) else df


def predict(df: DataFrame, model: Model, features: str = "features") -> DataFrame:
    """Append ``prediction`` and, if the model offers it, ``prediction_proba``."""
    scored = model.transform(df)
    extra = [c for c in ("rawPrediction", "probability") if c in scored.columns]
    out = scored.withColumn("prediction", F.col("prediction").cast("int"))
    if "probability" in extra:
        out = out.withColumn("prediction_proba", vector_to_array("probability")[1])
    return out.drop(features, *extra)
