"""Fitted models on disk: statistics as JSON, the classifier by Spark's writer."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import SparkSession

from ledgerspark.operators.prep import TabularPrepModel
from ledgerspark.sources import paths


@dataclass
class ScoringModel:
    """All that scoring needs: fitted transforms, feature order, classifier."""

    prep: TabularPrepModel
    features: list[str]
    classifier: Model
    kind: str
    params: dict[str, Any]

    def save(self, spark: SparkSession, path: str) -> None:
        path = path.rstrip("/")
        note = {"features": self.features, "kind": self.kind, "params": self.params,
                "prep": self.prep.to_json()}
        spark.createDataFrame([(json.dumps(note),)], "value string").coalesce(1) \
            .write.mode("overwrite").text(f"{path}/preprocessing")
        self.classifier.write().overwrite().save(f"{path}/classifier")


def save_prep(spark: SparkSession, prep: TabularPrepModel, path: str) -> None:
    spark.createDataFrame([(prep.to_json(),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def load_prep(spark: SparkSession, path: str) -> TabularPrepModel:
    paths.require(spark, path, "preprocessing pipeline")
    return TabularPrepModel.from_json(spark.read.text(path, wholetext=True).first()[0])


def load_model(spark: SparkSession, path: str) -> ScoringModel:
    """The saved model; a missing part is named in the error."""
    path = path.rstrip("/")
    paths.require(spark, f"{path}/preprocessing", "preprocessing pipeline")
    paths.require(spark, f"{path}/classifier", "model")
    note = json.loads(spark.read.text(f"{path}/preprocessing", wholetext=True).first()[0])
    classifier = DefaultParamsReader.loadParamsInstance(f"{path}/classifier", spark)
    return ScoringModel(TabularPrepModel.from_json(note["prep"]), note["features"],
                        classifier, note["kind"], note["params"])
