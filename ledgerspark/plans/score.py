"""Scoring tables and files with a saved or given model."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.config import rules_of
from ledgerspark.operators.features import add_features
from ledgerspark.operators.models import predict
from ledgerspark.operators.project import input_features, raw_feature_names, require_columns
from ledgerspark.sources.artifacts import ScoringModel, load_model
from ledgerspark.sources.tables import read_csv, text_options, write_table

_ROW = "_input"


def model_path(conf: dict[str, Any]) -> str:
    cfg = conf.get("artifacts", {})
    path = cfg.get("model_path")
    if not path and cfg.get("root"):
        path = f"{cfg['root'].rstrip('/')}/model"
    if not path:
        raise ValueError("The configuration names neither a model path nor an artifact root")
    return path


def score(df: DataFrame, conf: dict[str, Any], model: ScoringModel | None = None) -> DataFrame:
    """The input row, untouched, with ``prediction`` and ``prediction_proba``.

    Lazy and row-local: one stage, no shuffle.  The model is loaded from the
    configured path unless it is given.  A configured threshold decides the class by the
    probability, whatever the model was fitted with.
    """
    model = model or load_model(df.sparkSession, model_path(conf))
    require_columns(df, conf.get("raw_features", []))
    _require_features(conf, model)
    raw = raw_feature_names(conf)
    # Only what the features need travels beside the row as it came.  Results of an
    # earlier scoring are replaced.
    came = [c for c in df.columns if c not in ("prediction", "prediction_proba")]
    work = df.select(
        F.struct(*[F.col(f"`{c}`") for c in came]).alias(_ROW),
        *[F.col(f"`{c}`") for c in raw])
    probable = "probability" in _outputs(model)
    threshold = conf.get("inference", {}).get("threshold")
    done = score_features(add_features(work), model)
    if probable and threshold is not None:
        done = done.withColumn("prediction", (F.col("prediction_proba") > F.lit(float(threshold))).cast("int"))
    return done.select(f"{_ROW}.*", "prediction", *(["prediction_proba"] if probable else []))


def _require_features(conf: dict[str, Any], model: ScoringModel) -> None:
    """Fail if engineered features are configured and the model was trained on none of them."""
    if conf.get("features", {}).get("engineered"):
        known = [*model.prep.numeric, *model.prep.categorical, *model.features]
        input_features(known, conf, on_empty="error")


def _outputs(model: ScoringModel) -> tuple[str, ...]:
    return ("probability",) if model.classifier.hasParam("probabilityCol") else ()


def score_features(df: DataFrame, model: ScoringModel) -> DataFrame:
    """Predictions for a table that has its features already."""
    vector = model.prep.append_vector(df, "features", model.features)
    return predict(vector, model.classifier, "features")


def score_path(spark: SparkSession, input_path: str, output_path: str, conf: dict[str, Any],
               model: ScoringModel | None = None, format: str = "csv") -> DataFrame:
    """Score a delimited file (or Parquet table) and write input plus predictions."""
    if input_path and input_path.rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(input_path)
    else:
        df = read_csv(spark, input_path, rules_of(conf), **text_options(conf))
    out = score(df, conf, model)
    write_table(out, output_path, format)
    return out
