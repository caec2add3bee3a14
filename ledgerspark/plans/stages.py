"""The jobs a user runs: load, validate, featurise, preprocess, train, score."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.config import rules_of
from ledgerspark.operators.features import add_features
from ledgerspark.operators.fill import fill_missing
from ledgerspark.operators.prep import preprocess as fit_and_transform
from ledgerspark.operators.profile import describe, fingerprint, profile
from ledgerspark.operators.split import split_by_conf
from ledgerspark.operators.validate import (
    DataValidationError,
    validate_schema,
    validation_report,
)
from ledgerspark.plans.score import score, score_path
from ledgerspark.plans.train import TrainResult, stored, train
from ledgerspark.sources.exports import sample_head, schema_dict, schema_export
from ledgerspark.sources.scratch import materialize
from ledgerspark.sources.tables import apply_types, read_dataset

logger = logging.getLogger(__name__)

STAGES = ("load", "validate", "pipeline", "infer", "all")


def load_and_profile(spark: SparkSession, conf: dict[str, Any], base_dir: str | None = None,
                     exact: bool = True, order_by=None) -> dict[str, DataFrame]:
    """Read the raw table and profile it; the table itself is under ``data``.

    Text is parsed once, into a stored table that the profiles read.  With ``order_by`` its
    first 100 rows are under ``sample``.
    """
    df = materialize(read_dataset(spark, conf, "raw", base_dir), "raw")
    if df.isEmpty():
        logger.warning("The raw table has no rows")
    sample = {"sample": sample_head(df, 100, order_by)} if order_by else {}
    return {"data": df, **profile(df, exact), **sample}


def validate_and_fill(df: DataFrame, rules: list[dict[str, Any]], order_by,
                      partition_by=None, text: bool = False,
                      ranges: int | None = None) -> DataFrame:
    """Fill gaps only if the table keeps its rules; else raise the first breach."""
    validate_schema(df, rules, text)
    if text:
        df = apply_types(df, rules)
    return fill_missing(df, order_by=order_by, partition_by=partition_by, ranges=ranges)


@dataclass
class Outputs:
    data: DataFrame
    sample: DataFrame
    schema: dict[str, str]


def featurize(df: DataFrame, conf: dict[str, Any], order_by, rows: int = 50) -> Outputs:
    """Add every feature, store the table, and give a sample and the schema."""
    data = stored(add_features(df), conf, "engineered_data")
    return Outputs(data, sample_head(data, rows, order_by), schema_dict(data))


def preprocess(df: DataFrame, conf: dict[str, Any], id_col) -> dict[str, Any]:
    """Fingerprint, describe, encode, fit, transform, choose columns, split, store."""
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    table, prep = fit_and_transform(df, conf, keep=ids)
    marked = split_by_conf(table, conf, ids)
    return {
        "fingerprint": fingerprint(df),
        "schema": schema_export(df),
        "sample": sample_head(df, 50, ids),
        "stats": describe(df),
        "prep": prep,
        "data": stored(marked, conf, "preprocessed_data", ["split"]),
    }


def run(spark: SparkSession, conf: dict[str, Any], stage: str = "all", *,
        id_col="trans_num", base_dir: str | None = None) -> TrainResult | DataFrame | None:
    """One stage, or ``all``: load, validate, train (scoring is its own stage).

    Where validation only warns, its report is written to the configured
    ``report_path`` and handed on: as the result of ``validate``, and as ``report`` of
    the training result.
    """
    if stage not in STAGES:
        raise ValueError(f"Unknown stage: {stage}")
    if stage == "infer":
        paths = conf["inference"]
        return score_path(spark, paths["input_path"], paths["output_path"], conf)
    rules = rules_of(conf)
    text = read_dataset(spark, conf, "raw", base_dir, as_text=True)
    report = check(text, conf) if stage in ("validate", "all") else None
    df = apply_types(text, rules)
    if stage in ("pipeline", "all"):
        result = train(df, conf, id_col)
        result.report = report
        return result
    return df if report is None else report


def run_steps(spark: SparkSession, conf: dict[str, Any], id_col, order_by, *,
              base_dir: str | None = None) -> dict[str, Any]:
    """Load, validate and fill, train, score; each step stores what it hands on.

    Tables go to named versions under the artifact root: raw_data, validated_data,
    engineered_splits, preprocessed_data, inference_predictions.
    """
    text = read_dataset(spark, conf, "raw", base_dir, as_text=True)
    raw = stored(text, conf, "raw_data")
    filled = validate_and_fill(raw, rules_of(conf), order_by, text=True)
    validated = stored(filled, conf, "validated_data")
    result = train(validated, conf, id_col)
    unseen = conf.get("inference", {}).get("input_path")
    table = read_dataset(
        spark, {**conf, "data_source": {**conf["data_source"], "raw_path": unseen}},
        "raw", base_dir) if unseen else validated
    predictions = stored(score(table, conf, result.model), conf, "inference_predictions")
    return {"raw": raw, "validated": validated, "training": result, "predictions": predictions}


def check(df: DataFrame, conf: dict[str, Any]) -> DataFrame | None:
    """Validate as configured: raise, or return the report and only warn."""
    cfg = conf.get("data_validation", {})
    if not cfg.get("enabled", True):
        return None
    if cfg.get("action_on_error", "raise") == "raise":
        validate_schema(df, rules_of(conf), text=True)
        return None
    report = materialize(validation_report(df, rules_of(conf), text=True), "report")
    if cfg.get("report_path"):
        report.coalesce(1).write.mode("overwrite").json(cfg["report_path"])  # a row per check
    for r in report.where("status = 'error'").collect():
        logger.warning("Column '%s' breaks its %s rule: %d", r["column"], r["check"],
                       r["violations"])
    return report


__all__ = [
    "STAGES", "DataValidationError", "Outputs", "check", "featurize", "load_and_profile",
    "preprocess", "run", "run_steps", "validate_and_fill",
]
