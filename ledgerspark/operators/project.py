"""Choosing and naming columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.missing import present


def drop_target(df: DataFrame, target: str) -> DataFrame:
    """Features without the label; a table without one is left as it is."""
    return df.drop(target)


def raw_feature_names(conf: dict) -> list[str]:
    target = conf.get("target")
    return [c for c in conf.get("raw_features", []) if c != target]


def require_columns(df: DataFrame, names: list[str]) -> None:
    """Fail with the full list of columns that are not there."""
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"Columns that are required but absent: {missing}")


def column_report(df: DataFrame, names: list[str]) -> DataFrame:
    """One row per required column, in their order: position, column, present, n_missing.

    All columns are counted in one pass; an absent one has no count.
    """
    counts = [F.count_if(present(df, c).isNull()) if c in df.columns else F.lit(None) for c in names]
    rows = [F.struct(F.lit(i).cast("long").alias("position"), F.lit(c).alias("column"), F.lit(c in df.columns).alias("present"),
                     n.cast("long").alias("n_missing")) for i, (c, n) in enumerate(zip(names, counts))]
    return df.agg(F.array(*rows).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")


def select_raw_features(df: DataFrame, conf: dict, strict: bool = True) -> DataFrame:
    """The configured raw columns without the target.

    ``strict`` demands every listed column, the target too if it is listed;
    otherwise absent ones are left out.
    """
    if strict:
        require_columns(df, conf.get("raw_features", []))
    return df.select(*[f"`{c}`" for c in raw_feature_names(conf) if c in df.columns])


def input_features(columns: list[str], conf: dict, *, among: list[str] | None = None,
                   on_empty: str = "all") -> list[str]:
    """Configured engineered columns that exist, in configured order.

    If none does: all columns (``on_empty="all"``) or an error (``"error"``).
    """
    offered = [c for c in columns if among is None or c in among]
    engineered = conf.get("features", {}).get("engineered", [])
    chosen = [c for c in engineered if c in offered]
    if chosen or (on_empty == "all"):
        return chosen or offered
    raise ValueError(f"No configured input feature is among the columns {offered}")


def select_engineered(df: DataFrame, conf: dict, on_empty: str = "all") -> DataFrame:
    return df.select(*[f"`{c}`" for c in input_features(df.columns, conf, on_empty=on_empty)])


def attach_target(features: DataFrame, labels: DataFrame, id_col: str, target: str) -> DataFrame:
    """Join a label kept elsewhere back to its rows by id."""
    return features.join(labels.select(id_col, target), id_col)


def rename_columns(df: DataFrame, conf: dict) -> DataFrame:
    """Apply the configured old-to-new names."""
    names = conf.get("preprocessing", {}).get("rename_columns", {})
    return df.withColumnsRenamed({k: v for k, v in names.items() if k != v})


def response(df: DataFrame) -> DataFrame:
    """The two columns a caller gets back: prediction and probability."""
    out = [F.col("prediction")]
    if "prediction_proba" in df.columns:
        out.append(F.col("prediction_proba").alias("probability"))
    return df.select(*out)
