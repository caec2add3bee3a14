"""Shared scratch space for tables that a job reads more than once.

Lineage is cut by writing a table to the folder the cluster names in
``spark.checkpoint.dir``, so a lost executor costs no recomputation and a second
pass sees exactly the rows the first one saw.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it."""
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not root:
        raise ValueError(f"Set {_SETTING} to a folder that all executors share")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path that no other call returns."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write the frame to scratch and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
