"""Named, versioned tables: ``<root>/<name>/v=<n>``, newest complete one is latest."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.sources import paths

_MANIFEST = "_manifest"
_VERSION = re.compile(r"^v=(\d+)$")


def versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """Versions that were written to the end, oldest first."""
    folder = f"{root.rstrip('/')}/{name}"
    return sorted(n for n in _taken(spark, folder) if paths.exists(spark, f"{folder}/v={n}/_SUCCESS"))


def write_dataset(df: DataFrame, root: str, name: str,
                  partition_by: list[str] | None = None) -> str:
    """Write the next version; returns its path.

    Data and manifest (declared types, partition columns, rows) are written under a name of
    their own and get the version's number by one rename.  So a version is there as a
    whole or not at all, and never overwritten: of two writers that want the same number
    the later one takes the next.
    """
    spark = df.sparkSession
    folder = f"{root.rstrip('/')}/{name}"
    draft = f"{folder}/_draft-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(draft)
    rows = spark.read.schema(df.schema).parquet(draft).count()  # from the files' footers
    # Folder names hold partition values as text; the declared types go beside them.
    manifest = {"schema": df.schema.jsonValue(), "partition_by": partition_by or [], "rows": rows}
    spark.range(1, numPartitions=1).select(F.lit(json.dumps(manifest)).alias("value")).write.text(f"{draft}/{_MANIFEST}")
    number = max(_taken(spark, folder), default=0) + 1
    while not paths.publish(spark, draft, f"{folder}/v={number}"):
        number += 1
    return f"{folder}/v={number}"


def _taken(spark: SparkSession, folder: str) -> list[int]:
    return [int(m.group(1)) for m in map(_VERSION.match, paths.child_names(spark, folder)) if m]


def manifest(spark: SparkSession, root: str, name: str, version: int) -> dict | None:
    """schema, partition_by and rows of a version; none if it was written without."""
    path = f"{root.rstrip('/')}/{name}/v={version}/{_MANIFEST}"
    if not paths.exists(spark, path):
        return None
    return json.loads(spark.read.text(path).first()["value"])


def read_version(spark: SparkSession, root: str, name: str,
                 version: int | str = "latest") -> DataFrame:
    """A version by number, or the latest, with the types and column order it was written in."""
    done = versions(spark, root, name)
    if version == "latest":
        version = done[-1] if done else None
    if version not in done:
        raise FileNotFoundError(f"Dataset not found: {name} under {root}")
    folder = f"{root.rstrip('/')}/{name}"
    held = manifest(spark, root, name, version)
    if held is None:
        return spark.read.parquet(f"{folder}/v={version}")
    schema = T.StructType.fromJson(held["schema"])
    table = spark.read.schema(schema).parquet(f"{folder}/v={version}")
    return table.select(*[f"`{c}`" for c in schema.names])
