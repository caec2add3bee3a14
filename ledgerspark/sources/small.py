"""Small driver-side results as tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def small_table(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A local relation: it is part of the plan, so no job runs to read it."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    arrays = [pa.array([r[i] for r in rows], type=to_arrow_type(f.dataType))
              for i, f in enumerate(schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=schema.names), schema=schema)
