"""Small outputs that describe a table: its schema and its first rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.sources.small import small_table

_NAMES = [
    (T.BooleanType, "bool"),
    (T.IntegralType, "int"),
    (T.FractionalType, "float"),
    (T.StringType, "str"),
    (T.DateType, "date"),
    (T.TimestampNTZType, "timestamp"),
    (T.TimestampType, "timestamp"),
]


def type_name(kind: T.DataType) -> str:
    return next((n for t, n in _NAMES if isinstance(kind, t)), kind.simpleString())


def schema_export(df: DataFrame, counts: bool = False) -> DataFrame:
    """One row per column: position, column, dtype; nothing is read.

    With ``counts`` also n_values, how many values the column has, in one pass.
    """
    rows = [(i, f.name, type_name(f.dataType)) for i, f in enumerate(df.schema)]
    if not counts:
        return small_table(df.sparkSession, rows, "position long, column string, dtype string")
    one = df.agg(*[F.count(F.col(f"`{n}`")).alias(f"n{i}") for i, n, _ in rows])
    return one.select(F.inline(F.array(*[
        F.struct(
            F.lit(i).cast("long").alias("position"), F.lit(n).alias("column"),
            F.lit(t).alias("dtype"), F.col(f"n{i}").alias("n_values"))
        for i, n, t in rows])))


def schema_dict(df: DataFrame) -> dict[str, str]:
    return {f.name: type_name(f.dataType) for f in df.schema}


def sample_head(df: DataFrame, n: int, order_by) -> DataFrame:
    """The first ``n`` rows of a given order; each task keeps only its own first n."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by or [])
    if not keys:
        raise ValueError("order_by is required: a table has no row order of its own")
    return df.orderBy(*keys).limit(n)
