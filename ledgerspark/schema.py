"""Declared column rules and the Spark types they stand for."""

from __future__ import annotations

from typing import Any

from pyspark.sql import types as T

from ledgerspark.config import RECORD_FIELDS, TXN_COLUMNS

SPARK_TYPE = {"int": T.LongType(), "float": T.DoubleType(), "str": T.StringType()}

_FAMILY = {
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType),
    "float": (T.FloatType, T.DoubleType),
    "str": (T.StringType,),
}


def struct_of(rules: list[dict[str, Any]]) -> T.StructType:
    """The schema a rule list declares; names without a known type are text."""
    return T.StructType(
        [
            T.StructField(r["name"], SPARK_TYPE.get(r.get("dtype"), T.StringType()))
            for r in rules
        ]
    )


def in_family(data_type: T.DataType, dtype: str) -> bool:
    """Whether a stored type is an instance of a declared type name."""
    return isinstance(data_type, _FAMILY[dtype])


def is_float(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.FloatType, T.DoubleType))


def is_numeric(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.NumericType, T.BooleanType))


TXN_SCHEMA = struct_of([{"name": n, "dtype": t} for n, t in TXN_COLUMNS])
RECORD_SCHEMA = struct_of([{"name": n, "dtype": t} for n, t in RECORD_FIELDS])
