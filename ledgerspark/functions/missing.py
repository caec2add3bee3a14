"""One notion of a missing value: SQL NULL, with NaN counted as NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.schema import is_float


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into NULL; other types are untouched."""
    c = F.col(f"`{name}`")
    if is_float(df.schema[name].dataType):
        return F.when(~F.isnan(c), c)
    return c


def is_missing(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    if is_float(df.schema[name].dataType):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN becomes NULL in every (or each listed) floating column."""
    names = df.columns if cols is None else cols
    floats = [n for n in names if is_float(df.schema[n].dataType)]
    return df.withColumns({n: present(df, n) for n in floats}) if floats else df
