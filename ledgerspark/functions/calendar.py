"""Calendar columns of a transaction, without any time-zone arithmetic.

Times are zone-less (``timestamp_ntz``), so results do not depend on the
session zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Month-first layout (1/31/2019 0:00) rewritten to year-first.
_MONTH_FIRST = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})(.*)$"
_YEAR_FIRST = "$3-$1-$2$4"


def parse_time(df: DataFrame, name: str, on_error: str = "raise") -> Column:
    """A column as a zone-less timestamp.

    Text may be year-first or month-first, with or without a time of day.
    ``on_error="raise"`` fails the job on text that is neither; ``"null"``
    yields NULL.  The check rides on the same projection, with no extra pass.
    """
    if on_error not in ("raise", "null"):
        raise ValueError(f"on_error must be 'raise' or 'null', got {on_error!r}")
    c = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return c
    if not isinstance(kind, T.StringType):
        return c.cast("timestamp_ntz")
    iso = F.when(
        F.contains(c, F.lit("/")), F.regexp_replace(c, _MONTH_FIRST, _YEAR_FIRST)
    ).otherwise(c)
    parsed = iso.try_cast("timestamp_ntz")
    if on_error == "null":
        return parsed
    complaint = F.concat(F.lit(f"Unparseable time in column '{name}': "), c)
    # try_cast repeats only on the failing side, so each row is parsed once.
    return F.coalesce(
        parsed,
        F.when(c.isNotNull(), F.raise_error(complaint).cast("timestamp_ntz")),
    )


def day_of_week(t: Column) -> Column:
    """Monday is 0, Sunday is 6."""
    return F.weekday(t)


def is_weekend(t: Column) -> Column:
    return (F.weekday(t) >= 5).cast("int")


def whole_days(later: Column, earlier: Column) -> Column:
    """Days between two zone-less times, rounded down also below zero."""
    gap = later - earlier
    days = F.extract(F.lit("DAY"), gap)  # truncates towards zero
    return days - (gap < F.make_dt_interval(days)).cast("int")


def age_years(at: Column, birth: Column) -> Column:
    """Whole days lived divided by 365, rounded down (not calendar years)."""
    return F.floor(whole_days(at, birth) / F.lit(365))
