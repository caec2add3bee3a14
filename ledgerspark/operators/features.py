"""All engineered columns of a transaction in one narrow, row-local chain.

The columns depend on their own row only, so they are added once, before any
split; each split then holds the same values it would have got on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions import calendar as cal
from ledgerspark.functions.geodesy import with_geodesic_km

TIME, BIRTH = "trans_date_trans_time", "dob"
PLACE = ("lat", "long", "merch_lat", "merch_long")
ENGINEERED = ("hour", "day", "month", "day_of_week", "is_weekend", "age", "geo_distance")


def _require(df: DataFrame, names) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise KeyError(f"Missing columns for feature derivation: {absent}")


def add_time_features(df: DataFrame, time: str = TIME, on_error: str = "raise") -> DataFrame:
    """Parse the time column and add hour, day, month, day_of_week, is_weekend."""
    _require(df, [time])
    t = F.col(time)
    return df.withColumn(time, cal.parse_time(df, time, on_error)).withColumns(
        {
            "hour": F.hour(t),
            "day": F.dayofmonth(t),
            "month": F.month(t),
            "day_of_week": cal.day_of_week(t),
            "is_weekend": cal.is_weekend(t),
        }
    )


def add_age(df: DataFrame, time: str = TIME, birth: str = BIRTH,
            on_error: str = "raise") -> DataFrame:
    """Parse both columns and add ``age``: whole days divided by 365, floored."""
    _require(df, [time, birth])
    parsed = {c: cal.parse_time(df, c, on_error) for c in (time, birth)}
    return df.withColumns(parsed).withColumn(
        "age", cal.age_years(F.col(time), F.col(birth))
    )


def add_distance(df: DataFrame) -> DataFrame:
    """Add ``geo_distance``, km from cardholder to merchant; 0.0 on bad input."""
    _require(df, PLACE)
    return with_geodesic_km(df, *PLACE, out="geo_distance")


def add_features(df: DataFrame, on_error: str = "raise") -> DataFrame:
    """Every engineered column; one stage, no shuffle, no Python worker."""
    _require(df, (TIME, BIRTH, *PLACE))
    # The distance first: its steps and those below then compile to two methods,
    # each short enough for the JVM to optimise.
    return add_age(add_time_features(add_distance(df), on_error=on_error), on_error=on_error)


def add_features_to_splits(*frames: DataFrame | None, on_error: str = "raise"):
    """The same for frames that are split already; ``None`` passes through."""
    return tuple(f if f is None else add_features(f, on_error) for f in frames)
