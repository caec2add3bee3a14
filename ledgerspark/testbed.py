"""A transaction table derived from the event table the test data provides.

Arithmetic only, so any engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators.models import spread
from ledgerspark.sources.scratch import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def txn(spark: SparkSession, sf_dir: str, spread_out: bool = False) -> DataFrame:
    def off(n: int) -> str:
        return f"CAST((event_id * {n}) % 200 - 100 AS DOUBLE) / 100D"

    lat = "25 + CAST((user_id * 37) % 2400 AS DOUBLE) / 100D"
    lon = "-120 + CAST((user_id * 53) % 5000 AS DOUBLE) / 100D"
    events = table(spark, sf_dir, "events")
    if spread_out:
        few = events.select("event_id", "user_id", "event_type", "value", "ts")
        many = spread(few)
        events = few if many is few else materialize(many, "events")
    return events.selectExpr(
        "event_id AS row_id",
        "user_id AS cc_num",
        "event_type AS category",
        "value AS amt",
        "CAST(ts AS TIMESTAMP_NTZ) AS trans_date_trans_time",
        "date_add(date'1940-01-01', CAST((user_id * 263) % 22000 AS INT)) AS dob",
        "if(user_id % 2 = 0, 'F', 'M') AS gender",
        "if(event_id % 7 <> 0, concat('job_', CAST(user_id % 11 AS STRING)), NULL) AS job",
        "if(event_id % 11 <> 0, 100 + (user_id * 7919) % 1000000, NULL) AS city_pop",
        f"{lat} AS lat",
        f"{lon} AS long",
        f"{lat} + {off(17)} AS merch_lat",
        f"{lon} + {off(29)} AS merch_long",
        "CAST(event_type IN ('purchase', 'error') AND value > 150 AS INT) AS is_fraud",
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions with all 14 fields of a scoring record, as text where due.

    Their rows lie over all cores, whatever the row groups of the file.
    """
    return txn(spark, sf_dir, spread_out=True).selectExpr(
        "row_id",
        "left(CAST(trans_date_trans_time AS STRING), 19) AS trans_date_trans_time",
        "category", "amt", "gender",
        "concat('city_', CAST(cc_num % 97 AS STRING)) AS city",
        "concat('S', CAST(cc_num % 50 AS STRING)) AS state",
        "10000 + cc_num % 90000 AS zip",
        "lat", "long",
        "coalesce(city_pop, 0) AS city_pop",
        "coalesce(job, 'none') AS job",
        "CAST(dob AS STRING) AS dob",
        "merch_lat", "merch_long", "is_fraud",
    )


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text per transaction; every 13th lacks a field, every 17th has a
    text in place of a number, every 19th gives a number as text."""
    r = records(spark, sf_dir)
    fields = [c for c in r.columns if c not in ("row_id", "is_fraud", "amt", "zip")]
    i = F.col("row_id")
    amt = F.when(i % 17 == 0, F.lit("much")).when(i % 19 == 0, F.col("amt").cast("string"))
    whole = F.to_json(F.struct(*fields, F.when(i % 13 != 0, F.col("zip")).alias("zip"), "amt"))
    quoted = F.to_json(F.struct(
        *fields, F.when(i % 13 != 0, F.col("zip")).alias("zip"), amt.alias("amt")))
    return r.select("row_id", F.when(amt.isNull(), whole).otherwise(quoted).alias("value"))
