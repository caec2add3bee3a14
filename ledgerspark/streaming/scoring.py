"""Scoring records as they arrive, with the same code as a table.

The stream keeps no state: each record is parsed, scored and written on its own,
so there is no watermark, and a restart goes on from the checkpoint.  A batch is read and
parsed once for both of its outputs.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerspark.plans.score import score
from ledgerspark.sources.artifacts import ScoringModel
from ledgerspark.sources.records import good_records, parse_records, rejected_records


def record_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Lines of JSON files that appear in a folder, with the file they came from."""
    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
        .withColumn("source_file", F.input_file_name())
    )


def scored_records(lines: DataFrame, conf: dict[str, Any], model: ScoringModel) -> DataFrame:
    """Good records with their predictions; works on tables and streams."""
    return score(good_records(parse_records(lines)), conf, model)


def write_batch(lines: DataFrame, number: int, output: str, conf: dict[str, Any], model: ScoringModel,
                rejected: str | None = None) -> None:
    """Parse a batch once and write what is good, scored, and what is not.

    Each goes to the folder ``batch=<number>`` of its table and takes the place of what an
    earlier try of this batch left there, so a replay changes nothing.
    """
    parsed = parse_records(lines).persist()
    try:
        _put(score(good_records(parsed), conf, model), output, number)
        if rejected:
            _put(rejected_records(parsed), rejected, number)
    finally:
        parsed.unpersist()


def _put(df: DataFrame, table: str, number: int) -> None:
    df.write.mode("overwrite").parquet(f"{table}/batch={number}")


def start_scoring(spark: SparkSession, folder: str, output: str, checkpoint: str,
                  conf: dict[str, Any], model: ScoringModel, *, rejected: str | None = None,
                  once: bool = True) -> StreamingQuery:
    """Score what is in the folder (``once``) or keep scoring what arrives.

    ``rejected`` names a table for records that cannot be used; without it they are left
    out.  Both tables are partitioned by the number of the batch and hold each record exactly
    once; they belong to one checkpoint, whose numbers they carry.
    """
    trigger = {"availableNow": True} if once else {"processingTime": "10 seconds"}
    return (
        record_stream(spark, folder).writeStream
        .foreachBatch(lambda lines, number: write_batch(lines, number, output, conf, model, rejected))
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
