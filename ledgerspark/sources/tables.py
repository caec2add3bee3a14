"""Delimited text and Parquet tables under declared types.

Text is read without type inference: every field comes in as text, takes its
declared type by a cast that cannot fail, and can be validated as text first, so
that a bad value is counted instead of changing the type of its column.
"""

from __future__ import annotations

import codecs
import os
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.config import rules_of
from ledgerspark.operators.validate import WHOLE_NUMBER
from ledgerspark.sources import lines, paths
from ledgerspark.sources.scratch import scratch_path
from ledgerspark.sources.small import small_table

# Spellings that a text table uses for a missing value.
MISSING_TEXT = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


# Names of encodings, as files are usually labelled and as the JVM
# wants them.
_CHARSETS = {
    "utf-8": "UTF-8", "utf-8-sig": "UTF-8", "ascii": "US-ASCII", "iso8859-1": "ISO-8859-1",
    "utf-16": "UTF-16", "utf-16-le": "UTF-16LE", "utf-16-be": "UTF-16BE", "utf-32": "UTF-32",
}


def _charset(encoding: str) -> str:
    return _CHARSETS.get(codecs.lookup(encoding).name, encoding)


def check_path(spark: SparkSession, path: Any) -> str:
    if not path or not isinstance(path, str):
        raise ValueError(f"A table path must be a text that is not empty, got {path!r}")
    if not paths.exists(spark, path):
        raise FileNotFoundError(f"There is no table at {path}")
    return path


_RAW = "_raw_record"


def _read(spark: SparkSession, path: str, delimiter: str, header: int, encoding: str,
          multi_line: bool) -> tuple[DataFrame, list[str], Column]:
    """All columns as text beside the raw record, the names, and what marks a bad record."""
    check_path(spark, path)
    if not isinstance(header, int) or header < 0:
        raise ValueError(f"The heading is a line counted from 0, not {header!r}")
    charset = _charset(encoding)
    wide = charset.startswith(("UTF-16", "UTF-32"))
    if wide and header:
        raise ValueError(f"In {encoding} only the first line can be the heading, not line {header}")
    dialect = {"sep": delimiter, "quote": '"', "escape": '"', "multiLine": str(multi_line).lower()}

    def schema(names: list[str]) -> T.StructType:
        fields = [T.StructField(f"_f{i}", T.StringType()) for i in range(len(names))]
        return T.StructType([*fields, T.StructField(_RAW, T.StringType())])

    def reader(encoding: str = charset):
        return spark.read.options(**dialect, header="true", inferSchema="false", encoding=encoding)

    if not wide and (multi_line or header):
        rows = lines.records(spark, path, delimiter, encoding, multi_line)
        names = _heading(spark, rows, header, lambda p: reader("UTF-8").csv(p).columns)
        parsed = F.from_csv("text", schema(names).simpleString(), {
            **dialect, "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW})
        df = rows.where(F.col("number") > header).select(parsed.alias("_r"), "text", "ends")
        open_ = F.when(~F.col("ends"), F.col("text"))
        df = df.select("_r.*", open_.alias("_open")).withColumn(_RAW, F.coalesce(_RAW, "_open")).drop("_open")
    else:
        names = reader().csv(path).columns
        df = (
            reader().option("mode", "PERMISSIVE").option("enforceSchema", True)
            .option("columnNameOfCorruptRecord", _RAW).option("columnPruning", False)
            .schema(schema(names)).csv(path)
        )
    names = [f"Unnamed: {i}" if n == f"_c{i}" else n for i, n in enumerate(names)]
    # A record that is too short has gaps at its end.  One that is too long, or ends inside
    # quotes, does not fit.
    # (A query may not read the raw record alone, so a field goes along.)
    raw = F.coalesce(F.col(_RAW), F.when(F.col(_RAW).isNotNull(), F.col("_f0")))
    bare = F.regexp_replace(raw, '"([^"]|"")*"', "")
    count = F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit("")))
    too_long = count > len(delimiter) * (len(names) - 1)
    bad = F.coalesce(raw.isNotNull() & (too_long | bare.contains('"')), F.lit(False))
    return df, names, bad


def _heading(spark: SparkSession, rows: DataFrame, header: int, columns) -> list[str]:
    """The names in the heading record of the first file, as the reader of a file would have them."""
    first = rows.where(F.col("number") == header).orderBy("place").select("text").first()
    if first is None:
        raise ValueError(f"There is no line {header} for a heading")
    path = scratch_path(spark, "heading")
    small_table(spark, [(first["text"],)], "value string").coalesce(1).write.text(path)
    return columns(path)


def read_text_table(spark: SparkSession, path: str, delimiter: str = ",", header: int = 0,
                    encoding: str = "utf-8", multi_line: bool = False,
                    on_bad: str = "raise") -> DataFrame:
    """A delimited file with a heading line; all columns text, gaps NULL.

    Files are split over tasks.  ``multi_line`` allows line breaks inside quotes, and
    ``header`` names a later line as the heading (those before it are dropped, in every
    file); for either the records are cut by one more pass and stored first (see ``lines``;
    in UTF-16 and UTF-32 a file with ``multi_line`` is one task).  A record with more fields
    than the heading, or with a quote that does not end, raises when it is read; with
    ``on_bad="skip"`` it is left out, and ``rejected_rows`` has it.
    """
    if on_bad not in ("raise", "skip"):
        raise ValueError(f"Unknown way with bad records: {on_bad!r}")
    df, names, bad = _read(spark, path, delimiter, header, encoding, multi_line)
    if on_bad == "skip":
        df = df.where(~bad)
    else:
        say = F.concat(F.lit("A record does not fit the heading (a line break in quotes needs "
                             "multi_line): "), F.left(F.col(_RAW), F.lit(200)))
        df = df.where(F.when(bad, F.raise_error(say).cast("boolean")).otherwise(F.lit(True)))
    return df.select(*[
        F.when(~F.col(f"_f{i}").isin(MISSING_TEXT), F.col(f"_f{i}")).alias(c)
        for i, c in enumerate(names)
    ])


def rejected_rows(spark: SparkSession, path: str, delimiter: str = ",", header: int = 0,
                  encoding: str = "utf-8", multi_line: bool = False) -> DataFrame:
    """The records of a delimited file that do not fit its heading, as they stand: ``record``."""
    df, _, bad = _read(spark, path, delimiter, header, encoding, multi_line)
    return df.where(bad).select(F.col(_RAW).alias("record"))


def _declared(name: str, dtype: str | None) -> Column:
    c = F.col(f"`{name}`")
    if dtype == "int":
        return F.when(c.rlike(WHOLE_NUMBER), c.try_cast("long"))
    if dtype == "float":
        number = c.try_cast("double")
        return F.when(~F.isnan(number), number)
    return c


def apply_types(df: DataFrame, rules: list[dict[str, Any]]) -> DataFrame:
    """Text columns under their declared types; undeclared columns stay text."""
    types = {r["name"]: r.get("dtype") for r in rules}
    return df.select(*[
        _declared(f.name, types.get(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def read_csv(spark: SparkSession, path: str, rules: list[dict[str, Any]] | None = None,
             delimiter: str = ",", header: int = 0, encoding: str = "utf-8",
             multi_line: bool = False, on_bad: str = "raise") -> DataFrame:
    """A delimited file under declared types."""
    text = read_text_table(spark, path, delimiter, header, encoding, multi_line, on_bad)
    return apply_types(text, rules or [])


def text_options(conf: dict[str, Any]) -> dict[str, Any]:
    """How the configuration says delimited text is to be read."""
    source = conf.get("data_source", {})
    return {"delimiter": source.get("delimiter", ","), "header": source.get("header", 0),
            "encoding": source.get("encoding", "utf-8"),
            "multi_line": bool(source.get("multi_line", False)),
            "on_bad": source.get("on_bad_lines", "raise")}


def dataset_path(conf: dict[str, Any], stage: str, base_dir: str | None = None) -> str:
    """Where the configuration keeps a stage; relative paths start at ``base_dir``."""
    source = conf.get("data_source", {})
    key = {"raw": "raw_path", "processed": "processed_path"}.get(stage)
    if key is None:
        raise ValueError(f"There is no stage called {stage!r}")
    path = source.get(key)
    if not path or not isinstance(path, str):
        raise ValueError(f"The configuration has no path for the stage {stage!r}")
    if base_dir and "://" not in path and not os.path.isabs(path):
        path = os.path.normpath(os.path.join(base_dir, path))
    return path


def read_dataset(spark: SparkSession, conf: dict[str, Any], stage: str = "raw",
                 base_dir: str | None = None, as_text: bool = False) -> DataFrame:
    """The table of a stage: Parquet if its path says so, else delimited text."""
    path = dataset_path(conf, stage, base_dir)
    check_path(spark, path)
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    text = read_text_table(spark, path, **text_options(conf))
    return text if as_text else apply_types(text, rules_of(conf))


def write_table(df: DataFrame, path: str, format: str = "parquet",
                mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Write Parquet, or delimited text with a heading; one file per task."""
    if format == "csv":
        df = df.select(*[
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType, T.DateType))
            else F.col(f"`{f.name}`") for f in df.schema])
        writer = df.write.mode(mode).option("header", True).option("escape", '"')
        writer = writer.option("nullValue", "").option("emptyValue", "")
        writer = writer.option("ignoreLeadingWhiteSpace", False)
        writer = writer.option("ignoreTrailingWhiteSpace", False)
    elif format == "parquet":
        writer = df.write.mode(mode)
    else:
        raise ValueError(f"Unknown table format: {format}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(format).save(path)
