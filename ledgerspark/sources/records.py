"""JSON records sent for scoring: one object per line, 14 required typed fields.

Numbers may come as text and whole numbers as ``5.0``; text fields accept text
only; other keys are ignored.  A record that breaks this is kept with the reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.config import RECORD_FIELDS
from ledgerspark.sources.tables import check_path

_WHOLE = "^ *[+-]?[0-9]+([.]0*)? *$"
_ZEROS = "[.]0* *$"


class RecordError(ValueError):
    """A record does not have the declared fields."""


def _typed(name: str, dtype: str) -> str:
    """The value of a field from its variant kind and its text; NULL if unusable."""
    kind, text = f"_kind_{name}", f"_text_{name}"
    if dtype == "str":
        return f"if({kind} = 'STRING', {text}, NULL)"
    target = "BIGINT" if dtype == "int" else "DOUBLE"
    plain = f"try_cast({text} AS {target})"
    if dtype == "int":
        whole = f"if({text} RLIKE '{_WHOLE}', regexp_replace({text}, '{_ZEROS}', ''), NULL)"
        plain = f"coalesce({plain}, try_cast({whole} AS {target}))"
    return (f"CASE WHEN left({kind}, 3) IN ('BIG', 'DEC', 'DOU', 'FLO', 'STR') THEN {plain} "
            f"WHEN {kind} = 'BOOLEAN' THEN CAST(if({text} = 'true', 1, 0) AS {target}) END")


def _reason(name: str, dtype: str) -> str:
    kind = f"_kind_{name}"
    return (f"CASE WHEN {kind} IS NULL OR {kind} = 'VOID' THEN '{name}: missing' "
            f"WHEN _value_{name} IS NULL THEN '{name}: not {dtype}' END")


def parse_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """Typed fields plus ``reason``: NULL if good, else all that is wrong.

    Row by row, so it serves tables and streams alike.  Each line is parsed once
    and each field taken out once.  The results leave through a generator of one
    row, which keeps a later filter on ``reason`` from being rewritten into the
    fourteen field checks.
    """
    others = [f"`{c}`" for c in lines.columns]
    names = [name for name, _ in RECORD_FIELDS]
    shape = ", ".join(f"{name} variant" for name in names)
    doc = lines.select(
        *others,
        F.from_json(F.col(column), f"{shape}, _broken string",
                    {"columnNameOfCorruptRecord": "_broken"}).alias("_doc"))
    taken = doc.selectExpr(
        *others, "_doc IS NULL OR _doc._broken IS NOT NULL AS _is_broken",
        *[f"schema_of_variant(_doc.`{n}`) AS _kind_{n}" for n in names],
        *[f"try_variant_get(_doc.`{n}`, '$', 'string') AS _text_{n}" for n in names])
    typed = taken.selectExpr(
        *others, "_is_broken", *[f"_kind_{n}" for n in names],
        *[f"{_typed(name, dtype)} AS _value_{name}" for name, dtype in RECORD_FIELDS])
    wrong = ", ".join(_reason(name, dtype) for name, dtype in RECORD_FIELDS)
    reason = f"if(_is_broken, 'not a JSON object', nullif(concat_ws('; ', {wrong}), ''))"
    fields = ", ".join(f"'{n}', _value_{n}" for n in names)
    return typed.selectExpr(
        *others, f"inline(array(named_struct({fields}, 'reason', {reason})))")


def good_records(parsed: DataFrame, column: str = "value") -> DataFrame:
    return parsed.where(F.col("reason").isNull()).drop("reason", column)


def rejected_records(parsed: DataFrame, column: str = "value") -> DataFrame:
    """The raw lines that cannot be used, with the reason."""
    others = [c for c in parsed.columns
              if c not in (column, "reason") and c not in dict(RECORD_FIELDS)]
    return parsed.where(F.col("reason").isNotNull()).select(*others, column, "reason")


def read_records(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """Good records of a file or folder; FAILFAST refuses all if one is bad."""
    parsed = parse_records(spark.read.text(check_path(spark, path)))
    if mode == "FAILFAST":
        first = rejected_records(parsed).first()
        if first is not None:
            raise RecordError(first["reason"])
    elif mode != "PERMISSIVE":
        raise ValueError(f"Unknown mode: {mode}")
    return good_records(parsed)
