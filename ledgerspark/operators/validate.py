"""Column rules checked in one scan.

Every counter of every rule is part of one aggregation.  The verdicts are then
read in rule order, so the first violation reported is the first in that order
no matter how many there are.
"""

from __future__ import annotations

import logging
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.functions.missing import is_missing, present
from ledgerspark.schema import SPARK_TYPE, in_family, is_numeric

logger = logging.getLogger(__name__)

WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"


class DataValidationError(Exception):
    """A table breaks one of its declared rules."""


class _Check:
    """One check of one rule: its counter and what a violation means."""

    def __init__(self, order: int, rule: dict[str, Any], kind: str, hits: Column | None,
                 fatal: bool):
        self.order, self.rule, self.kind = order, rule, kind
        self.hits, self.fatal = hits, fatal

    @property
    def column(self) -> str:
        return self.rule["name"]

    def message(self, n: int) -> str:
        name = self.column
        # The wording that callers match on.
        return {
            "present": f"Missing required column: {name}" if self.fatal
            else f"Optional column '{name}' is absent",
            "missing": f"Column '{name}' has {n} missing values "
                       f"({'required' if self.fatal else 'optional'}).",
            "type": f"Column '{name}' has incorrect type. Expected {self.rule.get('dtype')}",
            "allowed": f"Column '{name}' contains values outside of allowed set.",
            "minimum": f"Column '{name}' has values below minimum of {self.rule.get('min')}.",
        }[self.kind]


def _typed_as(df: DataFrame, name: str, dtype: str, text: bool) -> Column:
    """The column under its declared type; text is cast, bad text is NULL."""
    if not text or not isinstance(df.schema[name].dataType, T.StringType):
        return present(df, name)
    c = F.col(f"`{name}`")
    if dtype == "int":
        return F.when(c.rlike(WHOLE_NUMBER), c.try_cast("long"))
    return c.try_cast(SPARK_TYPE[dtype]) if dtype == "float" else c


def _checks(df: DataFrame, rules: list[dict[str, Any]], text: bool) -> list[_Check]:
    """Per rule, in order: presence, missing values, type, allowed set, minimum."""
    out = []
    for order, rule in enumerate(rules):
        name, dtype = rule["name"], rule.get("dtype")
        required = bool(rule.get("required", False))
        if name not in df.columns:
            out.append(_Check(order, rule, "present", None, required))
            continue
        gap = is_missing(df, name)
        stored = df.schema[name].dataType
        out.append(_Check(order, rule, "missing", gap, required))
        value = _typed_as(df, name, dtype, text)
        if dtype in SPARK_TYPE:
            from_text = text and isinstance(stored, T.StringType)
            if from_text:
                wrong = ~gap & value.isNull()
            elif in_family(stored, dtype):
                wrong = F.lit(False)
            else:
                wrong = ~gap  # a column without any value passes as any type
            out.append(_Check(order, rule, "type", wrong, True))
        if rule.get("allowed_values"):
            out.append(_Check(order, rule, "allowed",
                              ~_is_allowed(df, name, value, rule["allowed_values"], dtype, text), True))
        if rule.get("min") is not None:
            if is_numeric(stored) or (text and dtype in ("int", "float")):
                low = value < F.lit(rule["min"])
            elif dtype in ("int", "float"):
                low = F.lit(False)  # the type check above has failed already
            else:
                raise TypeError(f"Column '{name}' is no number, so it has no minimum")
            out.append(_Check(order, rule, "minimum", low, True))
    return out


def _is_allowed(df: DataFrame, name: str, value: Column, allowed: list, dtype: str | None,
                text: bool) -> Column:
    """Membership where a missing value is outside, like any other stranger.

    The values that can be members are those of the column's kind: as declared where text
    is still to be read, else as stored.
    """
    textual = isinstance(df.schema[name].dataType, T.StringType)
    if textual and text and dtype in ("int", "float"):
        textual = False
    same_kind = [v for v in allowed if v is not None and isinstance(v, str) == textual]
    if not same_kind:
        return F.lit(False)
    return F.coalesce(value.isin(same_kind), F.lit(False))


def _statuses(check: _Check, n: Column) -> Column:
    bad = F.lit("error" if check.fatal else "warning")
    return F.when(n > 0, bad).otherwise(F.lit("ok"))


def validation_report(df: DataFrame, rules: list[dict[str, Any]],
                      text: bool = False) -> DataFrame:
    """One row per check: rule_order, column, check, violations, status.

    ``text=True`` treats text columns as unparsed input and counts values that
    do not read as the declared type.
    """
    checks = _checks(df, rules, text)
    counted = [c for c in checks if c.hits is not None]
    one = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.count_if(c.hits).alias(f"v{i}") for i, c in enumerate(counted)])
    rows, i = [], 0
    for seq, c in enumerate(checks):
        if c.hits is None:
            n = F.lit(1).cast("long")
        else:
            n, i = F.col(f"v{i}"), i + 1
        rows.append(F.struct(
            F.lit(seq).cast("long").alias("check_order"),
            F.lit(c.order).cast("long").alias("rule_order"),
            F.lit(c.column).alias("column"), F.lit(c.kind).alias("check"),
            n.alias("violations"), _statuses(c, n).alias("status")))
    if not rows:
        return one.where(F.lit(False)).select(
            *[F.lit(None).cast(t).alias(n) for n, t in (
                ("check_order", "long"), ("rule_order", "long"), ("column", "string"),
                ("check", "string"), ("violations", "long"), ("status", "string"))])
    return one.select(F.inline(F.array(*rows)))


def validate_schema(df: DataFrame, rules: list[dict[str, Any]], text: bool = False) -> None:
    """Raise ``DataValidationError`` at the first violation in rule order."""
    # Absent columns before the first present one need no job at all.
    absent = next((c for c in _checks(df, rules, text)
                   if c.kind == "present" and c.fatal), None)
    if absent is not None and absent.order == 0:
        raise DataValidationError(absent.message(1))
    upto = rules if absent is None else rules[:absent.order]
    checks = _checks(df, upto, text)
    counted = [c for c in checks if c.hits is not None]
    row = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.count_if(c.hits).alias(f"v{i}") for i, c in enumerate(counted)]).first()
    i = 0
    for c in checks:
        if c.hits is None:
            n = 1
        else:
            n, i = row[f"v{i}"], i + 1
        if n and c.fatal:
            raise DataValidationError(c.message(n))
        if n:
            logger.warning(c.message(n))
    if absent is not None:
        raise DataValidationError(absent.message(1))


def violating_rows(df: DataFrame, rules: list[dict[str, Any]], text: bool = False) -> DataFrame:
    """Rows that break any rule, with ``violations``: the checks they break."""
    checks = [c for c in _checks(df, rules, text) if c.hits is not None and c.fatal]
    names = [F.when(F.coalesce(c.hits, F.lit(False)), F.lit(f"{c.column}:{c.kind}"))
             for c in checks]
    if not names:
        return df.where(F.lit(False)).withColumn("violations", F.lit(None).cast("string"))
    return df.withColumn("violations", F.concat_ws(",", *names)).where(
        F.col("violations") != "")
