"""A saved dictionary of label codes: fitted on one frame, applied to others and to streams.

The dictionary is a folder with a table of codes, partitioned by column, and a note that
names the columns, their types and sizes.  The note is written last, so a folder with a
note is whole.  Codes keep the order of the values, 0 for the smallest.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.missing import present
from ledgerspark.operators.prep import LOCAL_CODES, _codes, _sizes, _with_codes
from ledgerspark.sources import paths

#: The code of a value that the dictionary does not hold.
UNSEEN = -1


@dataclass
class LabelDictionary:
    """Codes of columns, kept under ``path``; the driver holds a few numbers per column."""

    spark: SparkSession
    path: str
    types: dict[str, str]
    sizes: dict[str, dict[str, int]]

    @classmethod
    def fit(cls, df: DataFrame, cols: list[str], path: str, ranges: int | None = None) -> LabelDictionary:
        """Count the values of all columns in one pass, number them in order and write them."""
        absent = [c for c in cols if c not in df.columns]
        if absent:
            raise ValueError(f"Missing columns to fit: {absent}")
        cols, path = list(dict.fromkeys(cols)), path.rstrip("/")
        if not cols:
            raise ValueError("A dictionary needs a column")
        placed = _codes(df, cols, ranges)
        found = _sizes(placed, df, cols)
        sizes = {c: found[i].asDict() if i in found else {"n": 0, "rows": 0, "size": 0} for i, c in enumerate(cols)}
        before, starts = 0, []
        for i, c in enumerate(cols):
            starts += [F.lit(i), F.lit(before)]
            before += sizes[c]["n"]
        code = F.col("_place") - F.create_map(*starts)[F.col("_i")]
        placed.withColumn("code", code.cast("long")).drop("_place").write.partitionBy("_i").parquet(f"{path}/codes")
        types = {c: df.schema[c].dataType.simpleString() for c in cols}
        note = json.dumps({"types": types, "sizes": {c: {k: s[k] for k in ("n", "rows", "size")} for c, s in sizes.items()}})
        df.sparkSession.createDataFrame([(note,)], "value string").coalesce(1).write.text(f"{path}/dictionary")
        return cls.load(df.sparkSession, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LabelDictionary:
        path = path.rstrip("/")
        paths.require(spark, f"{path}/dictionary", "label dictionary")
        note = json.loads(spark.read.text(f"{path}/dictionary", wholetext=True).first()[0])
        return cls(spark, path, note["types"], note["sizes"])

    def codes(self, col: str) -> DataFrame:
        """value, code, n_rows of one column: its own partition of the table only."""
        if col not in self.types:
            raise ValueError(f"The dictionary has no column '{col}'")
        kinds = list(dict.fromkeys(self.types.values()))
        fields = ", ".join([*(f"_v{n} {k}" for n, k in enumerate(kinds)), "n_rows bigint", "code bigint", "_i int"])
        held = self.spark.read.schema(fields).parquet(f"{self.path}/codes")
        own = held.where(F.col("_i") == list(self.types).index(col))
        return own.select(F.col(f"_v{kinds.index(self.types[col])}").alias("value"), "code", "n_rows")

    def encode(self, df: DataFrame, cols: list[str] | None = None, unseen: int | None = UNSEEN,
               local_limit: int = LOCAL_CODES) -> DataFrame:
        """Each column by its codes; NULL stays NULL and a value not fitted becomes ``unseen``.

        Columns of the dictionary that the frame lacks are skipped.  The frame may be a
        stream: its rows are joined to the stored codes, and no state is kept.
        """
        cols = self._among(df, cols)
        for c in cols:
            if df.schema[c].dataType.simpleString() != self.types[c]:
                raise ValueError(f"Column '{c}' was fitted as {self.types[c]}")

        def made(out: DataFrame, c: str, code: str) -> Column:
            return F.when(present(out, c).isNotNull(), F.coalesce(F.col(code), F.lit(unseen).cast("long")))

        return self._joined(df, cols, {c: self.codes(c) for c in cols}, local_limit, made)

    def decode(self, df: DataFrame, cols: list[str] | None = None, local_limit: int = LOCAL_CODES) -> DataFrame:
        """Each column of codes by its values; a code that the dictionary lacks becomes NULL."""
        cols = self._among(df, cols)
        swapped = {c: self.codes(c).select(F.col("code").alias("value"), F.col("value").alias("code"), "n_rows") for c in cols}
        return self._joined(df, cols, swapped, local_limit, lambda out, c, value: F.col(value).cast(self.types[c]))

    def _among(self, df: DataFrame, cols: list[str] | None) -> list[str]:
        strange = [c for c in cols or [] if c not in self.types]
        if strange:
            raise ValueError(f"The dictionary has no columns {strange}")
        return [c for c in (self.types if cols is None else dict.fromkeys(cols)) if c in df.columns]

    def _joined(self, df: DataFrame, cols: list[str], codes: dict[str, DataFrame], local_limit: int, made) -> DataFrame:
        out = df
        for i, c in enumerate(cols):
            size = self.sizes[c] if self.sizes[c]["n"] else None
            out = _with_codes(out, c, i, codes[c], size, local_limit)
        done = {c: made(out, c, f"_code{i}").alias(c) for i, c in enumerate(cols)}
        return out.select(*[done.get(c, F.col(f"`{c}`")) for c in df.columns])


__all__ = ["UNSEEN", "LabelDictionary"]
