"""Column transforms fitted by aggregation: encode, impute, scale, one-hot.

``fit`` runs a fixed number of aggregations and keeps small statistics on the
driver; ``transform`` is a projection.  Fit on the training rows and apply to
any other frame, or fit and apply on the same one.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.missing import present
from ledgerspark.operators.ordered import with_rank
from ledgerspark.operators.project import input_features
from ledgerspark.sources.scratch import materialize

# A column's codes are broadcast up to this many values and this many bytes of them.
LOCAL_CODES = 100_000
LOCAL_BYTES = 8_000_000
# Named one-hot columns are for few categories; ``onehot_sparse`` takes any number.
NAMED_CATEGORIES = 5_000
# A value held by more than this share of rows is joined apart from the rest.
HOT_SHARE = 1 / 200
# Rows that a shuffled join has nothing to give to are spread over so many keys.
SPREAD = 1_000


# ------------------------------------------------------------ label encoding

def label_encode(df: DataFrame, cols: list[str], local_limit: int = LOCAL_CODES,
                 ranges: int | None = None) -> DataFrame:
    """Replace each column by the position of its value among the sorted values.

    Listed columns that do not exist are skipped; NULL stays NULL.  The values of all
    columns are counted in one pass over the frame, and the result reads it once more.
    """
    cols = [c for c in dict.fromkeys(cols) if c in df.columns]
    if not cols:
        return df
    codes = _codes(df, cols, ranges)
    sizes = _sizes(codes, df, cols)
    out = df
    for i, c in enumerate(cols):
        before = sum(r["n"] for k, r in sizes.items() if k < i)
        out = _with_codes(out, c, i, _of(codes, df, cols, i, before), sizes.get(i), local_limit)
    done = {c: F.col(f"_code{i}").alias(c) for i, c in enumerate(cols)}
    return out.select(*[done.get(c, F.col(f"`{c}`")) for c in df.columns])


def label_codes(df: DataFrame, col: str, local_limit: int = LOCAL_CODES,
                ranges: int | None = None) -> DataFrame:
    """The codes of a column as a table (value, code, n_rows), 0 for the smallest."""
    return _of(_codes(df, [col], ranges), df, [col], 0, 0)


def _kinds(df: DataFrame, cols: list[str]) -> list[str]:
    """The types of the columns, each once; values of one type share a field."""
    return list(dict.fromkeys(df.schema[c].dataType.simpleString() for c in cols))


def _codes(df: DataFrame, cols: list[str], ranges: int | None) -> DataFrame:
    """Stored: column number, value (in the field of its type), n_rows, place in the order."""
    kinds = _kinds(df, cols)
    entries = []
    for i, c in enumerate(cols):
        own = df.schema[c].dataType.simpleString()
        fields = [(present(df, c) if k == own else F.lit(None).cast(k)).alias(f"_v{n}")
                  for n, k in enumerate(kinds)]
        entries.append(F.struct(F.lit(i).alias("_i"), *fields))
    fields = [f"_v{n}" for n in range(len(kinds))]
    counts = (
        df.select(F.explode(F.array(*entries)).alias("p")).select("p.*")
        .where(" OR ".join(f"{f} IS NOT NULL" for f in fields))
        .groupBy("_i", *fields).agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return materialize(with_rank(materialize(counts, "values"), ["_i", *fields], "_place", ranges), "codes")


def _of(codes: DataFrame, df: DataFrame, cols: list[str], i: int, before: int) -> DataFrame:
    """value, code, n_rows of one column; ``before`` values of earlier columns precede it."""
    field = f"_v{_kinds(df, cols).index(df.schema[cols[i]].dataType.simpleString())}"
    return codes.where(F.col("_i") == i).select(
        F.col(field).alias("value"), (F.col("_place") - F.lit(before)).alias("code"), "n_rows")


def _sizes(codes: DataFrame, df: DataFrame, cols: list[str]) -> dict:
    """Per column: how many values, rows that have one, and bytes of the values as text."""
    size = sum(F.coalesce(F.length(F.col(f"_v{n}").cast("string")), F.lit(0))
               for n in range(len(_kinds(df, cols))))
    rows = codes.groupBy("_i").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_rows").alias("rows"), F.sum(size).alias("size"))
    return {r["_i"]: r for r in rows.collect()}


def _with_codes(df: DataFrame, col: str, i: int, codes: DataFrame, size, local_limit: int) -> DataFrame:
    """The frame with ``_code<i>``; it appears once in the plan."""
    out, key = f"_code{i}", f"_value{i}"
    if size is None:  # no value at all
        return df.withColumn(out, F.lit(None).cast("long"))
    codes = codes.withColumnsRenamed({"value": key, "code": out})
    keyed = df.withColumn(key, present(df, col))
    if size["n"] <= local_limit and size["size"] <= LOCAL_BYTES:
        return keyed.join(F.broadcast(codes.select(key, out)), key, "left").drop(key)
    # A frequent value would send its rows to one task of a shuffled join.  At most
    # 1 / HOT_SHARE values can be that frequent, so those few are broadcast.  Their rows,
    # and rows without a value, then take part under keys that nothing matches.
    hot = F.col("n_rows") > F.lit(size["rows"] * HOT_SHARE)
    frequent = codes.where(hot).select(key, F.col(out).alias("_hot"))
    others = codes.where(~hot).select(key, F.lit(0).alias("_spread"), out)
    served = keyed.join(F.broadcast(frequent), key, "left")
    rest = F.col("_hot").isNull() & F.col(key).isNotNull()
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if not c.startswith("_")]), F.lit(SPREAD)) + 1
    served = served.withColumns({
        key: F.when(rest, F.col(key)), "_spread": F.when(rest, F.lit(0)).otherwise(spread.cast("int"))})
    return served.join(others, [key, "_spread"], "left").withColumn(
        out, F.coalesce("_hot", out)).drop(key, "_spread", "_hot")


# ------------------------------------------------------- impute, scale, one-hot

@dataclass
class NumericStats:
    mean: float
    sd: float  # population, of the column after its gaps took the mean
    low: float
    high: float


@dataclass
class CategoryStats:
    mode: str
    values: list = field(default_factory=list)


@dataclass
class TabularPrepModel:
    """Fitted statistics; everything needed to transform, and nothing more."""

    numeric: dict[str, NumericStats]
    categorical: dict[str, CategoryStats]
    scaling: str = "standard"
    scalings: dict[str, str] = field(default_factory=dict)  # of columns that have their own

    @property
    def output_names(self) -> list[str]:
        """Numeric names in configured order, then ``column_value``.

        Names that differ by case only could not be told apart later: from the second on
        they end in a number.
        """
        out: list[str] = []
        taken: set[str] = set()
        for name in [*self.numeric, *(f"{c}_{v}" for c, s in self.categorical.items() for v in s.values)]:
            own, k = name, 1
            while own.lower() in taken:
                k += 1
                own = f"{name}_{k}"
            taken.add(own.lower())
            out.append(own)
        return out

    def columns(self, df: DataFrame) -> list[Column]:
        """The output columns as expressions over ``df``."""
        out = [self._scaled(df, c) for c in self.numeric]
        for c, stats in self.categorical.items():
            value = F.coalesce(F.col(f"`{c}`"), F.lit(stats.mode))
            out += [(value == F.lit(v)).cast("double") for v in stats.values]
        return [c.alias(n) for c, n in zip(out, self.output_names)]

    def _scaled(self, df: DataFrame, c: str) -> Column:
        s = self.numeric[c]
        value = F.coalesce(present(df, c).cast("double"), F.lit(s.mean))
        how = self.scalings.get(c, self.scaling)
        if how == "none":
            return value
        if s.low == s.high:  # also decides a constant whose sum was rounded
            return value - F.lit(s.low)
        if how == "minmax":
            return (value - F.lit(s.low)) / F.lit(s.high - s.low)
        return (value - F.lit(s.mean)) / F.lit(s.sd)

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Output columns only, after the ``keep`` columns of the input row."""
        absent = [c for c in (*self.numeric, *self.categorical) if c not in df.columns]
        if absent:
            raise ValueError(f"Missing columns to transform: {absent}")
        held = [F.col(f"`{c}`") for c in keep or []]
        return df.select(*held, *self.columns(df))

    def append_vector(self, df: DataFrame, out: str = "features",
                      select: list[str] | None = None) -> DataFrame:
        """The row as it is, plus the chosen outputs as one vector."""
        names = self.output_names if select is None else select
        absent = [c for c in (*self.numeric, *self.categorical) if c not in df.columns]
        if absent:
            raise ValueError(f"Missing columns to transform: {absent}")
        columns = {n: c for n, c in zip(self.output_names, self.columns(df))}
        work = df.select("*", *[columns[n].alias(f"_prep_{i}") for i, n in enumerate(names)])
        made = [f"_prep_{i}" for i in range(len(names))]
        vector = VectorAssembler(inputCols=made, outputCol=out, handleInvalid="error")
        return vector.transform(work).drop(*made)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> TabularPrepModel:
        raw = json.loads(text)
        return cls(
            {c: NumericStats(**s) for c, s in raw["numeric"].items()},
            {c: CategoryStats(**s) for c, s in raw["categorical"].items()},
            raw["scaling"],
            raw.get("scalings", {}),
        )


@dataclass
class TabularPrep:
    """Mean-impute and scale numbers; mode-impute and one-hot categories.

    Columns listed nowhere are dropped; an empty list leaves its branch out.  ``scalings``
    names columns that are scaled in a way of their own; in the settings it is the entry
    ``normalization`` under the column's name.
    """

    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    scaling: str = "standard"
    scalings: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_conf(cls, conf: dict) -> TabularPrep:
        cfg = conf.get("preprocessing", {})
        numeric = list(cfg.get("numeric") or [])
        own = {c: cfg[c]["normalization"] for c in numeric
               if isinstance(cfg.get(c), dict) and cfg[c].get("normalization")}
        return cls(numeric, list(cfg.get("categorical") or []), cfg.get("scaling") or "standard", own)

    def fit(self, df: DataFrame) -> TabularPrepModel:
        for how in (self.scaling, *self.scalings.values()):
            if how not in ("standard", "minmax", "none"):
                raise ValueError(f"Unknown scaling: {how}")
        absent = [c for c in (*self.numeric, *self.categorical) if c not in df.columns]
        if absent:
            raise ValueError(f"Missing columns to fit: {absent}")
        return TabularPrepModel(
            self._fit_numeric(df), self._fit_categorical(df), self.scaling, dict(self.scalings))

    def _fit_numeric(self, df: DataFrame) -> dict[str, NumericStats]:
        if not self.numeric:
            return {}
        aggs = [F.count(F.lit(1)).alias("n")]
        for i, c in enumerate(self.numeric):
            v = present(df, c).cast("double")
            aggs += [
                F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"),
                F.stddev_pop(v).alias(f"s{i}"),
                F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}"),
            ]
        row = df.agg(*aggs).first()
        out = {}
        for i, c in enumerate(self.numeric):
            if not row[f"n{i}"]:
                raise ValueError(f"Column '{c}' has no value to fit on")
            # Gaps filled with the mean add no deviation, only rows.
            sd = row[f"s{i}"] * math.sqrt(row[f"n{i}"] / row["n"])
            out[c] = NumericStats(row[f"m{i}"], sd, row[f"l{i}"], row[f"h{i}"])
        return out

    def _fit_categorical(self, df: DataFrame) -> dict[str, CategoryStats]:
        if not self.categorical:
            return {}
        pairs = F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("string").alias("v"))
            for i, c in enumerate(self.categorical)
        ]))
        counts = (
            df.select(pairs.alias("p")).select("p.i", "p.v")
            .where(F.col("v").isNotNull())
            .groupBy("i", "v").count()
        )
        # One more category than allowed tells that a column has too many; it is refused
        # by name, and no other column pays for it.
        place = F.row_number().over(Window.partitionBy("i").orderBy("v"))
        rows = counts.withColumn("place", place).where(
            F.col("place") <= NAMED_CATEGORIES + 1).collect()
        out = {}
        for i, c in enumerate(self.categorical):
            mine = {r["v"]: r["count"] for r in rows if r["i"] == i}
            if len(mine) > NAMED_CATEGORIES:
                raise ValueError(
                    f"Column '{c}' has too many categories for named one-hot columns; "
                    "label-encode it or use onehot_sparse")
            if not mine:
                raise ValueError(f"Column '{c}' has no value to fit on")
            mode = min(mine, key=lambda v: (-mine[v], v))
            out[c] = CategoryStats(mode, sorted(mine))
        return out


def modes(df: DataFrame, cols: list[str]) -> dict[str, str]:
    """The most frequent value of each column as text, the smallest on ties.

    Values are counted before and after one shuffle; only the winners reach the driver.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("string").alias("v"))
        for i, c in enumerate(cols)]))
    counts = df.select(pairs.alias("p")).select("p.i", "p.v").where("v IS NOT NULL").groupBy("i", "v").count()
    best = counts.groupBy("i").agg(F.min(F.struct((-F.col("count")).alias("n"), F.col("v").alias("v"))).alias("b"))
    found = {r["i"]: r["b"]["v"] for r in best.collect()}
    for i, c in enumerate(cols):
        if i not in found:
            raise ValueError(f"Column '{c}' has no value to fit on")
    return {c: found[i] for i, c in enumerate(cols)}


def onehot_sparse(df: DataFrame, cols: list[str]) -> DataFrame:
    """Append ``<column>_onehot``: a sparse vector with a place per value, in their order.

    For columns with any number of categories; a gap takes the most frequent value.
    """
    filled = impute_mode(df, cols)
    codes = [f"{c}_code" for c in cols]
    coded = label_encode(filled.withColumns({k: F.col(f"`{c}`") for k, c in zip(codes, cols)}), codes)
    hot = OneHotEncoder(inputCols=codes, outputCols=[f"{c}_onehot" for c in cols], dropLast=False)
    return hot.fit(coded).transform(coded).drop(*codes)


def fit_apply(train: DataFrame, others: list[DataFrame | None], conf: dict,
              keep: list[str] | None = None):
    """Fit on ``train`` and transform it and the others; None passes through."""
    model = TabularPrep.from_conf(conf).fit(train)
    done = [f if f is None else model.transform(f, keep) for f in (train, *others)]
    return (*done, model)


def impute_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    """Each gap in a numeric column takes the column's mean."""
    model = TabularPrep(numeric=cols, scaling="none").fit(df)
    return df.withColumns({c: model._scaled(df, c) for c in cols})


def impute_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    """Each gap takes the column's most frequent value, the smallest on ties."""
    found = modes(df, cols)
    return df.withColumns({
        c: F.coalesce(F.col(f"`{c}`"), F.lit(v).cast(df.schema[c].dataType)) for c, v in found.items()})


def scale(df: DataFrame, cols: list[str], how: str = "standard", own: dict[str, str] | None = None) -> DataFrame:
    """Standard (population) or min-max scaling, gaps at the mean; ``own`` names it per column."""
    model = TabularPrep(numeric=cols, scaling=how, scalings=own or {}).fit(df)
    return df.withColumns({c: model._scaled(df, c) for c in cols})


def preprocess(df: DataFrame, conf: dict, keep: list[str] | None = None):
    """Label-encode, fit on the whole table, transform, keep engineered columns.

    Returns (table, fitted model).  ``keep`` adds id columns to the target,
    which stays in the row throughout.
    """
    target = conf["target"]
    held = [*(keep or []), target]
    encoded = label_encode(
        df, [c for c in conf.get("preprocessing", {}).get("label_encode", []) if c not in held])
    model = TabularPrep.from_conf(conf).fit(encoded)
    clash = set(held) & set(model.output_names)
    if clash:
        raise ValueError(f"Kept columns must not be transform outputs: {sorted(clash)}")
    done = model.transform(encoded, held)
    chosen = input_features(done.columns, conf, among=model.output_names)
    return done.select(*[f"`{c}`" for c in (*held, *chosen)]), model
