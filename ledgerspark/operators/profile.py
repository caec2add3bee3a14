"""Whole-table profiles: shape, duplicates, description, fingerprint."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.functions.missing import nan_to_null, present
from ledgerspark.schema import is_float
from ledgerspark.sources.scratch import materialize
from ledgerspark.sources.small import small_table

SKETCH = 4_096  # entries of a rank sketch
# A sketch of k entries is off by 2.296 / k ** 0.9723 of the rows, 99 times of 100.
RANK_ERROR, RANK_POWER = 2.296, 0.9723
SKETCH_GROUPS = 64  # groups of tasks whose sketches are merged apart
FETCHED_VALUES = 100_000  # values of one column or bracket that a task may sort
QUARTILES = (0.25, 0.5, 0.75)


def shape(df: DataFrame) -> DataFrame:
    """One row: n_rows, n_cols, columns (comma-joined), is_empty."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).cast("long").alias("n_cols"),
        F.lit(",".join(df.columns)).alias("columns"),
        (F.col("n_rows") == 0).alias("is_empty"),
    )


def _as_text(df: DataFrame, name: str) -> Column:
    """A value as text that is equal exactly when the values are."""
    c = F.col(f"`{name}`")
    if is_float(df.schema[name].dataType):
        c = F.when(c == 0, F.lit(0.0)).otherwise(present(df, name))  # -0.0 is 0.0
    return c.cast("string")


def _digest_text(df: DataFrame, cols: list[str] | None = None) -> Column:
    """SHA-256 of a row as hex text, with lengths and gaps marked so that no two rows mix."""
    parts = []
    for name in cols or df.columns:
        text = _as_text(df, name)
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text),
                                F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def row_digest(df: DataFrame, cols: list[str] | None = None) -> Column:
    return F.unhex(_digest_text(df, cols))


def duplicates(df: DataFrame) -> DataFrame:
    """One row: n_rows and n_duplicates, rows equal to an earlier one.

    Missing equals missing.  Rows are compared by a 256-bit digest, so the
    shuffle moves 32 bytes per distinct row instead of the row, and copies merge
    before it.
    """
    groups = df.select(row_digest(df).alias("digest")).groupBy("digest")
    return groups.agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"),
    )


_WORDS, _DIGITS, _HALF = 4, 11, 22  # words of a digest, their hex digits, bits of half a word
_SUMS = [f"s{i}" for i in range(2 * _WORDS)]


def fingerprint_parts(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """by, n_rows, s0 to s7: what the fingerprint of a table that changes is made of, per group of rows.

    Each row gives its SHA-256, with lengths and gaps marked.  Four 44-bit words of it are
    added up in halves of 22 bits, so a sum of whole numbers holds 2 ** 41 rows.  Parts of
    separate rows add up, and what a removed group gave can be subtracted.
    """
    by = by or []
    rows = df.select(*[f"`{c}`" for c in by], _digest_text(df).alias("_digest"))
    words = [F.conv(F.substring("_digest", 1 + _DIGITS * i, _DIGITS), 16, 10).cast("long").alias(f"_w{i}")
             for i in range(_WORDS)]
    rows = rows.select(*[f"`{c}`" for c in by], *words)
    low = (1 << _HALF) - 1
    halves = [h for i in range(_WORDS) for h in (
        F.col(f"_w{i}").bitwiseAND(F.lit(low)), F.shiftright(f"_w{i}", _HALF))]
    return rows.groupBy(*[f"`{c}`" for c in by]).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.coalesce(F.sum(h), F.lit(0)).alias(s) for h, s in zip(halves, _SUMS)])


def merged_parts(added: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """The parts of all rows together: those added, less those removed."""
    names = ["n_rows", *_SUMS]
    every = added.select(*names)
    if removed is not None:
        every = every.unionByName(removed.select(*[(-F.col(c)).alias(c) for c in names]))
    return every.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])


def fingerprint_of_parts(parts: DataFrame, columns: int) -> DataFrame:
    """n_rows and the hash of parts that were merged; compares with others made of parts only."""
    text = [F.col(c).cast("string") for c in ("n_rows", *_SUMS)]
    return parts.select("n_rows", F.sha2(F.concat_ws("|", F.lit(str(columns)), *text), 256).alias("fingerprint"))


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: n_rows and a hash that is equal for equal data in any row order.

    Each row gives its SHA-256, with lengths and gaps marked.  The whole digest is read as
    five numbers; the count of rows and each number's sum and exclusive-or are hashed.
    """
    digest = df.select(_digest_text(df).alias("_digest"))
    words = digest.select(*[
        F.conv(F.substring("_digest", 1 + 13 * i, 13), 16, 10).cast("long").alias(f"_w{i}") for i in range(5)])
    # A sum of 52-bit numbers passes a bigint from 2,048 rows on, so their halves are added up.
    low, totals, text = (1 << 26) - 1, [F.count(F.lit(1)).alias("n_rows")], [F.col("n_rows").cast("string")]
    for i in range(5):
        w = F.col(f"_w{i}")
        totals += [F.coalesce(c, F.lit(0)).alias(f"_{k}{i}") for k, c in (
            ("l", F.sum(w.bitwiseAND(F.lit(low)))), ("h", F.sum(F.shiftright(w, 26))), ("x", F.bit_xor(w)))]
        added = F.col(f"_h{i}").cast("decimal(20,0)") * F.lit(low + 1).cast("decimal(10,0)") + F.col(f"_l{i}")
        text += [added.cast("string"), F.col(f"_x{i}").cast("string")]
    return words.agg(*totals).select(
        "n_rows", F.sha2(F.concat_ws("|", F.lit(str(len(df.columns))), *text), 256).alias("fingerprint"))


# ----------------------------------------------------------------- describe

_KINDS = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("n_unique", T.LongType()),
    T.StructField("top", T.StringType()),
    T.StructField("freq", T.LongType()),
    *[T.StructField(k, T.DoubleType())
      for k in ("mean", "std", "min", "p25", "p50", "p75", "max")],
])


_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def temporal_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, _TEMPORAL)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def describe(df: DataFrame, exact: bool = True) -> DataFrame:
    """One row per column, in column order.

    Numbers: n, mean, sample std, min, quartiles with linear interpolation, max.
    Dates and timestamps: the same, in seconds since 1970 (of the value as it is
    written, where it has no zone).  Everything else: n, n_unique, top, freq (ties to
    the smallest), of its text.  With ``exact=False`` the quartiles are approximate
    and found in one pass.
    """
    measured = [*numeric_columns(df), *temporal_columns(df)]
    others = [c for c in df.columns if c not in measured]
    numbers = {r[0]: r for r in _number_rows(df, measured, exact)}
    texts = {r[0]: r for r in _text_rows(df, others)}
    rows = [numbers.get(c) or texts.get(c) for c in df.columns]
    return small_table(df.sparkSession, rows, _KINDS)


def _number(df: DataFrame, name: str) -> Column:
    """A number, date or timestamp as a double; missing is NULL."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double") * 86400
    if isinstance(kind, T.TimestampNTZType):
        whole = F.unix_micros(F.convert_timezone(F.lit("UTC"), F.current_timezone(), c).cast("timestamp"))
        return whole / F.lit(1e6)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c) / F.lit(1e6)
    return present(df, name).cast("double")


def _plain_text(df: DataFrame, name: str) -> Column:
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    return F.base64(c) if isinstance(kind, T.BinaryType) else c.cast("string")


def describe_numeric(df: DataFrame, cols: list[str] | None = None,
                     exact: bool = True) -> DataFrame:
    cols = numeric_columns(df) if cols is None else cols
    return small_table(df.sparkSession, _number_rows(df, cols, exact), _KINDS).drop(
        "n_unique", "top", "freq")


def describe_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = text_columns(df) if cols is None else cols
    return small_table(df.sparkSession, _text_rows(df, cols), _KINDS).select(
        "column", "n", "n_unique", "top", "freq")


def _number_rows(df: DataFrame, cols: list[str], exact: bool) -> list[tuple]:
    """Moments and a rank sketch of all columns from one pass, merged in ``SKETCH_GROUPS`` groups."""
    if not cols:
        return []
    df = df.select(*[_number(df, c).alias(f"c{i}") for i, c in enumerate(cols)])
    names, aggs = df.columns, []
    for c in names:
        aggs += [F.count(c).alias(f"n_{c}"), F.sum(c).alias(f"sum_{c}"), F.var_pop(c).alias(f"var_{c}"),
                 F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"),
                 F.kll_sketch_agg_double(c, F.lit(SKETCH)).alias(c)]
    parts = materialize(df.groupBy(_task_group()).agg(*aggs), "stats")
    groups = parts.drop("_group", *names).collect()  # at most SKETCH_GROUPS rows
    stats = {c: _merged_moments(groups, c) for c in names}
    sketches = _merged_sketches(parts, names)
    if exact:
        got = percentiles(df, QUARTILES, {c: s[0] for c, s in stats.items()}, sketches=sketches)
    else:
        got = {c: [None] * len(QUARTILES) for c in names}
        filled = [c for c in names if stats[c][0]]
        if filled:
            row = sketches.select(*[_at_shares(c, QUARTILES).alias(c) for c in filled]).first()
            got.update({c: list(row[c]) for c in filled})
    out = []
    for name, c in zip(cols, names):
        n, mean, sd, low, high = stats[c]
        out.append((name, n, None, None, None, mean, sd, low, *got[c], high))
    return out


def _task_group() -> Column:
    return (F.spark_partition_id() % SKETCH_GROUPS).alias("_group")


def _merged_moments(groups: list, c: str) -> tuple:
    """n, mean, sample deviation, min and max of a column from those of its groups."""
    held = [g for g in groups if g[f"n_{c}"]]
    n = sum(g[f"n_{c}"] for g in held)
    if not n:
        return 0, None, None, None, None
    mean = sum(g[f"sum_{c}"] for g in held) / n
    squares = sum(g[f"n_{c}"] * (g[f"var_{c}"] + (g[f"sum_{c}"] / g[f"n_{c}"] - mean) ** 2) for g in held)
    sd = math.sqrt(squares / (n - 1)) if n > 1 else None
    return n, mean, sd, min(g[f"lo_{c}"] for g in held), max(g[f"hi_{c}"] for g in held)


def _merged_sketches(parts: DataFrame, cols: list[str]) -> DataFrame:
    return parts.agg(*[F.kll_merge_agg_double(c).alias(c) for c in cols])


def _at_shares(sketch: str, shares) -> Column:
    """The values that a sketch has at shares of its rows."""
    return F.kll_sketch_get_quantile_double(F.col(sketch), F.array(*[F.lit(float(s)) for s in shares]))


def percentiles(df: DataFrame, probs, counts: dict[str, int], *, sketches: DataFrame | None = None,
                fetched: int = FETCHED_VALUES, entries: int = SKETCH) -> dict[str, list]:
    """Exact percentiles (linear interpolation) of double columns; ``counts``: their values.

    One way for all columns and sizes.  A mergeable rank sketch brackets each wanted rank by
    twice its error (99 of 100 times it keeps to it once), one pass counts what lies below, on
    and between the ends, and one pass stores what lies between: with 4,096 entries some 0.3 %
    of the rows a rank.  Of up to ``fetched`` values the wanted one is taken in a task of its
    own; of more, the same is done again with the stored values.  The counts are exact, so a
    bracket that misses its rank costs one more turn and no error.  Frequent values end on an
    end of the bracket and are never stored.
    """
    ranks = {c: sorted({f(p * (n - 1)) for p in probs for f in (math.floor, math.ceil)}) for c, n in counts.items() if n}
    at = _at_ranks(df, {c: (counts[c], {(c, k): k for k in ks}) for c, ks in ranks.items()}, sketches, fetched, entries)
    out: dict[str, list] = {c: [None] * len(probs) for c, n in counts.items() if n == 0}
    for c in ranks:
        places = [p * (counts[c] - 1) for p in probs]
        ends = [(at[c, math.floor(x)], at[c, math.ceil(x)]) for x in places]
        out[c] = [lo + (hi - lo) * (x - math.floor(x)) for x, (lo, hi) in zip(places, ends)]
    return out


def _at_ranks(df: DataFrame, wanted: dict[str, tuple[int, dict]], sketches: DataFrame | None,
              fetched: int, entries: int) -> dict:
    """The value at each rank (from 0) of a column.

    ``wanted``: per column how many values it has, and ranks by the name they are asked for.
    """
    found: dict = {}
    while wanted:
        few = {c: w for c, w in wanted.items() if w[0] <= fetched}
        found.update(_fetched(df, few))
        many = {c: w for c, w in wanted.items() if c not in few}
        if not many:
            break
        if sketches is None:
            sketch = [F.kll_sketch_agg_double(c, F.lit(entries)).alias(c) for c in many]
            sketches = _merged_sketches(df.groupBy(_task_group()).agg(*sketch), list(many))
        hit, open_ = _bracketed(df, many, sketches, entries)
        found.update(hit)
        inside = F.array_compact(F.array(*[
            F.when(_between(*span), F.struct(F.lit(j).alias("slot"), F.col(span[0]).alias("v")))
            for j, span in enumerate(open_)]))
        if not open_:
            break
        stored = materialize(df.select(F.explode(inside).alias("p")).select("p.*"), "bracket")
        df = stored.select(*[F.when(F.col("slot") == j, F.col("v")).alias(f"c{j}") for j in range(len(open_))])
        wanted = {f"c{j}": w for j, w in enumerate(open_.values())}
        sketches = None
    return found


def _between(c: str, low: float | None, high: float | None) -> Column:
    test = F.col(c).isNotNull()
    if low is not None:
        test = test & (F.col(c) > F.lit(low))
    return test if high is None else test & (F.col(c) < F.lit(high))


def _fetched(df: DataFrame, wanted: dict[str, tuple[int, dict]]) -> dict:
    """Values at ranks of columns with few values, each column sorted in a task of its own."""
    if not wanted:
        return {}
    values = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull(), F.struct(
            F.lit(i).alias("i"), F.array(*[F.lit(k) for k in ranks.values()]).alias("ranks"), F.col(c).alias("v")))
        for i, (c, (_, ranks)) in enumerate(wanted.items())]))
    rows = (
        df.select(F.explode(values).alias("p")).select("p.*").groupBy("i", "ranks")
        .agg(F.array_sort(F.collect_list("v")).alias("vs"))
        .select("i", F.transform("ranks", lambda k: F.get("vs", k)).alias("at")).collect()
    )
    columns = list(wanted.values())
    return {tag: v for r in rows for tag, v in zip(columns[r["i"]][1], r["at"])}


def _bracketed(df: DataFrame, wanted: dict[str, tuple[int, dict]], sketches: DataFrame,
               entries: int) -> tuple[dict, dict]:
    """Ranks that fell on an end of their bracket, and the open intervals that hold the others.

    An interval is (column, low, high) with the number of its values and the ranks within it.
    """
    slack = 2 * RANK_ERROR / entries**RANK_POWER
    spans = []  # column, its number of values, ranks that lie side by side
    for c, (n, ranks) in wanted.items():
        last = None
        for tag, k in sorted(ranks.items(), key=lambda t: t[1]):
            if last is None or k > last + 1:
                spans.append((c, n, {}))
            spans[-1][2][tag] = last = k
    guess = sketches.select(*[
        _at_shares(c, (max(0.0, min(ks.values()) / n - slack), min(1.0, (max(ks.values()) + 1) / n + slack))).alias(f"g{i}")
        for i, (c, n, ks) in enumerate(spans)]).first()
    aggs = []
    for i, (name, _, _) in enumerate(spans):
        c, (lo, hi) = F.col(name), guess[f"g{i}"]
        aggs += [F.count_if(c < lo).alias(f"below{i}"), F.count_if(c == lo).alias(f"lo{i}"),
                 F.count_if((c > lo) & (c < hi)).alias(f"mid{i}"), F.count_if((c == hi) & F.lit(hi > lo)).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    hit, open_ = {}, {}
    for i, (c, n, ks) in enumerate(spans):
        lo, hi = guess[f"g{i}"]
        below, on, mid, top = itertools.accumulate(row[f"{k}{i}"] for k in ("below", "lo", "mid", "hi"))
        for tag, k in ks.items():
            if below <= k < on or mid <= k < top:
                hit[tag] = lo if k < on else hi
                continue
            span, start, end = (((c, None, lo), 0, below) if k < below else
                                ((c, lo, hi), on, mid) if k < mid else ((c, hi, None), top, n))
            open_.setdefault(span, (end - start, {}))[1][tag] = k - start
    return hit, open_


def _text_rows(df: DataFrame, cols: list[str]) -> list[tuple]:
    """Counts per value for all columns in one shuffle, copies merged before it."""
    if not cols:
        return []
    pairs = F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), _plain_text(df, c).alias("v"))
        for i, c in enumerate(cols)]))
    counts = (
        df.select(pairs.alias("p")).select("p.i", "p.v")
        .where(F.col("v").isNotNull())
        .groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    aggs = []
    for i in range(len(cols)):
        mine = F.col("i") == i
        best = F.min(F.when(mine, F.struct((-F.col("n")).alias("n"), F.col("v").alias("v"))))
        aggs += [F.sum(F.when(mine, F.col("n"))).alias(f"n{i}"),
                 F.count_if(mine).alias(f"u{i}"), best.alias(f"b{i}")]
    row = counts.agg(*aggs).first()
    return [
        (c, row[f"n{i}"] or 0, row[f"u{i}"],
         row[f"b{i}"] and row[f"b{i}"]["v"], row[f"b{i}"] and -row[f"b{i}"]["n"],
         *[None] * 7)
        for i, c in enumerate(cols)
    ]


def profile(df: DataFrame, exact: bool = True) -> dict[str, DataFrame]:
    """Everything above for one table: shape, duplicates, description, hash."""
    df = nan_to_null(df)
    return {
        "shape": shape(df),
        "duplicates": duplicates(df),
        "describe": describe(df, exact),
        "fingerprint": fingerprint(df),
    }
