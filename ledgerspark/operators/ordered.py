"""Work that follows a global row order, without a task that sees every row.

Spark can sort a table over many tasks but has no window that runs across them.
The helpers here cut the order into key ranges.  The range of a row is a pure
function of its key, so it is the same in every job and after any retry, and one
hot key cannot swell a range as long as the whole order key is unique.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.sources.scratch import materialize
from ledgerspark.sources.small import small_table

RANGES_PER_TASK = 4
ROWS_PER_RANGE = 2_000_000
SAMPLES_PER_RANGE = 8
TASK_SAMPLES = 1_024
#: Ranges that one row of the directory holds; the first level has a cut per such row.
FINE = 256
#: The directory is broadcast up to this size and joined by a shuffle beyond.
DIRECTORY_BYTES = 32 << 20
RANGE = "_range"


def range_count(df: DataFrame, total: int) -> int:
    """How many key ranges to cut: a few per shuffle task, and none too long for one.

    Ranges go to tasks by hash; several small ones per task even out its load.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, RANGES_PER_TASK * tasks, -(-total // ROWS_PER_RANGE))


def _sampled(keys: DataFrame) -> DataFrame:
    """Keys at even steps through each task's rows, beside the rows each stands for (``_rows``).

    A task keeps ``TASK_SAMPLES`` to twice as many of them, so one pass gives the sample and the
    number of rows, whatever the number of rows is.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, step, n = [], 0, 1, 0
        for batch in batches:
            part = batch.take(pa.array(np.arange(-n % step, batch.num_rows, step)))
            n += batch.num_rows
            held.append(part)
            size += part.num_rows
            if size > 2 * TASK_SAMPLES:
                t = pa.Table.from_batches(held)
                while t.num_rows > 2 * TASK_SAMPLES:
                    t, step = t.take(pa.array(np.arange(0, t.num_rows, 2))), 2 * step
                held, size = t.combine_chunks().to_batches(), t.num_rows
        for part in held:
            weight = pa.array(np.full(part.num_rows, step, np.int64))
            yield pa.RecordBatch.from_arrays([*part.columns, weight], [*part.schema.names, "_rows"])

    return keys.mapInArrow(run, T.StructType([*keys.schema.fields, T.StructField("_rows", T.LongType())]))


def _found(cuts: str, key: str, most: int) -> tuple[list[str], str]:
    """Projections that halve their way to the number of cuts at or below the key, and its name.

    The steps compile into the stage that reads the rows; past the end of the cuts the
    comparison is NULL and adds nothing.
    """
    steps, at = [], "0"
    for bit in reversed(range(most.bit_length())):
        steps.append(f"{at} + if(get({cuts}, {at} + {2**bit - 1}) <= {key}, {2**bit}, 0) AS {cuts}{bit}")
        at = f"{cuts}{bit}"
    return steps, at


def _cuts(sample: DataFrame, parts: int, by: list[str]) -> DataFrame:
    """cuts: at most ``parts - 1`` keys that cut each group of the sample into even parts, in order."""
    group = Window.partitionBy(*(by or [F.lit(0)]))
    before = F.sum("_rows").over(group.orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_rows")
    part = F.floor(before * parts / F.sum("_rows").over(group)).alias("_part")
    first = sample.select(*by, "_key", part).groupBy(*by, "_part").agg(F.min("_key").alias("_key"))
    return first.groupBy(*by).agg(F.array_sort(F.collect_set(F.when(F.col("_part") > 0, F.col("_key")))).alias("cuts"))


def _located(rows: DataFrame, top: DataFrame, parts: int) -> DataFrame:
    """``_bucket`` of each row by its ``_key``; the cuts are one row, read as a subquery."""
    steps, at = _found("_top", "_key", parts - 1)
    found = rows.select("*", top.select("cuts").scalar().alias("_top")).select("*", *map(F.expr, steps))
    return found.select(*[f"`{c}`" for c in rows.columns], F.col(at).cast("int").alias("_bucket"))


def with_range(df: DataFrame, keys: list[str], ranges: int | None = None) -> DataFrame:
    """Append ``_range``: ascending with the key order, NULLs first.

    The cut points come from a sample that one pass over the keys takes; a range holds some
    ``ROWS_PER_RANGE`` rows at most, so their number follows the table.  They are kept as a
    stored directory of two levels: cuts between buckets, and ``FINE`` ranges in each bucket.
    A row is located by both in turn.  The driver sees two counts, the plan none of the cuts,
    and the cuts of a bucket are found in a task of its own.
    """
    if ranges == 1:
        return df.withColumn(RANGE, F.lit(0))
    key = _order_key(keys)
    sample = materialize(_sampled(df.select(key.alias("_key"))), "sample")
    row = sample.agg(F.sum("_rows").alias("total"), F.count(F.lit(1)).alias("n")).first()
    if not row["n"]:
        return df.withColumn(RANGE, F.lit(0))
    ranges = ranges or range_count(df, row["total"])
    buckets = -(-ranges // FINE)

    def thinned(wanted: int) -> DataFrame:
        return sample if row["n"] <= wanted else sample.sample(fraction=min(1.0, 1.1 * wanted / row["n"]), seed=17)

    placed = df.select("*", key.alias("_key"))
    if buckets == 1:
        top = _cuts(thinned(SAMPLES_PER_RANGE * ranges), ranges, [])  # a short list, from the stored sample
        return _located(placed, top, ranges).drop("_key").withColumnRenamed("_bucket", RANGE)
    top = materialize(_cuts(thinned(SAMPLES_PER_RANGE * FINE * buckets // 32), buckets, []), "ranges")
    fine = _cuts(_located(thinned(SAMPLES_PER_RANGE * ranges), top, buckets), FINE, ["_bucket"])
    fine = materialize(fine.withColumnRenamed("cuts", "_fine"), "ranges")
    size = fine.agg(F.sum(F.length(F.to_json(F.struct("_fine"))))).first()[0] or 0
    steps, at = _found("_fine", "_key", FINE - 1)
    rows = _located(placed, top, buckets).join(
        F.broadcast(fine) if size <= DIRECTORY_BYTES else fine, "_bucket", "left").select("*", *map(F.expr, steps))
    return rows.select(*[f"`{c}`" for c in df.columns], (F.col("_bucket") * FINE + F.col(at)).alias(RANGE))


def _order_key(keys: list[str]) -> Column:
    """One comparable value per row; NULLs come first in a struct."""
    named = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]
    return named[0] if len(keys) == 1 else F.struct(*named)


def with_rank(df: DataFrame, keys: list[str], out: str, ranges: int | None = None) -> DataFrame:
    """Append the row's place, from 0, in the order of keys that tell the rows apart.

    ``df`` is read three times (keys, sizes, rows), so it should be a stored table.
    """
    ranged = with_range(df, keys, ranges)
    sizes = ranged.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_size"))  # one row per range
    earlier = Window.partitionBy(F.lit(0)).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    start = sizes.select(RANGE, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(RANGE).orderBy(*keys))
    return ranged.join(F.broadcast(start), RANGE).select(
        *[f"`{c}`" for c in df.columns], (F.col("_start") + place - 1).cast("long").alias(out))


# --------------------------------------------------------------------------
# The row at a given rank inside each class, in the order of a uniform hash.

#: Hex digits of a key that make its place, a number below 2**52.
PLACE_DIGITS = 13
_TOP = 16**PLACE_DIGITS


def hash_key(seed: int, ids: list[str]) -> Column:
    """A reproducible pseudo-random order: hex text, equal in any engine.

    Lengths and gaps are marked, so no two ids give the same text.
    """
    parts = []
    for c in ids:
        text = F.col(f"`{c}`").cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat(F.lit(f"{seed}|"), *parts))


def cell(key: Column, share: float | Column) -> Column:
    """Which of some 1,600 intervals a key's place is in; they get finer towards a share of the range.

    Of n uniform keys the one at rank ``share * n`` lies about ``n**-0.5`` from there, where an
    interval has some ``n**0.5 / 16`` keys.  So the counts of one pass, which merge by adding,
    bracket this key closely whatever n is.  Cells ascend with the keys.

    A cell is never NULL, so a join on it need not test for that: Spark would put the test,
    with a copy of the key's hash for each time a step reads it, in front of the join.
    """
    place = F.conv(F.substring(key, 1, PLACE_DIGITS), 16, 10).cast("long")
    middle = F.floor(share * F.lit(float(_TOP))) if isinstance(share, Column) else F.lit(int(share * _TOP))
    off = place - middle.cast("long")
    size = F.when(off < 0, -1 - off).otherwise(off)
    drop = F.greatest(F.lit(0), F.length(F.bin(size)) - 5)
    step = (16 * drop + F.call_function("shiftright", size, drop)).cast("int")
    return F.coalesce(F.when(off < 0, -1 - step).otherwise(step), F.lit(0))


def cells_of_ranks(counts: DataFrame, ranks: DataFrame, by: list[str], cells: list[str]) -> DataFrame:
    """The cell in which each wanted rank lies, and the rank within it (``rest``).

    ``counts``: by, cells, n; ``ranks``: by, slot, rank (from 1).
    """
    along = Window.partitionBy(*by).orderBy(*cells).rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("_upto", F.sum("n").over(along))
    return upto.join(ranks, by).where(
        (F.col("rank") <= F.col("_upto")) & (F.col("rank") > F.col("_upto") - F.col("n"))).select(
        *dict.fromkeys([*by, "slot", *cells]), (F.col("rank") - F.col("_upto") + F.col("n")).alias("rest"))


def keys_in_cells(rows: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """slot, label and the key at the rank ``rest`` among the rows (label, key) of a wanted cell.

    ``tied`` tells that the next row has the same key.
    """
    order = Window.partitionBy("label", "slot").orderBy("key")
    hits = rows.join(wanted, on).withColumns({"_place": F.row_number().over(order), "_next": F.lead("key").over(order)})
    tied = F.coalesce(F.col("_next") == F.col("key"), F.lit(False))
    return hits.where(F.col("_place") == F.col("rest")).select("slot", "label", "key", tied.alias("tied"))


def refuse_ties(tied: bool | None) -> None:
    if tied:
        raise ValueError("The id columns do not tell the rows apart")


def keys_at_ranks(df: DataFrame, label: str, key: Column,
                  wanted: list[tuple[object, int, int]]) -> list[str]:
    """The hash key of the ``rank``-th row of a class, for each wanted rank.

    ``wanted`` holds (label value, rank counted from 1, rows of that class).  One pass counts
    cells around the expected places, a second one fetches the keys of one cell per rank.  Both
    read label and id only and shuffle only counters and those keys.
    """
    rows = df.select(F.col(f"`{label}`").alias("label"), key.alias("key"))
    schema = T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("label", rows.schema["label"].dataType),
                           T.StructField("rank", T.LongType()), T.StructField("n_rows", T.LongType())])
    table = F.broadcast(small_table(df.sparkSession, [(i, *w) for i, w in enumerate(wanted)], schema))  # a row per rank
    found = rows.join(table, "label").select(
        "slot", "label", "key", cell(F.col("key"), F.col("rank") / F.col("n_rows")).alias("cell"))
    counts = found.groupBy("slot", "cell").agg(F.count(F.lit(1)).alias("n"))
    cells = materialize(cells_of_ranks(counts, table.select("slot", "rank"), ["slot"], ["cell"]), "cells")
    picked = keys_in_cells(found, F.broadcast(cells), ["slot", "cell"]).collect()  # a row per rank
    refuse_ties(any(r["tied"] for r in picked))
    keys = {r["slot"]: r["key"] for r in picked}
    for i, (value, _, _) in enumerate(wanted):
        if i not in keys:
            raise ValueError(f"Class {value!r} has fewer rows than were counted")
    return [keys[i] for i in range(len(wanted))]
