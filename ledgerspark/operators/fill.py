"""Gap filling along a row order.

A filled value may come from any distance, so the fill is done in two parts.
A first pass takes, for each key range, the last (or first) value present; that
table has one row per range, and carrying values along it is cheap.  The second
pass fills inside each range with a window and falls back on the carried value.
The rows are shuffled once.  With ``partition_by`` the ranges run over the
partition key and the order key together, so a key that holds a large share of
the rows is spread over many tasks as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.missing import nan_to_null
from ledgerspark.operators.ordered import RANGE, with_range


def forward_fill(df: DataFrame, cols: list[str] | None = None, *, order_by,
                 partition_by=None, ranges: int | None = None) -> DataFrame:
    """Each missing value takes the last present one before it in the order."""
    return _fill(df, cols, order_by, partition_by, ranges, forward=True, backward=False)


def backward_fill(df: DataFrame, cols: list[str] | None = None, *, order_by,
                  partition_by=None, ranges: int | None = None) -> DataFrame:
    """Each missing value takes the next present one after it in the order."""
    return _fill(df, cols, order_by, partition_by, ranges, forward=False, backward=True)


def fill_missing(df: DataFrame, cols: list[str] | None = None, *, order_by,
                 partition_by=None, ranges: int | None = None) -> DataFrame:
    """Forward fill, then backward fill of what is left at the head.

    A column without any value stays NULL.  The input frame is untouched.
    """
    return _fill(df, cols, order_by, partition_by, ranges, forward=True, backward=True)


def _listed(names) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def _fill(df: DataFrame, cols, order_by, partition_by, ranges, *, forward: bool,
          backward: bool) -> DataFrame:
    order, parts = _listed(order_by), _listed(partition_by)
    if not order:
        raise ValueError("order_by is required: a table has no row order of its own")
    names = df.columns
    cols = [c for c in names if c not in order + parts] if cols is None else list(cols)
    if not cols:
        return df
    # Both passes below read these rows; where every column is filled or orders, the second
    # one reads what the first one shuffled.
    ranged = with_range(nan_to_null(df, cols), parts + order, ranges).repartition(RANGE, *[F.col(f"`{c}`") for c in parts])
    carried = _carried(ranged, cols, order, parts, forward, backward)
    keys = [RANGE, *parts]
    same = F.col(RANGE).eqNullSafe(F.col("_key0"))
    for i, c in enumerate(parts, 1):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_key{i}"))
    joined = ranged.join(F.broadcast(carried), same, "left")
    within = Window.partitionBy(*keys)
    along = within.orderBy(*order)
    against = within.orderBy(*[F.col(f"`{c}`").desc() for c in order])
    # Equal keys lie in one range, side by side; which of them a value comes from would
    # be left to chance, so they are refused.
    key = F.struct(*[F.col(f"`{c}`") for c in order])
    tied = F.lag(key).over(along) == key
    refuse = F.raise_error(F.lit(f"The order {order} does not tell the rows apart"))
    filled: dict[str, Column] = {}
    for i, c in enumerate(cols):
        value = F.col(f"`{c}`")
        sources = [value]
        if forward:
            so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            sources += [F.last(value, True).over(so_far), F.col(f"_before{i}")]
        if backward and forward:
            # Only the head is still missing here, and every head row takes the
            # first value present; the same sort order serves both windows.
            whole = along.rowsBetween(
                Window.unboundedPreceding, Window.unboundedFollowing)
            sources += [F.first(value, True).over(whole), F.col(f"_after{i}")]
        elif backward:
            # Read against the order: the frame then grows row by row, where a
            # frame that reaches forward would be recomputed for each row.
            so_far = against.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            sources += [F.last(value, True).over(so_far), F.col(f"_after{i}")]
        filled[c] = F.coalesce(*sources)
    done = joined.select(
        *[filled[c].alias(c) if c in filled else F.col(f"`{c}`") for c in names],
        F.coalesce(tied, F.lit(False)).alias("_tied"))
    return done.where(F.when(F.col("_tied"), refuse.cast("boolean")).otherwise(F.lit(True))).drop("_tied")


def _carried(ranged: DataFrame, cols, order, parts, forward, backward) -> DataFrame:
    """What each range receives from the ranges before (after) it.

    Inside one partition key only ranges it shares with a neighbour receive
    anything, so there are at most two rows per range: small by construction.
    """
    key = F.struct(*[F.col(f"`{c}`") for c in order])
    edges = []
    for i, c in enumerate(cols):
        value = F.col(f"`{c}`")
        seen = F.when(value.isNotNull(), key)
        if forward:
            edges.append(F.max_by(value, seen).alias(f"_last{i}"))
        if backward:
            edges.append(F.min_by(value, seen).alias(f"_first{i}"))
    table = ranged.groupBy(RANGE, *parts).agg(*edges)
    along = Window.partitionBy(*parts) if parts else Window.partitionBy(F.lit(0))
    before = along.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    after = along.orderBy(F.col(RANGE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    out = []
    for i, _ in enumerate(cols):
        if forward:
            out.append(F.last(f"_last{i}", True).over(before).alias(f"_before{i}"))
        if backward:
            out.append(F.last(f"_first{i}", True).over(after).alias(f"_after{i}"))
    keys = [F.col(f"`{c}`").alias(f"_key{i}") for i, c in enumerate((RANGE, *parts))]
    table = table.select(*keys, *out)
    got = [F.col(c) for c in table.columns if c.startswith(("_before", "_after"))]
    return table.where(_any(got))


def _any(columns: list[Column]) -> Column:
    hit = columns[0].isNotNull()
    for c in columns[1:]:
        hit = hit | c.isNotNull()
    return hit
