"""Connected components of a table of links, by contracting it round by round.

In each round every partition first replaces its links by a spanning forest (stars around
the smallest id), then every node moves to the neighbour, or itself, whose hash in this
round is smallest, and links between merged nodes vanish.  Hashes make long chains shrink
by a constant factor a round.  A hub costs no more than its links: the smallest hash is an
aggregate that is combined before the shuffle.  Every round is a written table, and its
tasks follow the counted links.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import keep

TASK_LINKS = 200_000  # links of one task in a round


def forest(pairs: Iterator[tuple[int, int]]) -> dict[int, int]:
    """Each node with the smallest node that the pairs connect it to."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = y
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: top(x) for x in list(up)}


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tops = forest(p for b in batches for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
    rows = [(x, t) for x, t in tops.items() if x != t]
    for at in range(0, len(rows), 10_000):
        a, b = zip(*rows[at:at + 10_000])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def connected(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """id, root for every node of the links a, b (bigint): equal roots, equal component.

    ``links`` is counted first, so it should be a stored table.  A round has a task for every
    ``task_links`` links; once they fit one task, its stars are the components.
    """
    moves: list[DataFrame] = []
    left = links.count()
    while left:
        tasks = -(-left // task_links)
        stars = links.select("a", "b").where("a <> b").coalesce(tasks).mapInArrow(_forest, "a long, b long")
        links = keep(stars if tasks == 1 else stars.distinct(), "links")
        if tasks == 1:
            tops = links.select(F.col("b").alias("id"), F.col("b").alias("to")).distinct()
            moves.append(links.select(F.col("a").alias("id"), F.col("b").alias("to")).union(tops))
            break
        left = links.count()  # the next round has no more than these
        if not left:
            break
        k = len(moves)

        def place(c: str, k: int = k):
            return F.struct(F.xxhash64(F.lit(k), F.col(c)).alias("h"), F.col(c).alias("id"))

        both = links.union(links.select("b", "a"))
        best = both.select("a", place("b").alias("n")).groupBy("a").agg(F.min("n").alias("n"))
        move = keep(best.select(F.col("a").alias("id"), F.least("n", place("a"))["id"].alias("to")), "moves")
        moves.append(move)
        links = (links.join(move.select(F.col("id").alias("a"), F.col("to").alias("x")), "a")
                 .join(move.select(F.col("id").alias("b"), F.col("to").alias("y")), "b")
                 .select(F.col("x").alias("a"), F.col("y").alias("b")))
    if not moves:
        return links.select(F.col("a").cast("long").alias("id"), F.col("b").cast("long").alias("root"))
    out = moves[0].select("id", F.col("to").alias("root"))
    for move in moves[1:]:
        step = move.select(F.col("id").alias("root"), "to")
        out = out.join(step, "root", "left").select("id", F.coalesce("to", "root").alias("root"))
    return keep(out, "components")


def joined(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components that further (stored) links make of earlier ones; links inside one cost nothing."""
    if roots is None:
        return connected(links)
    ends = links.select("a", "b")
    for c in ("a", "b"):
        top = roots.select(F.col("id").alias(c), F.col("root").alias(f"_{c}"))
        ends = ends.join(top, c, "left").withColumn(c, F.coalesce(f"_{c}", c)).select("a", "b")
    merged = connected(keep(ends.where("a <> b").distinct(), "links"))
    step = merged.select(F.col("id").alias("root"), F.col("root").alias("to"))
    moved = roots.join(step, "root", "left").select("id", F.coalesce("to", "root").alias("root"))
    return keep(moved.union(merged.join(roots, "id", "left_anti").select("id", "root")), "components")
