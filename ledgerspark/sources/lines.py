"""Delimited text cut into records by many tasks per file, line breaks in quotes included.

Whether a block of a file begins inside quotes depends on everything before it.  Each block
is a map of two states: what it is at the end, if the block began outside or inside quotes.
One pass makes this map for every block, with the number of records that end in it either
way: one row per block.  Running over these rows in file order gives each block's true state
and the number of its first record.  The second pass cuts the records.  One that reaches
over the end of blocks leaves a piece in each of them, under the same number, and the
pieces are joined.  The records are stored, so the text is parsed from there.

Lines end in a line feed, with or without a carriage return before it.  Blank lines outside
quotes are no records.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.sources.scratch import materialize

_MARK = "\ufeff"  # a byte-order mark
_BATCH = 2_000  # records that leave at a time


def inside_after(line: str, inside: bool, delimiter: str) -> bool:
    """Whether the end of a line lies inside quotes, if its beginning does or does not.

    A quote opens a field only at its beginning; a doubled one inside stands for itself; what
    follows a closing quote belongs to the field up to the next delimiter.
    """
    at = 0
    while True:
        if inside:
            end = line.find('"', at)
            if end < 0:
                return True
            if line.startswith('"', end + 1):
                at = end + 2
                continue
            inside, at = False, end + 1
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        at = line.find(delimiter, at)
        if at < 0:
            return False
        at += len(delimiter)


def _rows(batches: Iterator[pa.RecordBatch], encoding: str) -> Iterator[tuple[str, tuple]]:
    """Each line of a task with its other columns, of which ``start`` is the second."""
    last = None
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for raw, *own in zip(texts, *(c.to_pylist() for c in batch.columns[1:])):
            line = raw.decode(encoding, "replace")
            if own != last:
                if own[1] == 0 and line.startswith(_MARK):
                    line = line[1:]
                last = own
            yield line, tuple(own)


def _blank(line: str) -> bool:
    return not line.strip()


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("start"))


def _block_maps(lines: DataFrame, delimiter: str, encoding: str, multi_line: bool) -> DataFrame:
    """file, start, and for either state at the beginning: the state at the end, and the records that end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        block, state, ended = None, [False, True], [0, 0]
        for line, own in _rows(batches, encoding):
            if own != block:
                if block is not None:
                    done.append((*block, *state, *ended))
                block, state, ended = own, [False, True], [0, 0]
            plain = '"' not in line
            for i in (0, 1):
                was = state[i]
                if multi_line and not plain:
                    state[i] = inside_after(line, was, delimiter)
                if not state[i] and (was or not _blank(line)):
                    ended[i] += 1
        if block is not None:
            done.append((*block, *state, *ended))
        if done:
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)],
                                             ["file", "start", "s0", "s1", "n0", "n1"])

    return lines.mapInArrow(run, "file string, start long, s0 boolean, s1 boolean, n0 long, n1 long")


def _block_states(maps: DataFrame) -> DataFrame:
    """file, start, place (of the file), inside, first: one row per block.

    A map keeps the state, turns it round, or sets it.  So a state is what the last block that
    set it said, turned round as often as blocks after that one did.
    """
    along = Window.partitionBy("file").orderBy("start")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.col("s0") & ~F.col("s1")
    m = maps.withColumn("turns", F.sum(turns.cast("long")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    sets = F.when(F.col("s0") == F.col("s1"), F.struct("s0", "turns"))
    last = F.last(sets, True).over(earlier)
    turned = F.coalesce(F.max("turns").over(earlier), F.lit(0))
    m = m.withColumns({"_set": last, "_turned": turned})
    m = m.withColumn("inside", F.coalesce("_set.s0", F.lit(False)) != (
        (F.col("_turned") - F.coalesce("_set.turns", F.lit(0))) % 2 == 1))
    own = F.when(F.col("inside"), F.col("n1")).otherwise(F.col("n0"))
    m = m.withColumn("first", F.coalesce(F.sum(own).over(earlier), F.lit(0)))
    # One row per block, so this window runs over a narrow, short table.
    return m.select("file", "start", F.dense_rank().over(Window.orderBy("file")).cast("long").alias("place"),
                    "inside", "first")


def _cut(lines: DataFrame, delimiter: str, encoding: str, multi_line: bool) -> DataFrame:
    """place, start, number, part, ends, text of every record; ``part`` marks pieces, ``ends`` a last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        block, held, inside, part, number = None, [], False, False, 0

        def out() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)],
                                               ["place", "start", "number", "part", "ends", "text"])
            done.clear()
            return batch

        def leave(open_: bool) -> None:
            text = "\n".join(held)
            if not open_ and text.endswith("\r"):
                text = text[:-1]
            done.append((block[0], block[1], number, open_ or part, not open_, text))
            held.clear()

        for line, own in _rows(batches, encoding):
            if own != block:
                if held:
                    leave(True)
                block = own
                inside = part = own[2]
                number = own[3]
            was = inside
            if multi_line and '"' in line:
                inside = inside_after(line, inside, delimiter)
            if not held and not was and not inside and _blank(line):
                continue
            held.append(line)
            if not inside:
                leave(False)
                part = False
                number += 1
            if len(done) >= _BATCH:
                yield out()
        if held:
            leave(True)
        if done:
            yield out()

    return lines.mapInArrow(run, "place long, start long, number long, part boolean, ends boolean, text string")


def records(spark: SparkSession, path: str, delimiter: str = ",", encoding: str = "utf-8",
            multi_line: bool = True) -> DataFrame:
    """place, number, text, ends: the records of every file, each file's numbered from 0; stored.

    ``place`` numbers the files in the order of their paths.  ``ends`` is false where quotes are
    still open at the end of the file.  Without ``multi_line`` every line is a record.
    """
    lines = _lines(spark, path)
    states = materialize(_block_states(_block_maps(lines, delimiter, encoding, multi_line)), "blocks")
    # One row per block of a file: some 10 MB for 100 TB.
    known = lines.join(F.broadcast(states), ["file", "start"], "left")
    moved = F.raise_error(F.lit("The files were cut into other blocks in the second pass; read them again"))
    known = known.select("value", F.coalesce("place", moved.cast("long")).alias("place"), "start", "inside", "first")
    cut = materialize(_cut(known, delimiter, encoding, multi_line), "records")
    whole = cut.where(~F.col("part")).select("place", "number", "text", "ends")
    pieces = cut.where("part").groupBy("place", "number").agg(
        F.array_sort(F.collect_list(F.struct("start", "text"))).alias("p"), F.bool_or("ends").alias("ends"))
    joined = F.array_join(F.transform("p", lambda p: p["text"]), "\n")
    # A piece keeps its carriage return, as the text may go on; at the end it is dropped here.
    return whole.unionByName(pieces.select("place", "number", F.regexp_replace(joined, "\r$", "").alias("text"), "ends"))
