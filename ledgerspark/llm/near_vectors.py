"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector passes those in whose cap it lies.  Directions come from
structured random product codes: after a random rotation the components are cut into two
halves, each with its own list of random unit vectors, and every pair of one from each is a
filter, whose score is the sum of the two inner products.  So the best filters of a vector
are decoded from its best entries in each half, without looking at all pairs.  Every vector
is listed under all filters whose score reaches the cap of its own: the height that
``PASSES`` filters of a code exceed.  (With one height for all, vectors of uneven halves
pass no filter at all: recall at the threshold was 0.59 to 0.91 in trials, with a height
per vector 0.998 and more.)  Independent codes
are used, ``CODES`` and more.

Vectors with equal labels that share a filter are verified by their cosine in double
precision; a pair that shares several filters is counted in the first one only.

Equal vectors are one entry with a weight.  A list longer than ``BLOCK`` is dealt into
chunks, and each two chunks are one unit of work, so a list never meets in one task; links
leave a unit as one sum per vector and a spanning forest, never as pairs.

The number of directions follows the number of vectors (``directions``), so that lists
stay short as the table grows.  A filter's cap is smaller then, so one code finds fewer
links; the number of codes rises with it (``codes_for``) and recall stays.

Defined cases: vectors that are null, zero or hold null or non-finite components, rows with
a null label or a null vec_id: linked with nothing, and kept; vectors of different length
are never linked; repeated rows are copies; extra columns are ignored; an empty table gives
an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import join_small, keep, whole_groups
from ledgerspark.llm.components import connected, forest
from ledgerspark.llm.vectors import by_length, lengths_of, unit, usable

COSINE = 0.93
CODES = 2
PASSES = 8
BLOCK = 1024
SEED = 20


def directions(vectors: int) -> int:
    """Entries in each half's list: a power of two near half the root of the vector count."""
    return 2 ** min(12, max(5, round(math.log2(max(1, vectors) ** 0.5 / 2))))


def codes_for(entries: int) -> int:
    """Codes that keep recall at the threshold: one code misses some 3 % at 128 entries and 20 % at 4096."""
    return max(CODES, math.ceil(math.log2(entries) / 2 - 1.5))


class ProductCodes:
    """Random product codes for one vector length."""

    def __init__(self, length: int, entries: int, codes: int | None = None, passes: int = PASSES):
        rng = np.random.default_rng([SEED, length])
        self.entries, self.passes, self.cut = entries, passes, max(1, length // 2)
        self.codes = []
        for _ in range(codes or codes_for(entries)):
            turn = np.linalg.qr(rng.normal(size=(length, length)))[0]
            lists = []
            for n in (self.cut, length - self.cut):
                c = rng.normal(size=(entries, n))
                lists.append(c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-300))
            self.codes.append((turn, *lists))

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The filters that each row passes, rising: one row of numbers per vector."""
        out = []
        for k, (turn, left, right) in enumerate(self.codes):
            y = x @ turn
            halves = []
            for part, entries in ((y[:, :self.cut], left), (y[:, self.cut:], right)):
                score = part @ entries.T
                top = np.argpartition(-score, min(self.passes, self.entries) - 1, 1)[:, :self.passes]
                halves.append((top, np.take_along_axis(score, top, 1)))
            (i, a), (j, b) = halves
            # The best sums are among the best of each half.
            total = (a[:, :, None] + b[:, None, :]).reshape(len(x), -1)
            number = (i[:, :, None] * self.entries + j[:, None, :]).reshape(len(x), -1)
            best = np.argpartition(-total, min(self.passes, total.shape[1]) - 1, 1)[:, :self.passes]
            out.append(np.take_along_axis(number, best, 1) + k * self.entries**2)
        return np.sort(np.concatenate(out, 1), 1)


def _shared_earlier(filters: np.ndarray, here: int) -> np.ndarray:
    """For each two rows, whether they share a filter before ``here``."""
    rows = len(filters)
    _, place = np.unique(filters, return_inverse=True)
    place = place.reshape(filters.shape)
    early = filters < here
    common = np.zeros((rows, rows), np.float32)
    for at in range(0, int(place.max()) + 1, 2048):
        use = early & (place >= at) & (place < at + 2048)
        has = np.zeros((rows, 2048), np.float32)
        r, c = np.nonzero(use)
        has[r, place[r, c] - at] = 1
        common += has @ has.T
    return common > 0


def unit_links(x: np.ndarray, weight: np.ndarray, filters: np.ndarray, here: int, side: np.ndarray,
               cosine: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of one unit of work: the weight each row gains, and links that keep it connected.

    ``side`` tells the two chunks apart; pairs within one chunk count only if there is one.
    """
    close = np.triu(x @ x.T >= cosine, 1)
    if side.any() and not side.all():
        close &= side[:, None] != side[None]
    i, j = np.nonzero(close)
    gained = np.zeros(len(x), np.int64)
    if not len(i):
        return gained, []
    if len(i) <= 4:
        first = np.array([not np.intersect1d(filters[a][filters[a] < here], filters[b]).size for a, b in zip(i, j)])
    else:
        met = np.unique(np.concatenate([i, j]))
        spot = np.zeros(len(x), np.int64)
        spot[met] = np.arange(len(met))
        first = ~_shared_earlier(filters[met], here)[spot[i], spot[j]]
    np.add.at(gained, i[first], weight[j[first]])
    np.add.at(gained, j[first], weight[i[first]])
    return gained, [(a, t) for a, t in forest(zip(i.tolist(), j.tolist())).items() if a != t]


def linked(distinct: DataFrame, entries: int, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """node, other, gained: links' weights and connecting links among distinct vectors.

    ``distinct``: label, node, weight, embedding.
    """
    spark = distinct.sparkSession
    codes = spark.sparkContext.broadcast(
        {n: ProductCodes(n, entries) for n in lengths_of(distinct, "embedding")})  # of fixed size per length

    def passed(batch: pa.RecordBatch, k: int):
        for n, which, x in by_length(batch.column(k)):
            yield n, which, codes.value[n].decode(unit(x))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, which, f in passed(batch, 1):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.repeat(which, f.shape[1]))), pa.array(np.full(f.size, n, np.int32)), pa.array(f.ravel())],
                    ["label", "length", "filter"])

    key = ["label", "length", "filter"]
    label = distinct.schema["label"].dataType.simpleString()
    sizes = distinct.select("label", "embedding").mapInArrow(count, f"label {label}, length int, filter long")
    long_lists = keep(sizes.groupBy(*key).count().where(F.col("count") > block).select(
        *key, F.ceil(F.col("count") / block).cast("int").alias("chunks")), "lists")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, which, f in passed(batch, 3):
                again = pa.array(np.repeat(which, f.shape[1]))
                all_filters = pa.array([r.tobytes() for r in f], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(again), pa.array(np.full(f.size, n, np.int32)), pa.array(f.ravel()),
                     batch.column(1).take(again), batch.column(2).take(again), batch.column(3).take(again),
                     all_filters.take(pa.array(np.repeat(np.arange(len(which)), f.shape[1])))],
                    [*key, "node", "weight", "embedding", "filters"])

    schema = T.StructType([distinct.schema["label"], T.StructField("length", T.IntegerType()), T.StructField("filter", T.LongType()),
                           T.StructField("node", T.LongType()), T.StructField("weight", T.LongType()),
                           distinct.schema["embedding"], T.StructField("filters", T.BinaryType())])
    listed = distinct.select("label", "node", "weight", "embedding").mapInArrow(expand, schema)
    listed = join_small(listed, long_lists, key)
    chunks = F.coalesce(F.col("chunks"), F.lit(1))
    listed = listed.withColumn("chunk", F.pmod(F.xxhash64("node", "filter"), chunks).cast("int"))
    listed = listed.withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    listed = listed.withColumn("lo", F.least("chunk", "other")).withColumn("hi", F.greatest("chunk", "other"))
    unit_key = [*key, "lo", "hi"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, unit_key, 8192):
            node, weight = t.column("node").to_numpy(), t.column("weight").to_numpy()
            here, side = t.column("filter").to_numpy(), t.column("chunk").to_numpy() == t.column("hi").to_numpy()
            filters = np.frombuffer(b"".join(t.column("filters").to_pylist()), np.int64).reshape(t.num_rows, -1)
            new = np.zeros(t.num_rows, bool)
            new[0] = True
            for k in unit_key:
                v = t.column(k).to_numpy(zero_copy_only=False)
                new[1:] |= v[1:] != v[:-1]
            cuts = [*np.flatnonzero(new), t.num_rows]
            vectors: list = [None] * t.num_rows
            for _, which, x in by_length(t.column("embedding")):
                for r, u in zip(which, unit(x)):
                    vectors[r] = u
            out = []
            for a, b in zip(cuts, cuts[1:]):
                if b - a < 2:
                    continue
                gained, edges = unit_links(np.stack(vectors[a:b]), weight[a:b], filters[a:b], here[a], side[a:b], cosine)
                out += [(node[a + i], node[a + i], g) for i, g in enumerate(gained.tolist()) if g]
                out += [(node[a + i], node[a + j], 0) for i, j in edges]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["node", "other", "gained"])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = listed.select(*unit_key, "chunk", "node", "weight", "embedding", "filters").repartition(tasks, *unit_key)
    return dealt.sortWithinPartitions(*unit_key).mapInArrow(work, "node long, other long, gained long")


def near_duplicates(table: DataFrame, cosine: float = COSINE, block: int = BLOCK, entries: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vec_id, embedding, label."""
    fit = usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label").withColumn(
        "node", F.when(fit, F.xxhash64("label", "embedding")))
    distinct = keep(rows.where("node is not null").groupBy("label", "embedding", "node").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("weight")), "distinct")
    entries = entries or directions(distinct.count())
    found = keep(linked(distinct, entries, cosine, block), "linked")
    gained = found.groupBy("node").agg(F.sum("gained").alias("gained"))
    roots = connected(found.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")))
    own = distinct.select("node", "first", "weight").join(gained, "node", "left").join(
        roots.withColumnRenamed("id", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = own.groupBy("root").agg(F.min("first").alias("component_id"))
    own = own.join(least, "root").select(
        "node", (F.col("weight") - 1 + F.coalesce("gained", F.lit(0))).alias("n_links"), "component_id")
    full = rows.where("node is not null").select("vec_id", "node").join(own, "node").select("vec_id", "n_links", "component_id")
    none = rows.where("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return full.union(none).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
