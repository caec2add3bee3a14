"""Nearest neighbours by inner product: multi-index hashing over learned binary codes.

Codes.  Vectors get one more component that makes all lengths equal (0 for a query, which
is scaled to length 1 instead), so the largest inner product is the smallest distance.
They are centred, turned to their main axes and rotated so that signs lose least (iterative
quantisation); the signs are the bits.  All axes take part.  Several rotations, each learned
from another start, fill ``BITS`` bits, or as many as there are axes.  Rotations are learned
on at most ``TRAIN_ROWS`` vectors, those with the smallest hashes; every row is coded and
indexed.  On the same vectors, standing for a block, bits are doubled once and candidates
then doubled until the share of true neighbours among the candidates reaches ``RECALL``: long
vectors get longer codes and more candidates, and in the last resort all rows are reranked.

Index.  A code is cut into substrings of 16 bits.  Each substring has a table from its
2^16 values to the rows that hold it.  By the pigeonhole principle a code within distance
r = m * (s + 1) - 1 of a query (m substrings) agrees with it up to s bits in one substring
at least.  So a query probes all values within 0, 1, 2, ... bits of its own until
the wanted number of codes (``CANDIDATES`` and more) lie within a distance that these probes
cover; every code within that distance is then reranked by the exact inner product of the
original vectors.  With fewer rows than that, all of them are.  On vectors in clusters few
rows are touched at all; where the neighbours are far away (cosines of 0.3), most are.

Work is laid out in blocks: rows are dealt into index blocks and queries into query blocks
of bounded size, by a hash of id and vector, so equal or near-equal vectors spread evenly and
a task run again gets the same rows.  Rows that repeat one another wholly are one row with a
count.  Each pair of blocks is one task that returns ``k`` rows per query; these are merged by
a rank that is limited before the shuffle.

Defined cases: vectors that are null, zero or hold null or non-finite components take no
part, nor do rows with a null vec_id; only vectors of one length are compared; ties go to
the smaller vec_id; repeated rows are candidates each, and one query; a query does not
return rows with its own vec_id; vectors of any length are coded with all their components;
extra columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerspark.llm.common import keep, ranges
from ledgerspark.llm.vectors import by_length, usable

NEAREST = 20
EVERY = 20  # rows whose id this divides are queries
BITS, SUBSTRING = 256, 16
DIRECT = 2  # up to so many differing bits, values are looked up one by one
CANDIDATES = 384
RECALL = 0.95  # of the true neighbours, measured on the training vectors
TRAIN_ROWS = 4096
TRIED = 128  # of the training vectors, so many are queries of that measurement
ROUNDS = 15
INDEX_BLOCK, QUERY_BLOCK = 16_384, 2_048
SEED = 11


class RotatedCodes:
    """Learned codes for vectors of one length; ``wanted`` is the number of candidates they need."""

    def __init__(self, sample: np.ndarray, longest: float, bits: int = BITS, wanted: int = CANDIDATES):
        self.longest, self.wanted = longest, wanted
        x = self._even(sample)
        self.centre = x.mean(0)
        x = x - self.centre
        values, axes = np.linalg.eigh(x.T @ x)
        width = len(values)
        axis = axes[:, ::-1]
        v = x @ axis
        self.turns = []
        rng = np.random.default_rng(SEED)
        for _ in range(-(-bits // width)):
            turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
            for _ in range(ROUNDS):
                left, _, right = np.linalg.svd(np.where(v @ turn >= 0, 1.0, -1.0).T @ v)
                turn = (left @ right).T
            self.turns.append(axis @ turn)
        self.turns = np.concatenate(self.turns, 1)[:, :bits]

    def _even(self, x: np.ndarray) -> np.ndarray:
        """Rows scaled to at most 1, with the component that makes them all 1 long."""
        x = x / self.longest
        return np.column_stack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))])

    def _bits(self, x: np.ndarray) -> np.ndarray:
        return np.packbits((x - self.centre) @ self.turns >= 0, axis=1).view(np.uint16)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self._bits(self._even(x))

    def queries(self, x: np.ndarray) -> np.ndarray:
        x = x / np.abs(x).max(1, keepdims=True)
        x = x / np.sqrt((x * x).sum(1, keepdims=True))
        return self._bits(np.column_stack([x, np.zeros(len(x))]))


def _words(codes: np.ndarray) -> np.ndarray:
    """The codes as 64-bit words, one row of the result per word."""
    return np.ascontiguousarray(np.ascontiguousarray(codes).view(np.uint64).T)


def _distances(words: np.ndarray, code: np.ndarray, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
    """Bits in which each of the rows' codes differs from one."""
    return sum(np.bitwise_count(own[rows] ^ w).astype(np.int16)
               for own, w in zip(words, np.ascontiguousarray(code).view(np.uint64)))


def measured_recall(codes: RotatedCodes, sample: np.ndarray, block: int, wanted: int, k: int) -> float:
    """The share of the nearest among the candidates, where the sample stands for a block of rows."""
    share = min(1.0, len(sample) / block)
    near, many = max(1, round(k * share)), max(1, round((wanted + k) * share))
    if many >= len(sample) - 1:
        return 1.0
    words, asked = _words(codes.rows(sample)), sample[:TRIED]
    score = asked @ sample.T
    hit = 0
    for i, code in enumerate(codes.queries(asked)):
        score[i, i] = -np.inf
        distance = _distances(words, code)
        reach = np.partition(np.delete(distance, i), many - 1)[many - 1]
        hit += (distance[np.argpartition(-score[i], near - 1)[:near]] <= reach).sum()
    return hit / (near * len(asked))


def fitted(sample: np.ndarray, longest: float, block: int, k: int = NEAREST, wanted: int = CANDIDATES,
           target: float = RECALL) -> RotatedCodes:
    """Codes that reach the target on the sample: as many bits as axes, then twice, then more candidates."""
    sample = sample[:block]
    bits = max(BITS, -(-(sample.shape[1] + 1) // 64) * 64)
    codes = RotatedCodes(sample, longest, bits, wanted)
    if measured_recall(codes, sample, block, wanted, k) >= target:
        return codes
    codes = RotatedCodes(sample, longest, 2 * bits, wanted)
    while codes.wanted < block and measured_recall(codes, sample, block, codes.wanted, k) < target:
        codes.wanted *= 2
    return codes


@cache
def _masks(s: int) -> np.ndarray:
    """All 16-bit values with s bits set."""
    v = np.arange(1 << SUBSTRING, dtype=np.uint16)
    return v[np.bitwise_count(v) == s].astype(np.int64)


class SubstringIndex:
    """Tables from each substring's values to rows."""

    def __init__(self, codes: np.ndarray):
        parts = self.parts = codes.shape[1]  # codes: (rows, parts) uint16
        self.words, self.touched = _words(codes), 0
        keys = (codes.astype(np.int64) + (np.arange(parts) << SUBSTRING)).ravel()
        order = np.argsort(keys, kind="stable")
        self.rows = (order // parts).astype(np.int32)
        held, first = np.unique(keys[order], return_index=True)
        # The values that occur, each with its rows; where to find a value, and a row's values.
        self.each, self.value = np.bincount(held >> SUBSTRING, minlength=parts), (held & 0xFFFF).astype(np.uint16)
        self.first = first
        self.count = np.diff(np.append(first, len(keys)))
        self.place = np.full(parts << SUBSTRING, -1, np.int32)
        self.place[held] = np.arange(len(held))
        self.held = np.ascontiguousarray(self.place[keys].reshape(codes.shape).T)

    def _near_rows(self, code: np.ndarray, s: int, fewest: list) -> np.ndarray:
        """All rows with a substring that differs from the code's own in at most s bits.

        Few values are looked up one by one.  Once there are more to look up than values
        occur, the occurring values are compared instead, once for all s.
        """
        if s <= DIRECT:
            base = code.astype(np.int64) + (np.arange(self.parts) << SUBSTRING)
            at = self.place[np.concatenate([base[:, None] ^ _masks(b)[None] for b in range(s + 1)], 1).ravel()]
            at = at[at >= 0]
            return np.unique(self.rows[ranges(self.first[at], self.count[at])])
        if not fewest:
            bits = np.bitwise_count(self.value ^ np.repeat(code, self.each))
            least = bits[self.held[0]]
            for held in self.held[1:]:
                np.minimum(least, bits[held], out=least)
            fewest.append(least)
        return np.flatnonzero(fewest[0] <= s)

    def within(self, code: np.ndarray, wanted: int) -> np.ndarray:
        """All rows within the smallest distance that holds ``wanted`` of them (all rows, if fewer).

        ``touched`` grows by the rows whose codes were compared.
        """
        if self.words.shape[1] <= wanted:
            return np.arange(self.words.shape[1])
        fewest: list = []
        for s in (0, *range(DIRECT, SUBSTRING + 4, 4)):
            rows = self._near_rows(code, s, fewest)
            if len(rows) < wanted:
                continue
            distance = _distances(self.words, code, rows)
            covered = self.parts * (s + 1) - 1  # every code as near as this has been found
            bits = self.parts * SUBSTRING
            reached = np.cumsum(np.bincount(distance, minlength=bits + 1))
            if reached[min(covered, bits)] >= wanted:
                self.touched += len(rows)
                return rows[distance <= np.searchsorted(reached, wanted)]
        raise AssertionError("Probing all values finds all rows")


def search_block(codes: RotatedCodes, ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray,
                 k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per query the best k of the block: places of queries, places of rows, scores."""
    index, wanted_codes = SubstringIndex(codes.rows(x)), codes.queries(q)
    place, found, scores = [], [], []
    for i, code in enumerate(wanted_codes):
        asked = codes.wanted + k
        near = index.within(code, asked)
        rows = near[ids[near] != query_ids[i]]
        while len(rows) < k and len(near) < len(ids):  # many rows have the query's own id
            asked *= 2
            near = index.within(code, asked)
            rows = near[ids[near] != query_ids[i]]
        score = (x[rows] * q[i]).sum(1)  # row by row, so that equal vectors get equal scores
        best = np.lexsort((ids[rows], -score))[:k]
        place.append(np.full(len(best), i))
        found.append(rows[best])
        scores.append(score[best])
    return tuple(np.concatenate(c) if c else np.zeros(0, np.int64) for c in (place, found, scores))


def learn(rows: DataFrame, length: int, block: int, k: int, wanted: int, limit: int = TRAIN_ROWS) -> RotatedCodes:
    """Codes for the vectors of one length, from a bounded sample of them."""
    own = rows.where(F.size("embedding") == length).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    longest = own.select(F.max(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v * v)))).first()[0]
    sample = own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(limit).collect()
    return fitted(np.array([r.embedding for r in sample]), longest, block, k, wanted)


def nearest(rows: DataFrame, queries: DataFrame, k: int = NEAREST, wanted: int = CANDIDATES,
            index_block: int = INDEX_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows found with the largest inner products.

    Both frames hold vec_id and embedding.
    """
    spark = rows.sparkSession
    use = usable("embedding") & F.col("vec_id").isNotNull()
    parts = [F.col("vec_id").cast("long").alias("vec_id"), "embedding"]
    rows, queries = rows.where(use).select(*parts), queries.where(use).select(*parts).distinct()
    rows = keep(rows.groupBy(*parts).agg(F.count("*").alias("copies")), "distinct")  # read several times
    counts = {r[0]: r[1] for r in rows.groupBy(F.size("embedding")).count().collect()}  # one row per length
    asked = queries.count()
    codes = spark.sparkContext.broadcast(
        {n: learn(rows, n, min(index_block, counts[n]), k, wanted) for n in sorted(counts)})
    blocks = max(1, math.ceil(sum(counts.values()) / index_block))
    groups = max(1, math.ceil(asked / query_block))

    def dealt(n: int):
        return F.pmod(F.xxhash64(F.xxhash64(*parts)), F.lit(n)).cast("int")

    left = rows.withColumn("block", dealt(blocks)).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = queries.withColumn("group", dealt(groups)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = right.withColumn("which", F.xxhash64("embedding"))
    key = ["block", "group"]

    def run(index: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        by = {n: (which, x) for n, which, x in by_length(index.column("embedding"))} if index.num_rows else {}
        for n, which, q in by_length(asked.column("embedding")) if asked.num_rows and by else ():
            if n not in by:
                continue
            mine, x = by[n]
            ids, copies = (index.column(c).to_numpy()[mine] for c in ("vec_id", "copies"))
            own = asked.column("vec_id").to_numpy()[which]
            place, at, scores = search_block(codes.value[n], ids, x, own, q, k)
            found = ids[at]
            out.append(pa.table({"query_id": own[place], "which": asked.column("which").to_numpy()[which][place],
                                 "vec_id": found, "score": scores, "copies": copies[at]}))
        schema = pa.schema([("query_id", pa.int64()), ("which", pa.int64()), ("vec_id", pa.int64()),
                            ("score", pa.float64()), ("copies", pa.int64())])
        return pa.concat_tables([t.cast(schema) for t in out]) if out else schema.empty_table()

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        run, "query_id long, which long, vec_id long, score double, copies long")
    found = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k).cast("long")))))
    order = W.partitionBy("query_id", "which").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def searched(table: DataFrame) -> DataFrame:
    """The nearest neighbours of every row whose id EVERY divides, among all rows."""
    return nearest(table, table.where(F.col("vec_id") % EVERY == 0))
