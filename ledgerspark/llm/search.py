"""Ranked search of all documents for a stated set of items: accumulator-limited, term at a time.

One pass over the documents makes the postings of the terms that some item holds: a stored
row per document with its length and, for each such term, how often it occurs.  Document
frequencies and the totals N and L come from these rows.  No posting list is shuffled: a task
ranks its own documents, in blocks of ``BLOCK_DOCS``, and gives its ``k`` best per item.

In a block the terms of an item are taken by document frequency, rarest first.  A term may
open an accumulator for each of its documents as long as the terms still to come, at the
highest value each has in the block, could lift a document without one to the k-th highest
score so far (in the block, or found before by this task).  After that only open
accumulators are updated, with every term, so their scores are exact.  A document without
an accumulator scores less than k others, so nothing is lost; equality keeps them open.

Scores are whole numbers (see ``impact`` and ``weight``), ties go to the smaller doc_id.

What is broadcast: the items' terms, in blocks of items of about ``BLOCK_TERMS`` terms (one item
may exceed it alone); each block is one pass over the documents.  Candidates are at most k
per item and task.

Defined cases: null, empty and term-less texts are no documents of the collection and rank
nowhere; an item without terms has no rows; equal scores go by doc_id, null last; documents
that repeat are ranked each; each row of the items is searched by itself, also if its id
repeats; long texts are read whole, in stretches; a long run without a separator is one
term; extra columns do not disturb; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerspark.llm.common import keep, released

K = 20
BLOCK_DOCS = 16_384
BLOCK_TERMS = 1_000_000
_STRETCH = 1 << 20
# A-Z are lower-cased; of ASCII only letters and digits belong to a term, all else does.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a whole text in order, some at a time."""
    if not text:
        return
    plain = text.encode("utf-8", "surrogatepass").translate(_PLAIN)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + _STRETCH)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def impact(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """A term's part in a document's score, but for the term's weight."""
    m = 100 - 25 + (25 * n * docs) // total
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def asked(items: DataFrame) -> DataFrame:
    """item_id, and the distinct terms of its text with their counts; items without terms go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            counts = [Counter() for _ in range(batch.num_rows)]
            for c, text in zip(counts, batch.column("text").to_pylist()):
                for part in terms(text):
                    c.update(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array([sorted(c) for c in counts], pa.list_(pa.binary())),
                 pa.array([[c[t] for t in sorted(c)] for c in counts], pa.list_(pa.int64()))],
                ["item_id", "terms", "counts"])

    kind = items.schema["item_id"].dataType.simpleString()
    found = items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, terms array<binary>, counts array<long>")
    return found.where(F.size("terms") > 0)


def postings(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms) and the known terms with their counts; documents without terms go."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, width = shared.value, len(shared.value) + 1
        for batch in released(batches):
            n = np.zeros(batch.num_rows, np.int64)
            keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, text in enumerate(batch.column("text").to_pylist()):
                for part in terms(text):
                    n[i] += len(part)
                    ids = np.fromiter(map(number.get, part, repeat(-1)), np.int64, len(part))
                    one, many = np.unique(ids[ids >= 0], return_counts=True)
                    keys.append(one + i * width)
                    times.append(many)
            key, back = np.unique(np.concatenate(keys), return_inverse=True)
            tf = np.bincount(back, np.concatenate(times), len(key)).astype(np.int64)
            held = n > 0
            offsets = np.searchsorted(key, np.arange(batch.num_rows + 1) * width).astype(np.int32)
            out = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n),
                 pa.ListArray.from_arrays(offsets, pa.array((key % width).astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(tf))], ["doc_id", "n", "terms", "tfs"])
            yield out.filter(pa.array(held))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n long, terms array<int>, tfs array<long>")


class Block:
    """The postings of some documents, by term."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, docs: int, total: int):
        doc = np.repeat(np.arange(len(n)), sizes)
        order = np.argsort(term, kind="stable")
        self.doc = doc[order]
        self.value = impact(tf, n[doc], docs, total)[order]
        self.term, self.first, self.count = np.unique(term[order], return_index=True, return_counts=True)
        self.highest = np.maximum.reduceat(self.value, self.first) if len(self.term) else self.value
        self.size, self.opened = len(n), 0

    def best(self, query: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the block that may be among the k best, and their scores.

        ``query`` holds terms and factors (weight times occurrences), rarest first; ``floor`` is
        a score that k documents elsewhere already have, or 0.
        """
        place = np.searchsorted(self.term, [t for t, _ in query])
        held = [(p, f) for p, (t, f) in zip(place.tolist(), query) if f and p < len(self.term) and self.term[p] == t]
        bound = np.array([int(self.highest[p]) * f for p, f in held], np.int64)
        rest = np.cumsum(bound[::-1])[::-1]  # what this term and the later ones can add
        scores = np.zeros(self.size, np.int64)
        open_, least = None, floor
        for i, (p, f) in enumerate(held):
            if open_ is None and rest[i] < least:
                open_ = scores > 0
            run = slice(self.first[p], self.first[p] + self.count[p])
            doc, part = self.doc[run], self.value[run] * f
            if open_ is not None:
                mine = open_[doc]
                doc, part = doc[mine], part[mine]
            scores[doc] += part
            if open_ is None and i + 1 < len(held):
                some = scores[scores > 0]
                if len(some) >= k:
                    least = max(least, int(np.partition(some, -k)[-k]))
        found = np.flatnonzero(scores >= max(1, least))
        self.opened += int((scores > 0).sum())
        return found, scores[found]


def _blocks(batches: Iterator[pa.RecordBatch], docs: int, total: int) -> Iterator[tuple[Block, np.ndarray, np.ndarray]]:
    """Blocks of documents with their ids and which ids are null."""
    held: list[pa.RecordBatch] = []

    def made() -> tuple[Block, np.ndarray, np.ndarray]:
        t = pa.Table.from_batches(held).combine_chunks()
        ids = t.column("doc_id").combine_chunks()
        lists, tfs = t.column("terms").combine_chunks(), t.column("tfs").combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        block = Block(t.column("n").to_numpy(), sizes, lists.flatten().to_numpy().astype(np.int64),
                      tfs.flatten().to_numpy(), docs, total)
        return block, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)

    n = 0
    for batch in released(batches):
        for at in range(0, batch.num_rows, BLOCK_DOCS):
            part = batch.slice(at, BLOCK_DOCS)
            if n and n + part.num_rows > BLOCK_DOCS:
                yield made()
                held, n = [], 0
            held.append(part)
            n += part.num_rows
    if n:
        yield made()


def candidates(posted: DataFrame, queries: list[list[tuple[int, int]]], docs: int, total: int, k: int) -> DataFrame:
    """query, doc_id, score: each task's k best documents of every query."""
    shared = posted.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for block, ids, nulls in _blocks(batches, docs, total):
            for q, query in enumerate(shared.value):
                old = top.get(q)
                floor = int(old[2][-1]) if old is not None and len(old[2]) == k else 0
                found, scores = block.best(query, k, floor)
                if not len(found):
                    continue
                i, z, s = ids[found], nulls[found], scores
                if old is not None:
                    i, z, s = (np.concatenate(p) for p in zip(old, (i, z, s)))
                order = np.lexsort((i, z, -s))[:k]
                top[q] = i[order], z[order], s[order]
            del block
        for q, (i, z, s) in top.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), q, np.int64)), pa.array(i, mask=z), pa.array(s)], ["query", "doc_id", "score"])

    kind = posted.schema["doc_id"].dataType.simpleString()
    return posted.mapInArrow(run, f"query long, doc_id {kind}, score long")


def _searched_block(docs: DataFrame, block: pa.Table, k: int, item_type: str) -> DataFrame:
    names = sorted(set(block.column("terms").combine_chunks().flatten().to_pylist()))
    number = {t: i for i, t in enumerate(names)}
    posted = keep(postings(docs, number), "postings")
    row = posted.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("total")).first()
    counts = posted.select(F.explode("terms").alias("t")).groupBy("t").count()  # one row per asked term
    df = dict.fromkeys(range(len(names)), 0) | {r["t"]: r["count"] for r in counts.toLocalIterator()}
    queries = []
    for own, times in zip(block.column("terms").to_pylist(), block.column("counts").to_pylist()):
        pairs = sorted((df[number[t]], number[t], c) for t, c in zip(own, times) if df[number[t]])
        queries.append([(t, weight(row["docs"], d) * c) for d, t, c in pairs])
    found = candidates(posted, queries, row["docs"], row["total"], k)
    place = F.row_number().over(W.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    best = found.withColumn("rank", place).where(F.col("rank") <= k)
    spark = docs.sparkSession
    ids = pa.table({"query": pa.array(range(block.num_rows), pa.int64()), "item_id": block.column("item_id")})
    items = spark.createDataFrame(ids, schema=f"query long, item_id {item_type}")
    return best.join(F.broadcast(items), "query").select("item_id", "rank", "doc_id", "score")


def searched(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    stored = keep(asked(items), "items")
    item_type = items.schema["item_id"].dataType.simpleString()
    size = stored.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-size // block_terms))
    dealt = stored.withColumn("_block", F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)))
    parts = []
    for b in range(blocks):
        block = dealt.where(F.col("_block") == b).orderBy("item_id", "terms").drop("_block").toArrow()
        if block.num_rows:
            parts.append(_searched_block(docs, block, k, item_type))
    if not parts:
        return docs.sparkSession.createDataFrame(
            [], f"item_id {item_type}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
    return reduce(DataFrame.unionByName, parts)


ORACLE_SQL = r"""
WITH t AS (
  SELECT r, doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
p AS (SELECT r, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT r, sum(tf)::BIGINT AS n FROM p GROUP BY r),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM p, s GROUP BY term, docs),
q AS (
  SELECT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
c AS (
  SELECT item_id, p.r, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN n ON p.r = n.r CROSS JOIN s GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM c WHERE score > 0)
WHERE rank <= 20
"""
