"""Jaccard join on word shingles, exact: documents whose sets overlap by 75 % are linked.

A text is lower-cased (A-Z) and cut into words; its set holds a 64-bit hash of every run of
five words (of the whole sequence where there are fewer).  Texts with equal sets are one
class, named by a hash of the set, and never compared with each other.

1. Support.  Hashes are dealt to buckets in packed arrays, and each bucket counts which
   occur in two classes or more.  A set can have a partner only if three quarters of its
   shingles do, so most documents leave here; their texts are not shuffled at any point.
2. The rest get exact frequencies, and their shingles an order: rarest first.  For
   overlap t = ceil(3/4 n), two linked sets share ``c`` of their first n - t + c shingles.
   Shingles that occur once are in this prefix but match nothing, and are never written.
3. Size-aware heavy-light join.  A small (light) set enumerates the 2-subsets of its prefix
   for c = 2; a large (heavy) one is listed under each shingle of its prefix for c = 1, and
   so are light ones close enough in size to be linked to a heavy one.  The boundary is the
   size at which subsets written plus inverted-list entries written and scanned are fewest,
   from a histogram over all sets.
4. Links are needed to find components, so lists are first compared star-wise: each set with
   one leader, then with members of other components; sets that are already connected need
   no comparison.  What remains, sets that share a list and lie in different components, is
   compared without exception, in units of two chunks of sets, of which only connecting
   links leave.  Every comparison intersects the two sets.

Hot groups: equal texts are one class; a group of near copies costs a few comparisons per
member; a passage that many documents share lies at the end of the order.

Defined cases: a null or empty text, or one without words, has an empty set and is linked
with nothing; rows are compared row by row, so repeated rows are copies of each other; a
class with null ids only has a null component; extra columns are ignored; an empty table
gives an empty one.  Sets are named by 64 bits: among N different sets two share a name
with a probability below N^2 / 2^65.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import blobs, join_small, keep, mixed, ranges, released, whole_groups
from ledgerspark.llm.components import forest, joined
from ledgerspark.operators.ordered import with_rank

WORDS = 5
STRETCH = 1 << 20
BUCKET_ENTRIES = 2_000_000
DEALT_ENTRIES = 1_000_000  # packed at a time
MIN_BUCKETS = 16
NARROW_ROWS = 1_000_000  # ids that are broadcast, after counting, to spare the texts a shuffle
CHUNK_SETS = 256  # sets compared with as many in one unit of work
ROUNDS = 2  # of comparisons with members of other components
SIZE_STEP = 1.06  # width of a size class in the histogram

_PLACES = 64
_spell = np.append(mixed(np.arange(1, _PLACES * 256 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)), np.uint64(0))
_turn = mixed(np.arange(1000, 1000 + WORDS, dtype=np.uint64)) | np.uint64(1)


# ------------------------------------------------------------------ shingles

def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, and how many words each text has."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    first = ~blank
    first[1:] &= blank[:-1]
    at = np.flatnonzero(first)
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    words = np.diff(np.searchsorted(at, bounds))
    if not len(at):
        return np.zeros(0, np.uint64), words
    ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    begins = np.concatenate([[0], at]).astype(np.int32)
    place = np.arange(len(data), dtype=np.int32) - np.repeat(begins, np.diff(np.append(begins, len(data))))
    spelled = (place & (_PLACES - 1)) << 8 | data
    spelled[blank] = _PLACES * 256  # nothing
    value = _spell.take(spelled)
    with np.errstate(over="ignore"):
        if (ends - at).max() > _PLACES:
            part = (place // _PLACES).astype(np.uint64)
            value *= np.where(part > 0, mixed(part * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1), np.uint64(1))
        return mixed(np.add.reduceat(value, at) + (ends - at).astype(np.uint64)), words


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order."""
    held: list[bytes] = []
    size = 0
    for t in texts:
        held.append((t or "").encode().lower())
        size += len(held[-1])
        if size >= STRETCH:
            yield from _sets(held)
            held, size = [], 0
    yield from _sets(held)


def _sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    h, words = word_hashes(texts)
    with np.errstate(over="ignore"):
        runs = np.zeros(max(0, len(h) - WORDS + 1), np.uint64)
        for i in range(WORDS):
            runs += h[i:i + len(runs)] * _turn[i]
        runs = mixed(runs)
        at = 0
        for n in words.tolist():
            if n >= WORDS:
                s = np.sort(runs[at:at + n - WORDS + 1])
                yield s[np.concatenate([[True], s[1:] != s[:-1]])]
            elif n:
                yield mixed((h[at:at + n] * _turn[:n]).sum(keepdims=True) + np.uint64(n))
            else:
                yield np.zeros(0, np.uint64)
            at += n


def set_name(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63


def named(docs: DataFrame) -> DataFrame:
    """doc_id, n, name of every row's set; the name is null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            rows = [(len(s), set_name(s) if len(s) else None) for s in shingle_sets(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())],
                ["doc_id", "n", "name"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, name long")


# ------------------------------------------------------- frequencies by bucket

def _dealt(names: list[int], sets: list[np.ndarray], buckets: int, kind) -> Iterator[pa.RecordBatch]:
    """Packed rows: bucket, names of sets, how many hashes each has there, the hashes."""
    if not names:
        return
    sizes = np.array([len(s) for s in sets])
    h = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    bucket = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint16 if buckets <= 65536 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    bucket, owner, h = bucket[order], owner[order], h[order].astype(kind)
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    ids = np.array(names, np.int64)
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (bucket[1:] != bucket[:-1])])
    runs = np.flatnonzero(new)
    run_sizes = np.diff(np.concatenate([runs, [len(h)]]))
    run_cuts = np.concatenate([np.searchsorted(runs, cuts), [len(runs)]])
    yield pa.RecordBatch.from_arrays(
        [pa.array(bucket[cuts].astype(np.int32)), blobs(ids[owner[runs]], np.diff(run_cuts)),
         blobs(run_sizes.astype(np.uint32), np.diff(run_cuts)), blobs(h, np.diff(np.concatenate([cuts, [len(h)]])))],
        ["bucket", "names", "sizes", "hashes"])


_DEALT = "bucket int, names binary, sizes binary, hashes binary"


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _buckets(batches: Iterator[pa.RecordBatch], kind) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each bucket: names, run sizes, hashes, and in how many sets each hash occurs."""
    for t in whole_groups(batches, ["bucket"], 1):
        b = t.column("bucket").to_numpy()
        cuts = [*np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])), len(b)]
        for lo, hi in zip(cuts, cuts[1:]):
            part = t.slice(lo, hi - lo)
            h = _joined(part.column("hashes"), kind)
            order = np.argsort(h, kind="stable")
            s = h[order]
            first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            times = np.diff(np.concatenate([first, [len(s)]]))
            often = np.empty(len(h), np.uint32)
            often[order] = np.repeat(times, times)
            yield _joined(part.column("names"), np.int64), _joined(part.column("sizes"), np.uint32), h, often


def _with_support(docs: DataFrame, buckets: int) -> DataFrame:
    """name, k: how many shingles of a set occur in another set as well (at least so many
    where names are equal: copies in other tasks count as another set)."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            seen: set[int] = set()
            own: dict[int, np.ndarray] = {}
            size = 0
            for s in shingle_sets(batch.column(0).to_pylist()):
                if not len(s) or (name := set_name(s)) in seen:
                    continue
                seen.add(name)
                own[name] = s
                size += len(s)
                if size >= DEALT_ENTRIES:
                    yield from _dealt(list(own), list(own.values()), buckets, np.uint32)
                    own, size = {}, 0
            yield from _dealt(list(own), list(own.values()), buckets, np.uint32)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, sizes, _, often in _buckets(batches, np.uint32):
            k = np.add.reduceat((often > 1).astype(np.int64), np.cumsum(sizes, dtype=np.int64) - sizes)
            part, order, cuts = _by_part(names[k > 0], parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), blobs(names[k > 0][order], cuts), blobs(k[k > 0][order], cuts)], ["part", "names", "k"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["part"], 1):
            own, back = np.unique(_joined(t.column("names"), np.int64), return_inverse=True)
            k = np.bincount(back, _joined(t.column("k"), np.int64), len(own)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(k)], ["name", "k"])

    parts = buckets
    packed = docs.select("text").mapInArrow(deal, _DEALT)
    counts = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(
        count, "part int, names binary, k binary")
    # A name comes once from each map batch and bucket, and copies elsewhere add their own.
    return counts.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(total, "name long, k long")


def _by_part(names: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts that the names belong to, an order by part, and how many each part has."""
    part = (mixed(names.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    n = np.bincount(part, minlength=parts)
    own = np.flatnonzero(n)
    return own, order, n[own]


def _sets_of(docs: DataFrame, names: DataFrame) -> DataFrame:
    """name, n, hashes (uint64) of the named classes, read again from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            wanted = batch.column(1).to_pylist()
            own = [(w, s) for w, s in zip(wanted, shingle_sets(batch.column(0).to_pylist())) if len(s) and set_name(s) == w]
            if own:
                n = np.array([len(s) for _, s in own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in own], pa.int64()), pa.array(n), blobs(np.concatenate([s for _, s in own]), n)],
                    ["name", "n", "hashes"])

    chosen = names.select(F.col("doc_id").alias("_doc"), "name")
    rows = join_small(docs.select(F.col("doc_id").cast("long").alias("_id"), "text"), chosen,
                      F.col("_id").eqNullSafe(F.col("_doc")), "inner", NARROW_ROWS)
    return rows.select("text", "name").mapInArrow(run, "name long, n long, hashes binary")


def _prefixes(sets: DataFrame, buckets: int) -> DataFrame:
    """name, n, k and the shingles of the longer prefix: hashes (rarest first) and frequencies.

    k is how many shingles of the set occur in another one.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            names = batch.column(0).to_pylist()
            yield from _dealt(names, [np.frombuffer(b, np.uint64) for b in batch.column(1).to_pylist()], buckets, np.uint64)

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, sizes, h, often in _buckets(batches, np.uint64):
            part, order, cuts = _by_part(names, buckets)
            begin = np.cumsum(sizes, dtype=np.int64) - sizes
            at = ranges(begin[order], sizes[order].astype(np.int64))
            ends = np.cumsum(cuts)
            entries = np.add.reduceat(sizes[order].astype(np.int64), ends - cuts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), blobs(names[order], cuts), blobs(sizes[order], cuts),
                 blobs(h[at], entries), blobs(often[at], entries)], ["part", "names", "sizes", "h", "f"])

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["part"], 1):
            p = t.column("part").to_numpy()
            cuts = [*np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]])), len(p)]
            for lo, hi in zip(cuts, cuts[1:]):
                yield from _ordered(t.slice(lo, hi - lo))

    packed = sets.select("name", "hashes").mapInArrow(deal, _DEALT)
    parts = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(
        shared, "part int, names binary, sizes binary, h binary, f binary")
    return parts.repartition(buckets, "part").sortWithinPartitions("part").mapInArrow(
        prefix, "name long, n long, k long, h binary, f binary")


def _ordered(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """The kept prefix of every set of one part."""
    names = np.repeat(_joined(t.column("names"), np.int64), _joined(t.column("sizes"), np.uint32))
    h, f = _joined(t.column("h"), np.uint64), _joined(t.column("f"), np.uint32)
    order = np.lexsort((h, f, names))
    names, h, f = names[order], h[order], f[order]
    starts = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    n = np.diff(np.append(starts, len(names)))
    k = np.add.reduceat((f > 1).astype(np.int64), starts)
    # Single shingles come first; of the others as many are kept as the longer prefix has room for.
    length = np.clip(n - -(-3 * n // 4) + 2 - (n - k), 0, k)
    live = 4 * k >= 3 * n
    at = ranges((starts + n - k)[live], length[live])
    yield pa.RecordBatch.from_arrays(
        [pa.array(names[starts][live]), pa.array(n[live]), pa.array(k[live]), blobs(h[at], length[live]), blobs(f[at], length[live])],
        ["name", "n", "k", "h", "f"])


# --------------------------------------------------------- heavy and light sets

def _short(n: int, k: int, length: int) -> int:
    """Of the longer prefix's kept shingles, how many belong to the shorter one."""
    return max(0, min(length, n - -(-3 * n // 4) + 1 - (n - k)))


def _costs(prefixes: DataFrame) -> DataFrame:
    """size class, 2-subsets that sets would write, list entries they would write and scan.

    Lists are compared star-wise, so an entry is scanned against one leader.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            rows = []
            for n, k, f in zip(*(batch.column(i).to_pylist() for i in range(3))):
                f = len(f) // 4
                rows.append((int(math.log(n) / math.log(SIZE_STEP)), f * (f - 1) // 2, 2 * _short(n, k, f)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else
                                             [pa.array([], pa.int64())] * 3, ["size", "light", "heavy"])

    rows = prefixes.select("n", "k", "f").mapInArrow(run, "size long, light long, heavy long")
    return rows.groupBy("size").agg(F.sum("light").alias("light"), F.sum("heavy").alias("heavy"))


def boundary(costs: list[tuple[int, int, int]]) -> float:
    """The largest size of a light set: 0, or the end of a size class, whichever costs least."""
    def cost(limit: float) -> float:
        light = sum(c for s, c, _ in costs if SIZE_STEP ** (s + 1) <= limit + 1e-9)
        return light + sum(c for s, _, c in costs if SIZE_STEP ** (s + 1) > 0.75 * limit)

    return min([0.0, *(SIZE_STEP ** (s + 1) for s, _, _ in sorted(costs))], key=cost)


def _lists(prefixes: DataFrame, limit: float) -> DataFrame:
    """key, name, n, k: every set under its 2-subsets or its prefix shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for name, n, k, h in zip(*(batch.column(i).to_pylist() for i in range(4))):
                h = np.frombuffer(h, np.uint64)
                keys = [np.zeros(0, np.uint64)]
                if n <= limit:
                    i, j = np.triu_indices(len(h), 1)
                    with np.errstate(over="ignore"):
                        keys.append(mixed(h[i] * _turn[0] + h[j]))
                if n > 0.75 * limit:
                    keys.append(h[:_short(n, k, len(h))])
                key = np.concatenate(keys).view(np.int64)
                for at in range(0, len(key), 10_000):
                    part = key[at:at + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array(part), *(
                        pa.array(np.full(len(part), v, np.int64)) for v in (name, n, k))], ["key", "name", "n", "k"])

    return prefixes.select("name", "n", "k", "h").mapInArrow(run, "key long, name long, n long, k long")


def _may_link(n1, k1, n2, k2):
    """Sizes within 3/4, and shared shingles enough for 3/7 of both sizes."""
    return (4 * F.least(n1, n2) >= 3 * F.greatest(n1, n2)) & (7 * F.least(k1, k2) >= 3 * (n1 + n2))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs a, b whose sets overlap enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= 75 * (len(x) + len(y) - common))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    one = sets.select(F.col("name").alias("a"), F.col("hashes").alias("x"))
    two = sets.select(F.col("name").alias("b"), F.col("hashes").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def links(docs: DataFrame, classes: DataFrame, total: int, rounds: int = ROUNDS,
          limit: float | None = None) -> DataFrame | None:
    """Components of linked classes: id (name), root; None where nothing is linked.

    ``classes``: name, n and the smallest doc_id; ``total``: shingles of all documents.
    """
    support = _with_support(docs, max(MIN_BUCKETS, -(-total // BUCKET_ENTRIES)))
    live = keep(classes.join(support, "name").where("4 * k >= 3 * n").select("doc_id", "name", "n"), "supported")
    if live.isEmpty():
        return None
    sets = keep(_sets_of(docs, live), "sets")
    if sets.count() > live.count():  # rows repeat with their ids
        sets = keep(sets.dropDuplicates(["name"]), "sets")
    left = sets.agg(F.sum("n")).first()[0] or 0
    prefixes = keep(_prefixes(sets, max(MIN_BUCKETS, -(-left // BUCKET_ENTRIES))), "prefixes")
    if limit is None:
        limit = boundary([tuple(r) for r in _costs(prefixes).collect()])  # one row per size class
    lists = _lists(prefixes, limit)
    alone = lists.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    lists = keep(lists.join(alone, "key"), "lists")

    compared = roots = None
    for turn in range(rounds + 1):
        here, ends = _still_open(lists, roots)
        other = F.when(F.col("root") == F.col("lo.root"), F.col("hi")).otherwise(F.col("lo"))
        pairs = here.join(ends, "key").withColumn("o", other)
        pairs = pairs.where(_may_link(F.col("n"), F.col("k"), F.col("o.n"), F.col("o.k")))
        if turn == 0:
            # One leader for each set: the one it shares most lists with.
            pairs = pairs.groupBy("name", F.col("o.name").alias("leader")).count()
            pairs = pairs.groupBy("name").agg(F.max(F.struct("count", "leader")).alias("m")).select("name", "m.leader")
        else:
            pairs = pairs.select("name", F.col("o.name").alias("leader"))
        pairs = pairs.select(F.least("name", "leader").alias("a"), F.greatest("name", "leader").alias("b")).where("a <> b").distinct()
        if compared is not None:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        pairs = keep(pairs, "pairs")
        if not pairs.isEmpty():
            compared = pairs if compared is None else compared.union(pairs)
            good = keep(_verified(pairs, sets), "verified")
            roots = joined(roots, good)
    here, ends = _still_open(lists, roots)
    rest = _in_chunks(here.join(ends.select("key", F.col("lo.name").alias("near")), "key"), sets)
    return roots if rest is None else joined(roots, rest)


def _still_open(lists: DataFrame, roots: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The lists with each set's component, and for lists that hold several the two outermost."""
    if roots is None:
        here = lists.withColumn("root", F.col("name"))
    else:
        here = lists.join(roots.withColumnRenamed("id", "name"), "name", "left").withColumn(
            "root", F.coalesce("root", "name"))
    member = F.struct("root", "name", "n", "k")
    ends = here.groupBy("key").agg(F.min(member).alias("lo"), F.max(member).alias("hi"))
    return here, ends.where("lo.root <> hi.root")


def _in_chunks(open_: DataFrame, sets: DataFrame, chunk: int = CHUNK_SETS) -> DataFrame | None:
    """Links between components, from comparing everything that still shares a list.

    ``open_``: key, name, root, near.  Sets that share lists are put side by side and cut
    into chunks; every two chunks that meet in a list, and are not all of one component, are
    one unit of work.  Links leave it as a spanning forest, so no pair is ever a row.
    """
    open_ = keep(open_.select("key", "name", "root", "near"), "open")
    if open_.isEmpty():
        return None
    order = keep(open_.groupBy("name", "root").agg(F.min("near").alias("near")), "order")
    placed = with_rank(order, ["near", "root", "name"], "place")
    placed = keep(placed.select("name", "root", F.floor(F.col("place") / chunk).cast("long").alias("chunk")), "placed")
    met = keep(open_.select("key", "name").join(placed, "name").groupBy("key", "chunk").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi")), "met")
    x, y = met.alias("x"), met.alias("y")
    several = F.least("x.lo", "y.lo") < F.greatest("x.hi", "y.hi")
    units = keep(x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.chunk") <= F.col("y.chunk")) & several).select(
        F.col("x.chunk").alias("a"), F.col("y.chunk").alias("b")).distinct(), "units")
    rows = sets.join(placed, "name").select("chunk", "name", "root", "hashes")
    left = units.join(rows, F.col("a") == F.col("chunk")).withColumn("side", F.lit(0))
    right = units.where("a < b").join(rows, F.col("b") == F.col("chunk")).withColumn("side", F.lit(1))
    dealt = left.union(right).select("a", "b", "side", "name", "root", "hashes")
    tasks = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["a", "b"], 1):
            a, b = t.column("a").to_numpy(), t.column("b").to_numpy()
            cuts = [*np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])), t.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                part = t.slice(lo, hi - lo)
                names, root = part.column("name").to_numpy(), part.column("root").to_numpy()
                side = part.column("side").to_numpy()
                linked = _linked([np.frombuffer(h, np.uint64) for h in part.column("hashes").to_pylist()])
                linked &= (root[:, None] != root[None]) & (np.arange(len(names))[:, None] < np.arange(len(names)))
                if side.any():
                    linked &= side[:, None] != side[None]
                i, j = np.nonzero(linked)
                edges = [(x, y) for x, y in forest(zip(names[i].tolist(), names[j].tolist())).items() if x != y]
                if edges:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*edges)], ["a", "b"])

    return keep(dealt.repartition(tasks, "a", "b").sortWithinPartitions("a", "b").mapInArrow(run, "a long, b long"), "rest")


def _linked(sets: list[np.ndarray]) -> np.ndarray:
    """For each two sets, whether they overlap enough."""
    n = np.array([len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    renamed = np.cumsum(shared) - 1
    row, use = np.repeat(np.arange(len(sets)), n), shared[column]
    row, column = row[use], renamed[column[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(shared.sum()), 4096):
        lo, hi = np.searchsorted(column, (at, at + 4096))
        has = np.zeros((len(sets), 4096), np.float32)
        has[row[lo:hi], column[lo:hi] - at] = 1
        common += has @ has.T  # whole numbers below 2^24 are exact
    return 100 * common.astype(np.int64) >= 75 * (n[:, None] + n[None] - common.astype(np.int64))


def components(docs: DataFrame, rounds: int = ROUNDS, limit: float | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id for every row.

    ``limit`` sets the largest light set by hand; the result does not depend on it.
    """
    rows = keep(named(docs), "shingled")
    total = rows.agg(F.sum("n")).first()[0] or 0
    classes = keep(rows.where("n > 0").groupBy("name").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n")), "classes")
    roots = links(docs, classes, total, rounds, limit)
    if roots is None:
        tops = classes.select("name", F.col("doc_id").alias("component_id"))
    else:
        own = classes.join(roots.withColumnRenamed("id", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))
        least = own.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        tops = own.join(least, "root").select("name", "component_id")
    full = rows.where("n > 0").join(tops, "name").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    none = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.union(none)


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id, in the columns of ``docs``.

    Of rows that share this id one stays, whichever text is smallest; rows without an id
    or without words all stay.
    """
    found = components(docs.select("doc_id", "text"))
    ids = found.groupBy("doc_id").agg(F.count("*").alias("_rows"), F.max(
        F.col("doc_id") == F.col("component_id")).alias("_first")).where("_first")
    stay = keep(ids.select(F.col("doc_id").alias("_stay"), "_rows"), "stay")
    own = [f"_c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*own)
    place = docs.columns.index
    key = F.col(own[place("doc_id")])
    marked = join_small(rows, stay, key == F.col("_stay"), "left", NARROW_ROWS)
    marked = marked.where(F.col("_stay").isNotNull() | key.isNull())
    once = marked.where("_rows is null or _rows = 1").select(*own)
    if stay.where("_rows > 1").isEmpty():
        return once.toDF(*docs.columns)
    text = F.coalesce(F.col(own[place("text")]), F.lit(""))
    several = marked.where("_rows > 1").groupBy("_stay").agg(F.min_by(F.struct(*own), text).alias("r")).select("r.*")
    return once.union(several).toDF(*docs.columns)
