"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.sources.scratch import materialize

#: One word: a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"

#: A side of a join is broadcast up to this many narrow rows, and joined plainly beyond.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: a lost executor costs no rerun."""
    return materialize(df, label)


def fold(id_col: str, folds: int, rest: int) -> Column:
    """True where crc32 of the id as text leaves ``rest``; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == rest, F.lit(False))


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a stored, narrow table: broadcast if its counted rows allow, else shuffled."""
    return big.join(F.broadcast(small) if small.count() <= limit else small, on, how)


def word_counts(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start+1, ... for each pair, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


#: What a remembered word takes beside its characters: text, dictionary entry, number, ids.
WORD_BYTES = 180


class WordPool:
    """Numbers of words after a space, each made once: some ``most`` bytes of words are remembered.

    ``encode`` gives the numbers of each of a list of words.  A word that ends in one of
    ``marks`` after a letter or digit is its stem's numbers and the mark's one.
    """

    def __init__(self, encode: Callable, marks: dict[str, int], most: int):
        self.encode, self.marks, self.most = encode, marks, most
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.n = self.end = self.held = 0
        self.flat, self.starts, self.lengths = np.empty(1 << 16, np.int32), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def _append(self, flat: np.ndarray, lengths: np.ndarray) -> int:
        """Add entries; returns the place of the first one."""
        n, end = self.n + len(lengths), self.end + len(flat)
        while n > len(self.starts):
            self.starts, self.lengths = (np.concatenate([a, np.empty_like(a)]) for a in (self.starts, self.lengths))
        while end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        first = self.n
        self.flat[self.end:end], self.lengths[first:n] = flat, lengths
        self.starts[first:n] = self.end + np.cumsum(lengths) - lengths
        self.n, self.end = n, end
        return first

    def _add(self, rows: list) -> int:
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        return self._append(np.fromiter(itertools.chain.from_iterable(rows), np.int32, int(lengths.sum())), lengths)

    def _meet(self, words: list[str]) -> np.ndarray:
        """The numbers of distinct words that are not known, which become known."""
        known, marks = self.known, self.marks
        marked = np.array([w[-1:] in marks and w[-2:-1].isalnum() for w in words], bool)
        ends = [words[i] for i in np.flatnonzero(marked).tolist()]
        plain = [words[i] for i in np.flatnonzero(~marked).tolist()]
        met = len(plain)
        plain += {w[:-1] for w in ends if w[:-1] not in known}.difference(plain)
        first = self._add(self.encode(plain))
        known.update(zip(plain, range(first, self.n)))
        out = np.empty(len(words), np.int64)
        out[~marked] = first + np.arange(met)
        if ends:
            stem = np.fromiter((known[w[:-1]] for w in ends), np.int64, len(ends))
            size = self.lengths[stem]
            begin = np.cumsum(size + 1) - (size + 1)
            flat = np.empty(int((size + 1).sum()), np.int32)
            flat[ranges(begin, size)] = self.flat[ranges(self.starts[stem], size)]
            flat[begin + size] = [marks[w[-1]] for w in ends]
            first = self._append(flat, size + 1)
            known.update(zip(ends, range(first, self.n)))
            out[marked] = first + np.arange(len(ends))
        return out

    def places(self, words: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.known.get, words, itertools.repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            unseen = [words[i] for i in missing.tolist()]
            size = sum(map(len, unseen)) + WORD_BYTES * len(unseen)
            if self.held + size > self.most:
                self.clear()
                missing, unseen = np.arange(len(words)), words
                size = sum(map(len, words)) + WORD_BYTES * len(words)
            self.held += size
            found[missing] = self._meet(unseen)
        return found

    def of_texts(self, texts: list[str], whole: list[bool], firsts: Callable) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all texts in order, and how many each text has.

        Texts are cut at spaces; ``firsts`` gives the numbers of each text's beginning before
        its first space, or of all of a text marked ``whole``.
        """
        rows = pc.split_pattern(pa.array(["" if w else t for t, w in zip(texts, whole)], pa.string()), " ")
        sizes = np.diff(rows.offsets.to_numpy())
        coded = rows.flatten().dictionary_encode()
        index = coded.indices.to_numpy()
        begins = np.cumsum(sizes) - sizes
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        own = [t if w else distinct[i] for t, w, i in zip(texts, whole, index[begins].tolist())]
        place = self.places(distinct)
        n, end = self.n, self.end
        place = np.concatenate([place, self._add(list(firsts(own))) + np.arange(len(texts))])
        index = index.copy()
        index[begins] = len(distinct) + np.arange(len(texts))
        counts = self.lengths[place]
        ends = np.concatenate([[0], np.cumsum(counts)])
        held = pa.LargeListArray.from_arrays(ends, pa.array(self.flat[ranges(self.starts[place], counts)]))
        out = held.take(pa.array(index)).flatten().to_numpy()
        self.n, self.end = n, end  # beginnings are not remembered
        return out, np.add.reduceat(counts[index], begins)


def in_groups(texts: list[str], size: int) -> Iterator[list[str]]:
    """The texts in order, in lists that end once they hold ``size`` characters."""
    held: list[str] = []
    n = 0
    for t in texts:
        held.append(t)
        n += len(t)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def _trim() -> Callable | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        return None


_give_back = _trim()


def released(batches: Iterator) -> Iterator:
    """The items in turn; after each, memory that was freed goes back to the system.

    Workers outlive their tasks, so what one keeps for later is missing for others.
    """
    for batch in batches:
        yield batch
        pa.default_memory_pool().release_unused()
        if _give_back:
            _give_back(0)


def blobs(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of ``values`` as one binary each."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(counts),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 50_000) -> Iterator[pa.Table]:
    """Tables that hold only whole groups, from batches in which equal keys are neighbours."""
    held: list[pa.Table] = []
    n = 0
    for batch in released(batches):
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        n += batch.num_rows
        if n < rows:
            continue
        t = pa.concat_tables(held).combine_chunks()
        cut = group_starts(t, keys)[-1]
        if cut:
            yield t.slice(0, cut)
        held, n = [t.slice(cut)], t.num_rows - cut
    if n:
        yield pa.concat_tables(held).combine_chunks()


def group_starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Where each group begins, in a table in which equal keys are neighbours."""
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for k in keys:
        v = t.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)
