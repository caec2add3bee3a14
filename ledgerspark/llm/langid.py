"""Language by which n-grams a text holds: one Bloom filter per language, bit-sliced.

Training counts letter trigrams (a word is padded by blanks) per language over all
training texts, and keeps those that make up at least ``SHARE`` of their language's
trigrams: at most 1 / SHARE per language, whatever the corpus holds.  They go into Bloom
filters that share one table: a row per bit position, a bit per language.  So ``HASHES``
rows combined by AND give at once every language that holds an n-gram.

A text's score for a language is the number of its n-grams found there (a popcount of the
language's bit over all masks), less what the filter finds by mistake: with false-positive
rate f, n n-grams and h hits it is (h - n f) / (1 - f).  The highest wins, the smallest
name on ties.  ``score`` is the winner's part of all languages' scores.

The corpus is read once for the counts (summed per task first, so a language with a third
of all rows costs no more) and once to predict, without a shuffle.  The table, 8 bytes x
rows x words of 64 languages, is broadcast; its size is bounded by languages / SHARE.

Defined cases: null texts and texts without a letter are ``und`` with score 0; so is
every text when nothing could be learned; a text whose n-grams are all unknown gets the
smallest name with score 0; a long text is read whole, in stretches of ``STRETCH``
characters that are padded by blanks; extra columns are carried along, columns named like
the results are replaced; an empty table gives an empty one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import fold, mixed, released

SHARE = 5e-5
HASHES = 4
ROWS_PER_GRAM = 12  # rows of the table for each n-gram of the largest language
STRETCH = 1 << 20
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)
    return _letters


def stretches(texts: list[str | None]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Lower-cased texts in groups of about STRETCH characters, with the place of each in the list."""
    which: list[int] = []
    parts: list[str] = []
    size = 0
    for i, t in enumerate(texts):
        if not t:
            continue
        low = t.lower()
        for at in range(0, len(low), STRETCH):
            part = low[at:at + STRETCH]
            which.append(i)
            parts.append(part)
            size += len(part)
            if size >= STRETCH:
                yield np.array(which), parts
                which, parts, size = [], [], 0
    if parts:
        yield np.array(which), parts


def trigrams(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all trigrams whose middle is a letter, and the place of the part each is from."""
    points = np.frombuffer((" " + " ".join(parts) + " ").encode("utf-32-le"), np.uint32)
    is_letter = letters()[points]
    clean = np.where(is_letter, points, 32).astype(np.uint64)
    middle = np.flatnonzero(is_letter)
    codes = clean[middle - 1] << np.uint64(42) | clean[middle] << np.uint64(21) | clean[middle + 1]
    ends = np.cumsum([len(p) + 1 for p in parts])
    return codes, np.searchsorted(ends, middle - 1, "right")


def counted(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, gram, n over all texts with a language; summed per batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            by = defaultdict(list)
            for t, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by[g].append(t)
            for g, texts in by.items():
                codes, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
                for _, parts in stretches(texts):
                    more, k = np.unique(trigrams(parts)[0], return_counts=True)
                    codes, back = np.unique(np.concatenate([codes, more]), return_inverse=True)
                    n = np.bincount(back, np.concatenate([n, k]), len(codes)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(n)],
                    ["lang", "gram", "n"])

    part = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    return part.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filters:
    """The bit-sliced filters of all languages."""

    def __init__(self, grams: dict[str, np.ndarray]):
        self.names = sorted(grams)
        most = max((len(g) for g in grams.values()), default=0)
        self.bits = max(6, int(np.ceil(np.log2(max(1, most) * ROWS_PER_GRAM))))
        self.table = np.zeros((1 << self.bits, -(-len(self.names) // 64)), np.uint64)
        for i, name in enumerate(self.names):
            for rows in self._rows(grams[name]):
                self.table[rows, i // 64] |= np.uint64(1) << np.uint64(i % 64)
        full = np.array([(self.table[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(self.names))])
        self.mistakes = np.minimum(full**HASHES, 0.99)

    def _rows(self, codes: np.ndarray) -> Iterator[np.ndarray]:
        h = mixed(codes.astype(np.uint64))
        step = mixed(h) | np.uint64(1)
        for _ in range(HASHES):
            yield (h >> np.uint64(64 - self.bits)).astype(np.int64)
            with np.errstate(over="ignore"):
                h = h + step

    def masks(self, codes: np.ndarray) -> np.ndarray:
        """For each n-gram the languages that hold it, as bits."""
        out = None
        for rows in self._rows(codes):
            out = self.table[rows] if out is None else out & self.table[rows]
        return out

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected hits per text and language, and the number of n-grams per text."""
        hits, n = np.zeros((len(texts), len(self.names))), np.zeros(len(texts), np.int64)
        for which, parts in stretches(texts):
            codes, part = trigrams(parts)
            doc = which[part]
            n += np.bincount(doc, minlength=len(texts))
            distinct, back = np.unique(codes, return_inverse=True)
            masks = self.masks(distinct)
            for i in range(len(self.names)):
                held = (masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).astype(bool)
                hits[:, i] += np.bincount(doc[held[back]], minlength=len(texts))
        return np.maximum(0, (hits - n[:, None] * self.mistakes) / (1 - self.mistakes)), n

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        scores, n = self.scores(texts)
        best, total = scores.argmax(1), scores.sum(1)
        top = scores[np.arange(len(texts)), best]
        sure = np.where((n > 0) & (total > 0), top / np.where(total > 0, total, 1), 0.0)
        return [self.names[b] if k else UNKNOWN for b, k in zip(best, n)], sure


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", share: float = SHARE) -> Filters:
    """Filters of the frequent n-grams of each language in the frame."""
    counts = counted(docs, text, lang)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))  # one row per language
    frequent = counts.join(totals, "lang").where(F.col("n") >= share * F.col("total")).select("lang", "gram")
    grams = defaultdict(list)
    for r in frequent.toLocalIterator():  # at most 1 / share per language
        grams[r.lang].append(r.gram)
    return Filters({k: np.array(sorted(v), np.int64) for k, v in grams.items()})


def identify(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """The frame with lang_pred and score."""
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            names, sure = shared.value.predict(batch.column(place).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(sure)],
                                             [*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                                              T.StructField("score", T.DoubleType())]))


def predicted(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from the other folds."""
    held_out = fold("doc_id", FOLDS, HELD_OUT)
    filters = learn(docs.where(~held_out).select("text", "lang"))
    out = identify(docs.select("doc_id", "text", held_out.alias("held_out")), filters)
    return out.select("doc_id", "held_out", "lang_pred", "score")


def with_language(docs: DataFrame) -> DataFrame:
    """The documents with a letter, in their own columns (all go when nothing could be learned).

    A text whose n-grams no language holds has score 0 and stays.
    """
    filters = learn(docs.where(~fold("doc_id", FOLDS, HELD_OUT)).select("text", "lang"))
    found = identify(docs.select(*[F.col(c).alias(f"_{c}") for c in docs.columns]), filters, "_text")
    return found.where(F.col("lang_pred") != UNKNOWN).select(*[F.col(f"_{c}").alias(c) for c in docs.columns])
