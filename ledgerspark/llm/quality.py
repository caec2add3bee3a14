"""Document quality from a chain over its lines.

A linear-chain conditional random field labels every line good or bad.  A line's features
are its make-up (shares of character kinds, lengths, repetition in the document) and the
main ones of the lines before and after it, all taken from arrays of code points.
Forward-backward gives each line's probability of being good; a document's quality is
their mean weighted by line length.

Training: each line of a labelled document takes its document's label, and the chain's
weights and transitions climb the regularised log likelihood.  It uses at most
``TRAIN_DOCS`` labelled documents, those with the smallest hashes of their ids, and of
each at most ``TRAIN_LINES`` neighbouring lines from a place fixed by the same hash; both
bounds are parameters, and only these lines reach the driver.  Scoring reads every line of
every document, inside its partition and without a shuffle.

Defined cases: a null or empty text is one empty line; a document with contradicting
labels, or a null one, teaches nothing; with no labels, or of one kind only, every score
is that kind's share (0.5 without labels); extra columns are carried along, columns
named like the results are replaced; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import fold, mixed, released

TRAIN_DOCS = 4000
TRAIN_LINES = 48
ROUNDS = 150
PENALTY = 1e-4
STRETCH = 1 << 20
FOLDS, HELD_OUT = 3, 1

_KINDS = ("lower", "upper", "digit", "blank", "stop", "comma", "mark", "other_letter", "wide")
_kinds: np.ndarray | None = None


def kinds() -> np.ndarray:
    """The kind of each code point, as a place in _KINDS."""
    global _kinds
    if _kinds is None:
        k = np.full(0x110000, _KINDS.index("wide"), np.uint8)
        for c in range(0x3000):
            s = chr(c)
            if s.isalpha():
                k[c] = 1 if s.isupper() else 0 if s.islower() else 7
            elif s.isdigit():
                k[c] = 2
            elif s.isspace():
                k[c] = 3
            elif s in ".?!":
                k[c] = 4
            elif s in ",;:'\"-()":
                k[c] = 5
            elif c < 0x2000:
                k[c] = 6
        _kinds = k
    return _kinds


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line, its length, and how many lines each text has."""
    texts = [t or "" for t in texts]
    points = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(points == 10)
    begins = np.concatenate([[0], ends[:-1] + 1])
    lines = np.array([t.count("\n") + 1 for t in texts], np.int64)
    doc = np.repeat(np.arange(len(texts)), lines)
    n = ends - begins
    k = kinds()[points]
    safe = np.maximum(n, 1)[:, None]

    def per_line(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[ends] - total[begins]

    counts = np.stack([per_line(k == i) for i in range(len(_KINDS))], 1)
    blank = k == 3
    first = np.concatenate([[True], blank[:-1]])
    words = per_line(first & ~blank)
    mark_run = np.zeros(len(k), bool)
    mark_run[1:] = (k[1:] == 6) & (k[:-1] == 6)
    loud = np.zeros(len(k), bool)
    loud[1:] = (points[1:] == 33) & (points[:-1] == 33)
    same = np.zeros(len(k), bool)
    same[1:] = (points[1:] == points[:-1]) & ~blank[1:]
    upper_start = first & (k == 1)
    lone_mark = first & (k == 6) & np.concatenate([blank[1:], [True]])
    # Words that repeat the one before, by sums over their characters.
    at = np.flatnonzero(first & ~blank)
    repeated = np.zeros(len(k), bool)
    if len(at):
        with np.errstate(over="ignore"):
            inside = np.arange(len(points)) - np.maximum.accumulate(np.where(first, np.arange(len(points)), 0))
            each = mixed(points.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + mixed(inside.astype(np.uint64)))
            spelled = np.add.reduceat(np.where(blank, np.uint64(0), each), at)
        repeated[at[1:]] = spelled[1:] == spelled[:-1]
    repeats = per_line(repeated)
    per_word = np.maximum(words, 1)
    letters = np.maximum(counts[:, 0] + counts[:, 1], 1)

    # A line's hash, from sums over its characters, tells which lines repeat in the document.
    with np.errstate(over="ignore"):
        place = np.arange(len(points), dtype=np.uint64) - np.repeat(begins.astype(np.uint64), n + 1)
        h = np.add.reduceat(mixed(points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mixed(place)), begins)
        key = mixed(h + mixed(doc.astype(np.uint64)))
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    again = (times[back] > 1) & (n > 0)

    shares = counts / safe
    base = np.column_stack([
        shares,
        np.log1p(n) / 5, np.log1p(words) / 4, n / per_word / 10,
        counts[:, 1] / letters, per_line(upper_start) / per_word,
        per_line(mark_run) / per_word, per_line(loud) / per_word, per_line(same) / safe[:, 0],
        per_line(lone_mark) / per_word, repeats / per_word, repeats > 0.2 * per_word, again, n == 0, n < 25,
        k[np.maximum(ends - 1, 0)] == 4,
        counts[:, 6] > 0, shares[:, 6] > 0.02, shares[:, 6] > 0.1, counts[:, 1] / letters > 0.3,
        shares[:, 2] > 0.1, shares[:, 4] + shares[:, 5] > 0.08,
    ]).astype(np.float32)
    main = base[:, [1, 2, 6, 9, 11, 12, 13, 14, 15, 17, 19, 20]]
    starts = np.concatenate([[0], np.cumsum(lines)[:-1]])
    before, after = np.zeros_like(main), np.zeros_like(main)
    before[1:] = main[:-1]
    before[starts] = 0
    after[:-1] = main[1:]
    after[starts + lines - 1] = 0
    lone = (lines[doc] == 1).astype(np.float32)
    return np.column_stack([np.ones(len(n), np.float32), base, before, after, lone]), n, lines


class Chain:
    """Weights of a line's being good, and of two neighbours' labels; 1 is good."""

    def __init__(self, width: int):
        self.weights, self.steps, self.first = np.zeros(width), np.zeros((2, 2)), np.zeros(2)
        self.mean, self.scale = np.zeros(width), np.ones(width)
        self.constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def passes(self, logits: np.ndarray, lines: np.ndarray):
        """Forward and backward log sums for every line; documents side by side, longest first.

        Returns the marginals of label 1, the expected counts of label pairs and of first
        labels, and the log partition of each document.
        """
        order = np.argsort(-lines, kind="stable")
        starts = (np.cumsum(lines) - lines)[order]
        n = lines[order]
        emit = np.stack([np.zeros(len(logits)), logits], 1)
        fore, back = np.zeros_like(emit), np.zeros_like(emit)
        fore[starts] = self.first + emit[starts]
        longest = int(n[0]) if len(n) else 0
        alive = np.searchsorted(-n, -np.arange(longest), "left")  # documents with more than t lines
        for t in range(1, longest):
            at = starts[:alive[t]] + t
            prev = fore[at - 1]
            fore[at, 0] = np.logaddexp(prev[:, 0] + self.steps[0, 0], prev[:, 1] + self.steps[1, 0])
            fore[at, 1] = np.logaddexp(prev[:, 0] + self.steps[0, 1], prev[:, 1] + self.steps[1, 1])
            fore[at] += emit[at]
        for t in range(longest - 2, -1, -1):
            at = starts[:alive[t + 1]] + t
            after = back[at + 1] + emit[at + 1]
            back[at, 0] = np.logaddexp(after[:, 0] + self.steps[0, 0], after[:, 1] + self.steps[0, 1])
            back[at, 1] = np.logaddexp(after[:, 0] + self.steps[1, 0], after[:, 1] + self.steps[1, 1])
        last = starts + n - 1
        whole = np.logaddexp(fore[last, 0], fore[last, 1])
        both = fore + back
        good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
        return good, fore, back, emit, whole, order

    def marginals(self, x: np.ndarray, lines: np.ndarray) -> np.ndarray:
        return self.passes(self.logits(x), lines)[0]

    def fit(self, x: np.ndarray, lines: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS) -> Chain:
        """Climb the mean log likelihood by Adam steps."""
        self.mean, self.scale = x.mean(0), x.std(0)
        self.scale[self.scale < 1e-6] = 1
        self.mean[0] = 0
        z = ((x - self.mean) / self.scale).astype(np.float64)
        doc = np.repeat(np.arange(len(lines)), lines)
        y = labels[doc].astype(np.float64)
        share = 1 / np.maximum(lines, 1)  # a document counts once, however many lines it has
        weight = share[doc]
        starts = np.cumsum(lines) - lines
        inner = np.setdiff1d(np.arange(len(x)), starts)  # lines with one before them
        flat = np.zeros(len(self.weights) + 6)
        m, v = np.zeros_like(flat), np.zeros_like(flat)
        for step in range(1, rounds + 1):
            self.weights, self.steps, self.first = flat[:-6], flat[-6:-2].reshape(2, 2), flat[-2:]
            good, fore, back, emit, whole, order = self.passes(z @ self.weights, lines)
            g = np.zeros_like(flat)
            g[:-6] = z.T @ (weight * (y - good))
            total = np.empty(len(lines))
            total[order] = whole
            for a in (0, 1):
                for b in (0, 1):
                    expected = np.exp(np.minimum(0, fore[inner - 1, a] + self.steps[a, b] + emit[inner, b] + back[inner, b] - total[doc[inner]]))
                    seen = (y[inner] == a) & (a == b)
                    g[-6 + 2 * a + b] = (weight[inner] * (seen - expected)).sum()
            g[-1] = (share * (labels - good[starts])).sum()
            g[-2] = -g[-1]
            g = g / len(lines) - PENALTY * flat
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            flat = flat + 0.08 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.weights, self.steps, self.first = flat[:-6], flat[-6:-2].reshape(2, 2), flat[-2:]
        return self

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Quality of each text: its lines' probabilities, weighted by their lengths."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        out, at = [], 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size < STRETCH):
                size += len(texts[to] or "")
                to += 1
            x, n, lines = line_features(texts[at:to])
            good = self.marginals(x, lines)
            starts = np.cumsum(lines) - lines
            w = n + 1.0
            out.append(np.add.reduceat(good * w, starts) / np.add.reduceat(w, starts))
            at = to
        return np.clip(np.concatenate([*out, np.zeros(0)]), 0, 1)


def _sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` labelled documents, by the hash of their ids."""
    clear = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.min("quality").alias("quality"), F.max("quality").alias("_most")).where("quality = _most"))
    chosen = clear.select("doc_id", "quality", F.xxhash64("doc_id").alias("_h")).orderBy("_h", "doc_id").limit(limit)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``limit`` narrow rows


def learn(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS, window: int = TRAIN_LINES) -> Chain:
    """A chain fitted to doc_id, text and doc_id, quality."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for text, quality, h in zip(*(batch.column(i).to_pylist() for i in range(3))):
                x, _, lines = line_features([text])
                room = max(0, int(lines[0]) - window)
                at = h % (room + 1)
                part = np.ascontiguousarray(x[at:at + window])
                yield pa.RecordBatch.from_pydict({"quality": [quality], "h": [h], "lines": [len(part)], "x": [part.tobytes()]})

    parts = _sample(docs, labels, limit).select("text", F.col("quality").cast("long"), "_h").mapInArrow(
        run, "quality long, h long, lines long, x binary")
    rows = sorted(map(tuple, parts.collect()))  # bounded by ``limit`` and ``window``
    width = line_features([""])[0].shape[1]
    chain = Chain(width)
    y = np.array([r[0] for r in rows])
    if len(set(y.tolist())) < 2:
        chain.constant = float(y.mean()) if len(y) else 0.5
        return chain
    x = np.concatenate([np.frombuffer(r[3], np.float32).reshape(-1, width) for r in rows])
    return chain.fit(x, np.array([r[2] for r in rows]), y)


def score(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """The frame with ``score``."""
    docs = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            values = shared.value.scores(batch.column(place).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], [*batch.schema.names, "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def predicted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, learned from the other folds."""
    held_out = fold("doc_id", FOLDS, HELD_OUT)
    chain = learn(docs, labels.select("doc_id", "quality").where(~held_out))
    out = score(docs.select("doc_id", "text", held_out.alias("held_out")), chain)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
