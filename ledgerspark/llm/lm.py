"""Scores of texts by a hashed maximum-entropy language model, beside a unigram base.

Tokens are words of the text lower-cased (A-Z), and one end per document.  Words are known
by 64-bit hashes: among V words two share one with a probability below V^2 / 2^65.

Base.  Counts of all training tokens are one aggregate by hash.  Words that make up at
least ``SHARE`` of the tokens are broadcast (at most 1 / SHARE entries of 16 bytes); the
others' counts are joined, and only tokens that are not among the broadcast ones are
shuffled for it.

Model.  Classes within classes: a tree whose nodes have at most ``WIDTH`` children and whose
leaves are all broadcast words, by frequency (Huffman's code, so frequent words lie near the
root).  The words outside the broadcast part and those never met are dealt by hash to leaves
of some ``LEAF_WORDS`` words each, in which a word has (c + 1) / (all + different + 1) by
counts.  P(word | context) is the product over the nodes on its way of P(child | node,
context): a softmax of a bias (the logarithm of the frequency) plus weights of the context's
features: the word before, the two before (n-grams) and the one before that (skip); below
the root, the word before and the one before that, each with the node.  Features are hashed
into tables of rows that rise with the root of the training tokens (``rows_for``).

Training reads every training document once, in ``ROUNDS`` rounds of disjoint documents.
In a round each task climbs from the shared weights by AdaGrad steps on batches of
tokens; its change to each row is averaged with other tasks' by the number of tokens that
touched the row, in two levels of sums, and the next round begins from the result.  The
weights, 5 x rows x WIDTH numbers, and the tree are broadcast.

Defined cases: a null text is an empty one: one end token; without training documents all
counts are 0 and both scores are 0; rows are scored one by one, repeated rows alike; a long
text is read whole; extra columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import fold, in_groups, keep, mixed, released
from ledgerspark.llm.ngram_join import word_hashes

SHARE = 2.5e-7
WIDTH = 32  # children of a node
LEAF_WORDS = 16  # of words outside the broadcast part
ROWS, ROWS_TOKENS = 1 << 13, 4_000_000  # rows a table for so many training tokens, and at least
ROUNDS = 3
BATCH = 16_384
RATE = 0.08
SLICE = 2048  # tokens whose sums are taken at a time
LARGE, SMALL = 60.0, 1e-25  # of a sum, and of a sum of exponentials, in 32 bits
LONG_RUN = 48  # rows that are added by themselves
GROUP_CHARACTERS = 1 << 20
CHUNK_ROWS = 1024
SUMMED_TASKS = 64
TASK_TOKENS = 3_000_000
FOLDS, HELD_OUT = 7, 2

END = int(mixed(np.array([0x656E64], np.uint64))[0])
START = int(mixed(np.array([0x737461], np.uint64))[0])
_TABLES = 5
_turn = mixed(np.arange(2000, 2008, dtype=np.uint64)) | np.uint64(1)


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, ends included, and how many each text has."""
    h, words = word_hashes([t.encode().lower() for t in texts])
    return np.insert(h, np.cumsum(words), np.uint64(END)), words + 1


def groups(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for texts in in_groups([t or "" for t in column.to_pylist()], GROUP_CHARACTERS):
        yield tokens(texts)


def counted(docs: DataFrame) -> DataFrame:
    """h, c: how often each token occurs; summed per batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            parts = [np.unique(h, return_counts=True) for h, _ in groups(batch.column(0))]
            if parts:
                h, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                c = np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])

    return docs.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def rows_for(tokens: int) -> int:
    """Rows of a feature table: a power of two that rises with the root of the training tokens."""
    return ROWS << max(0, round(np.log2(max(1, tokens) / ROWS_TOKENS) / 2))


class Vocabulary:
    """Counts of the frequent words, and the tree of all words.

    ``rare``: per leaf of other words the sum of their c + 1; one leaf for all, if not given.
    """

    def __init__(self, h: np.ndarray, c: np.ndarray, total: int, different: int, rare: np.ndarray | None = None):
        order = np.argsort(h)
        self.h, self.c, self.total, self.different = h[order], c[order], total, different
        if rare is None:
            rare = np.array([total - int(c.sum()) + different - len(h)])
        self.others = rare + 1.0  # and one word that was never met
        self._plant(np.concatenate([self.c + 1.0, self.others]))

    def _plant(self, mass: np.ndarray) -> None:
        """Parent, and place under it, of each leaf and node (a node's number follows the leaves'); biases by node."""
        leaves = len(mass)
        nodes = max(1, -(-(leaves - 1) // (WIDTH - 1)))
        order = np.argsort(mass, kind="stable")
        left, made = mass[order].tolist(), []
        self.leaves, self.root = leaves, nodes - 1
        self.parent, self.slot = np.full(leaves + nodes, -1, np.int32), np.zeros(leaves + nodes, np.int8)
        self.bias = np.full((nodes, WIDTH), -1e4, np.float32)
        i = j = 0
        for node in range(nodes):  # the smallest of what is left, leaves and nodes each in rising order
            a, b = i, j
            for _ in range(WIDTH if node else leaves - (nodes - 1) * (WIDTH - 1)):
                if j == len(made) or i < leaves and left[i] <= made[j]:
                    i += 1
                else:
                    j += 1
            children = np.concatenate([order[a:i], np.arange(leaves + b, leaves + j)])
            sizes = np.array(left[a:i] + made[b:j])
            self.parent[children], self.slot[children] = node, np.arange(len(children))
            self.bias[node, :len(children)] = np.log(sizes / sizes.sum())
            made.append(float(sizes.sum()))

    def way(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each token's child of the root; and for all nodes below on its way: token, node, child."""
        at, token = np.where(place >= 0, place, len(self.h) - 1 - place), np.arange(len(place))
        top, parts = np.zeros(len(place), np.int64), []
        while len(at):
            node, spot = self.parent[at].astype(np.int64), self.slot[at].astype(np.int64)
            done = node == self.root
            top[token[done]] = spot[done]
            token, node, spot = token[~done], node[~done], spot[~done]
            parts.append((token, node, spot))
            at = node + self.leaves
        return top, *(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (list(zip(*parts)) or [(), (), ()]))

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count (0: not a frequent word) and the place (-1 - leaf: another word) of each token."""
        leaf = -1 - h.view(np.int64) % len(self.others)
        if not len(self.h):
            return np.zeros(len(h), np.int64), leaf
        at = self._at_or_after(h)
        known = self.guarded[at] == h
        known &= at < len(self.h)
        return np.where(known, self.c.take(at, mode="clip"), 0), np.where(known, at, leaf)

    def _at_or_after(self, h: np.ndarray) -> np.ndarray:
        """The place of the first frequent word whose hash is not smaller: that of the leading bits, and a few on."""
        if not hasattr(self, "begins"):  # made where it is used
            bits = len(self.h).bit_length()
            self.shift = np.uint64(64 - bits)
            self.begins = np.searchsorted(self.h, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)
            self.guarded = np.append(self.h, ~np.uint64(0))
        at = self.begins[(h >> self.shift).astype(np.int64)].astype(np.int64)
        behind = np.flatnonzero(self.guarded[at] < h)
        for _ in range(16):
            if not len(behind):
                return at
            at[behind] += 1
            behind = behind[self.guarded[at[behind]] < h[behind]]
        at[behind] = np.searchsorted(self.h, h[behind])
        return at


def features(h: np.ndarray, sizes: np.ndarray, rows: int = ROWS) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Rows of the root's features of each token, and the two words before it."""
    start = np.cumsum(sizes) - sizes
    one, two = np.empty_like(h), np.empty_like(h)
    one[1:], two[2:] = h[:-1], h[:-2]
    one[start] = two[start] = START
    two[start[sizes > 1] + 1] = START
    with np.errstate(over="ignore"):
        return [_row(one * _turn[0], 0, rows), _row(one * _turn[1] + mixed(two * _turn[2]), 1, rows),
                _row(two * _turn[3], 2, rows)], one, two


def member_features(one: np.ndarray, two: np.ndarray, node: np.ndarray, rows: int = ROWS) -> list[np.ndarray]:
    """Rows of the features of a child of a node."""
    g = (node.astype(np.uint64) + np.uint64(1))
    with np.errstate(over="ignore"):
        return [_row(one * _turn[4] + mixed(g), 3, rows), _row(two * _turn[5] + mixed(g * _turn[6]), 4, rows)]


def _row(x: np.ndarray, table: int, rows: int) -> np.ndarray:
    return (mixed(x) & np.uint64(rows - 1)).astype(np.int64) + table * rows


def _exponentials(weights: np.ndarray, bias: np.ndarray, node: np.ndarray, rows: list[np.ndarray]) -> Iterator[tuple]:
    """A slice of the tokens at a time, which fits a core's cache: it, its sums, their exponentials, the sums of these.

    Sums are taken less the largest of their token only where an exponential could leave the range of numbers.
    """
    ones, held = np.ones(WIDTH, np.float32), np.empty((SLICE, WIDTH), np.float32)
    for at in range(0, len(node), SLICE):
        part = slice(at, at + SLICE)
        z = bias.take(node[part], 0)
        e = held[:len(z)]
        for r in rows:
            z += weights.take(r[part], 0, out=e, mode="clip")
        safe = z.max() < LARGE
        total = np.exp(z, out=e) @ ones if safe else None
        if not safe or total.min() < SMALL:
            z -= z.max(1, keepdims=True)
            total = np.exp(z, out=e) @ ones
        yield part, z, e, total


def softmax(weights: np.ndarray, bias: np.ndarray, node: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """The probabilities of all children of each token's node."""
    p = np.empty((len(node), WIDTH), np.float32)
    for part, _, e, total in _exponentials(weights, bias, node, rows):
        np.divide(e, total[:, None], out=p[part])
    return p


def log_softmax(weights: np.ndarray, bias: np.ndarray, node: np.ndarray, rows: list[np.ndarray], child: np.ndarray) -> np.ndarray:
    """The log10 of the probability of one child of each token's node."""
    out = np.empty(len(child))
    for part, z, _, total in _exponentials(weights, bias, node, rows):
        out[part] = z[np.arange(len(z)), child[part]] - np.log(total)
    return out / np.log(10)


def log_probabilities(weights: np.ndarray, words: Vocabulary, h: np.ndarray, sizes: np.ndarray,
                      place: np.ndarray) -> np.ndarray:
    """Per token the model's log10 probability; of another word, that of its leaf alone."""
    size = len(weights) // _TABLES
    rows, one, two = features(h, sizes, size)
    out = np.empty(len(h))
    for at in range(0, len(h), BATCH):
        b = slice(at, at + BATCH)
        top, token, node, child = words.way(place[b])
        out[b] = log_softmax(weights, words.bias, np.full(len(top), words.root), [r[b] for r in rows], top)
        below = log_softmax(weights, words.bias, node, member_features(one[b][token], two[b][token], node, size), child)
        out[b] += np.bincount(token, below, len(top))
    return out


def run_sums(p: np.ndarray, order: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of the rows ``order[first]`` to ``order[first + n - 1]`` of ``p`` for each run; the longest runs come first."""
    g = p.take(order[first], 0)
    long = int(np.searchsorted(-n, -LONG_RUN))
    for i, (a, k) in enumerate(zip(first[:long].tolist(), n[:long].tolist())):
        g[i] = p.take(order[a:a + k], 0).sum(0)
    for k in range(1, int(n[long]) if long < len(n) else 0):
        more = int(np.searchsorted(-n, -k))  # runs of more than k rows
        g[long:more] += p.take(order[first[long:more] + k], 0)
    return g


class Climber:
    """Weights of one task, changed by AdaGrad steps."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights.copy()
        self.squares = np.full_like(weights, 1.0)
        self.touched = np.zeros(len(weights), np.int64)
        self.rows = len(weights) // _TABLES

    def step(self, words: Vocabulary, rows: list[np.ndarray], one: np.ndarray, two: np.ndarray, place: np.ndarray) -> None:
        top, token, node, child = words.way(place)
        self._move(rows, softmax(self.weights, words.bias, np.full(len(top), words.root), rows), top)
        if len(node):
            rows = member_features(one[token], two[token], node, self.rows)
            self._move(rows, softmax(self.weights, words.bias, node, rows), child)

    def _move(self, rows: list[np.ndarray], p: np.ndarray, truth: np.ndarray) -> None:
        p[np.arange(len(truth)), truth] -= 1
        for r in rows:
            base = int(r[0]) // self.rows * self.rows
            order = np.argsort((r - base).astype(np.uint16 if self.rows <= 1 << 16 else np.uint32), kind="stable")
            s = r[order]
            first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            n = np.diff(np.append(first, len(s)))
            falling = np.argsort(-n, kind="stable")
            first, n = first[falling], n[falling]
            at = s[first]
            g = run_sums(p, order, first, n)
            squares = self.squares.take(at, 0)
            squares += g * g
            self.squares[at] = squares
            g *= RATE
            g /= np.sqrt(squares, out=squares)
            moved = self.weights.take(at, 0)
            moved -= g
            self.weights[at] = moved
            self.touched[at] += n

    def learn(self, words: Vocabulary, h: np.ndarray, sizes: np.ndarray) -> None:
        _, place = words.look_up(h)
        rows, one, two = features(h, sizes, self.rows)
        for at in range(0, len(h), BATCH):
            b = slice(at, at + BATCH)
            self.step(words, [r[b] for r in rows], one[b], two[b], place[b])


def _summed(parts: DataFrame, *keys: str) -> DataFrame:
    """Blobs of equal length added up per key."""

    def run(t: pa.Table) -> pa.Table:
        change = sum(np.frombuffer(b, np.float32) for b in t.column("change").to_pylist())
        n = sum(np.frombuffer(b, np.int64) for b in t.column("n").to_pylist())
        first = t.slice(0, 1).select(["chunk", "part"])
        return pa.table({"chunk": first.column(0), "part": first.column(1), "change": pa.array([change.tobytes()], pa.binary()),
                         "n": pa.array([n.tobytes()], pa.binary())})

    return parts.groupBy(*keys).applyInArrow(run, "chunk int, part int, change binary, n binary")


def one_round(docs: DataFrame, words: Vocabulary, weights: np.ndarray, rounds: int = 1) -> np.ndarray:
    """The weights after every document of the frame, a part in ``rounds``, has been read once."""
    shared = docs.sparkSession.sparkContext.broadcast((words, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, begin = shared.value
        own = Climber(begin)
        part = 0
        for batch in released(batches):
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            for h, sizes in groups(batch.column("text")):
                own.learn(vocabulary, h, sizes)
        if not own.touched.any():
            return
        for chunk, at in enumerate(range(0, len(begin), CHUNK_ROWS)):
            n = own.touched[at:at + CHUNK_ROWS]
            if not n.any():
                continue
            change = (own.weights[at:at + CHUNK_ROWS] - begin[at:at + CHUNK_ROWS]) * n[:, None].astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int32()), pa.array([part], pa.int32()), pa.array([change.tobytes()], pa.binary()),
                 pa.array([n.tobytes()], pa.binary())], ["chunk", "part", "change", "n"])

    # A task hands on weights, so it should read much more than these take.
    tasks = max(1, round(words.total / rounds / TASK_TOKENS / (len(weights) / _TABLES / ROWS) ** 0.5))
    parts = docs.coalesce(tasks).select("text", (F.spark_partition_id() / SUMMED_TASKS).cast("int").alias("part")).mapInArrow(
        run, "chunk int, part int, change binary, n binary")
    sums = _summed(_summed(parts, "chunk", "part"), "chunk")
    weights = weights.copy()
    for r in sums.collect():  # the weights' size
        n = np.maximum(np.frombuffer(r.n, np.int64), 1)[:, None]
        at = r.chunk * CHUNK_ROWS
        weights[at:at + CHUNK_ROWS] += np.frombuffer(r.change, np.float32).reshape(len(n), -1) / n.astype(np.float32)
    return weights


def learn(docs: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """The weights after all documents of the frame have been read once."""
    weights = np.zeros((_TABLES * rows_for(words.total), WIDTH), np.float32)
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds))
    for k in range(rounds if words.total else 0):
        weights = one_round(docs.where(turn == k), words, weights, rounds)
    return weights


def vocabulary(counts: DataFrame, share: float = SHARE) -> tuple[Vocabulary, DataFrame]:
    """The frequent words, and the counts of all others."""
    total, different = counts.agg(F.sum("c"), F.count("*")).first()
    total = total or 0
    frequent = counts.where(F.col("c") >= share * total).toArrow()  # at most 1 / share rows
    h = frequent.column("h").to_numpy().astype(np.int64).view(np.uint64)
    rare = counts.where(F.col("c") < share * total)
    leaves = max(1, (different - len(h)) // LEAF_WORDS)
    dealt = rare.groupBy(F.pmod("h", F.lit(leaves)).alias("leaf")).agg(F.sum(F.col("c") + 1).alias("mass")).toArrow()  # leaves rows
    mass = np.zeros(leaves)
    mass[dealt.column("leaf").to_numpy()] = dealt.column("mass").to_numpy()
    return Vocabulary(h, frequent.column("c").to_numpy().astype(np.int64), total, different, mass), rare


def scored(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    docs = docs.select("doc_id", "text", fold("doc_id", FOLDS, HELD_OUT).alias("held_out"))
    train = docs.where(~F.col("held_out"))
    counts = keep(counted(train), "counts")
    words, rare = vocabulary(counts, share)
    weights = learn(train, words)
    shared = docs.sparkSession.sparkContext.broadcast((words, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, w = shared.value
        for batch in released(batches):
            out: list[list] = [[], [], [], [], []]
            for h, sizes in groups(batch.column("text")):
                c, place = vocabulary.look_up(h)
                start = np.cumsum(sizes) - sizes
                seen = np.log10(c + 1.0)
                model = log_probabilities(w, vocabulary, h, sizes, place)
                model += np.where(place >= 0, 0, seen - np.log10(vocabulary.others)[np.maximum(-1 - place, 0)])
                unmet = c == 0
                out[0] += sizes.tolist()
                out[1] += (sizes - np.add.reduceat(unmet.astype(np.int64), start)).tolist()
                out[2] += np.add.reduceat(seen, start).tolist()
                out[3] += np.add.reduceat(model, start).tolist()
                cuts = np.cumsum(np.add.reduceat(unmet.astype(np.int64), start))[:-1]
                out[4] += [x.view(np.int64) for x in np.split(h[unmet], cuts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("held_out"), *(
                    pa.array(o, t) for o, t in zip(out, (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()))))],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "seen", "model", "unmet"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = keep(docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, seen double, model double, unmet array<long>"), "rows")
    # Words outside the broadcast part: each token looks up its count by a join.
    met = rows.select("row", F.explode("unmet").alias("h")).join(rare, "h").groupBy("row").agg(
        F.sum(F.log10(F.col("c") + 1.0)).alias("more"), F.count("*").alias("met"))
    full = rows.drop("unmet").join(met, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    size = F.lit(float(np.log10(words.total + words.different + 1.0)))
    return full.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("seen") + more - F.col("n_tokens") * size).alias("base_score"), (F.col("model") + more).alias("score"))
