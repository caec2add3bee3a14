"""The prefix trie of conversations, its subtree totals by time-forward processing.

A node is a distinct sequence of first turns.  Its members are the conversations that begin
with it, and it is named by its depth and its smallest member, which tells all nodes apart.

Prefixes.  Every turn becomes an MD5 of role and text, every place in a conversation an MD5
of depth and turn, and a prefix the sum of its places in four 32-bit words (128 bits).  Sums
run inside key ranges of (conversation, turn) and are carried over between them, so a
conversation with a third of all turns is spread over many tasks.  Members are counted per
task before the shuffle.

Totals.  A node with one member has one leaf below it and saves nothing, so only
shared nodes are processed.  The crown is the root and the nodes with more than ``1 / CROWN``
of all (conversation, depth) pairs as members (or more than ``LEAST``); there are at most
``CROWN`` of these, whatever the data.  Every shared node below has one topmost ancestor
outside the crown, its shard root.  A task gets whole shards, sorted by Spark in reverse level
order.  It goes through them once: a node takes the messages sent to it from a priority
queue, adds its own values, and sends the totals to its parent through the queue.  The
queue keeps ``QUEUE_ROWS`` messages in memory and spills sorted runs to a temporary file of the
task.  Then the shard roots' totals are summed per parent and the crown is processed in the
same way.  A lost task is simply run again.

Ends.  The ids of a node's ending conversations are joined in stretches of ``STRETCH``
consecutive ids (at most so many per group) and the stretches are hashed one after the
other, as a stream.

Parents with more than a ten-thousandth of all nodes as children are joined by broadcast (at
most 10,000 rows), other parents by a shuffle.

Defined cases: a null role or text is an empty one; a null turn comes first, equal turns go by
the MD5 of role and text, so repeated rows count each and give the same trie in any order; a row
without conv_id belongs to no conversation; a conversation may end up without turns and is
then a member of the root only; a long text is hashed whole; extra columns are not read; an
empty table has no node, not even a root.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerspark.llm.common import keep, released
from ledgerspark.operators.ordered import RANGE, with_range

CROWN = 20_000
LEAST = 256
STRETCH = 8_192
QUEUE_ROWS = 1_000_000
HOT_PARENTS = 10_000
GROUP = 100  # conversations that share the beginning of one
HEADS = 6
_RUNS = 16  # spilled runs that are merged into one
_READ = 1 << 15  # rows of a run read at a time
_WORDS = ["p0", "p1", "p2", "p3"]
_NODE = ["depth", *_WORDS]


def _words(hex32: Column) -> list[Column]:
    return [F.conv(F.substring(hex32, 8 * i + 1, 8), 16, 10).cast("long").alias(f"e{i}") for i in range(4)]


def _element(depth: Column, turn: Column) -> Column:
    return F.md5(F.concat(depth.cast("string"), F.lit(":"), turn).cast("binary"))


# --------------------------------------------------------------------------
# Conversations as rows of (conversation, depth)

def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, _range, pos (from 0), t, size of every turn; stored."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    narrow = keep(conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn.alias("t"),
        F.length(text).cast("long").alias("size")), "turns")
    ranged = keep(with_range(narrow, ["conv_id", "turn", "t"]), "turns")
    parts = ranged.groupBy(RANGE, "conv_id").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("conv_id").orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    # A range has at most one conversation that began in an earlier one.
    carried = keep(parts.select(RANGE, "conv_id", F.sum("_n").over(before).alias("_before")).where(
        F.col("_before").isNotNull()), "carried")
    place = F.row_number().over(W.partitionBy(RANGE, "conv_id").orderBy(F.col("turn").asc_nulls_first(), "t"))
    placed = ranged.withColumn("_place", place).join(F.broadcast(carried), [RANGE, "conv_id"], "left")
    return keep(placed.select("conv_id", RANGE, (F.coalesce("_before", F.lit(0)) + F.col("_place") - 1).alias("pos"),
                              "t", "size"), "turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations' turns (conv_id, part, depth, t, size), and all conv_id with their depth.

    ``part`` keeps the turns of a conversation in groups that follow each other; each group is
    within one range.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    is_base = F.col("conv_id") % GROUP == 0
    heads = turns.where(is_base & (F.col("pos") < HEADS - 1)).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "t", "size"))).alias("head"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)).cast("int")
    # At most twice GROUP conversations have the same base.
    members = sizes.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP).join(
        heads.withColumnRenamed("conv_id", "base"), "base", "left")
    first = F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), 1, F.col("h"))
    members = members.withColumn("h", h).withColumn("first", first)
    members = keep(members.select("conv_id", "h", "first", F.size("first").alias("m"),
                                  (F.size("first") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("last")),
                   "members")
    head = members.select("conv_id", F.lit(-1).alias("part"), F.posexplode("first").alias("i", "f")).select(
        "conv_id", "part", (F.col("i") + 1).cast("long").alias("depth"), "f.t", "f.size")
    # Few conversations have a base that is too short; their shift is joined per range.
    shifts = turns.select(RANGE, "conv_id").distinct().join(
        members.where("m < h").select("conv_id", (F.col("h") - F.col("m")).alias("shift")), "conv_id")
    own = turns.where(F.col("pos") >= h).join(shifts, [RANGE, "conv_id"], "left").select(
        "conv_id", F.col(RANGE).alias("part"),
        (F.col("pos") + 1 - F.coalesce("shift", F.lit(0))).alias("depth"), "t", "size")
    return head.unionByName(own), members.select("conv_id", F.col("last").cast("long").alias("last"))


def paths(rows: DataFrame) -> DataFrame:
    """conv_id, depth, size, the prefix (p0 to p3) and the last place (e0 to e3); stored."""
    e = [f"e{i}" for i in range(4)]
    rows = rows.withColumn("_e", _element(F.col("depth"), F.col("t"))).select(
        "conv_id", "part", "depth", "size", *_words(F.col("_e")))
    along = W.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(W.unboundedPreceding, W.currentRow)
    local = rows.select("*", *[F.sum(c).over(along).alias(p) for c, p in zip(e, _WORDS)])
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = rows.groupBy("conv_id", "part").agg(*[F.sum(c).alias(c) for c in e])
    carried = parts.select("conv_id", "part", *[F.sum(c).over(before).alias(f"b{i}") for i, c in enumerate(e)]).where(
        F.col("b0").isNotNull())
    joined = local.join(carried, ["conv_id", "part"], "left")
    return keep(joined.select("conv_id", "depth", "size", *e, *[
        (F.col(p) + F.coalesce(F.col(f"b{i}"), F.lit(0))).alias(p) for i, p in enumerate(_WORDS)]), "paths")


# --------------------------------------------------------------------------
# Time-forward processing

class SpillingQueue:
    """Messages (level, node, leaves, saved) in order of level downwards, then node.

    Up to ``most`` messages stay in memory; beyond, they are sorted and written to a temporary
    file that goes with the queue.
    """

    KIND = np.dtype([("level", "<i8"), ("node", "<i8"), ("leaves", "<i8"), ("saved", "<i8")])

    def __init__(self, most: int = QUEUE_ROWS):
        self.most, self.spilled = most, 0
        self.new: list[np.ndarray] = []
        self.n = 0
        self.runs: list[_Run] = []

    def push(self, messages: np.ndarray) -> None:
        if len(messages):
            self.new.append(messages)
            self.n += len(messages)
            if self.n > self.most:
                self._spill()

    def _sorted(self) -> np.ndarray:
        rows = np.concatenate(self.new) if self.new else np.zeros(0, self.KIND)
        self.new, self.n = [], 0
        return _added(rows)

    def _spill(self) -> None:
        rows = self._sorted()
        self.spilled += len(rows)
        if len(rows) <= self.most // 2:  # messages to the same node were added up
            self.new, self.n = [rows], len(rows)
            return
        self.runs.append(_Run([rows]))
        if len(self.runs) > _RUNS:
            self.runs = [_Run(_merged(self.runs))]

    def pop(self, level: int, last: int) -> np.ndarray:
        """All messages up to the node ``last`` of a level, added up per node."""
        rows = self._sorted()
        n = _upto(rows, level, last)
        if n < len(rows):
            self.new, self.n = [rows[n:]], len(rows) - n
        parts = [rows[:n], *(r.pop(level, last) for r in self.runs)]
        self.runs = [r for r in self.runs if r.left]
        return _added(np.concatenate(parts))


def _upto(rows: np.ndarray, level: int, last: int) -> int:
    """How many of the sorted rows come before or at a node."""
    begin = int(np.searchsorted(-rows["level"], -level, "left"))
    end = int(np.searchsorted(-rows["level"], -level, "right"))
    return begin + int(np.searchsorted(rows["node"][begin:end], last, "right"))


def _added(rows: np.ndarray) -> np.ndarray:
    """Sorted, one row per node."""
    if len(rows) < 2:
        return rows
    rows = rows[np.lexsort((rows["node"], -rows["level"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["level"][1:] != rows["level"][:-1]) | (rows["node"][1:] != rows["node"][:-1])
    at = np.flatnonzero(new)
    out = rows[at]
    for c in ("leaves", "saved"):
        out[c] = np.add.reduceat(rows[c], at)
    return out


class _Run:
    """Sorted messages in a temporary file, read from the front."""

    def __init__(self, parts):
        self.file = tempfile.TemporaryFile()
        self.left = 0  # not yet popped
        for p in parts:
            self.file.write(p.tobytes())
            self.left += len(p)
        self.at, self.held = 0, np.zeros(0, SpillingQueue.KIND)

    def _fill(self) -> None:
        if not len(self.held) and self.left:
            size = SpillingQueue.KIND.itemsize
            self.file.seek(self.at * size)
            self.held = np.frombuffer(self.file.read(_READ * size), SpillingQueue.KIND)
            self.at += len(self.held)

    def head(self) -> tuple[int, int]:
        self._fill()
        return -int(self.held["level"][0]), int(self.held["node"][0])

    def take(self) -> np.ndarray:
        """The next rows that are in memory."""
        self._fill()
        rows, self.held = self.held, self.held[:0]
        self.left -= len(rows)
        return rows

    def pop(self, level: int, last: int) -> np.ndarray:
        out = [self.held[:0]]
        while self.left:
            self._fill()
            n = _upto(self.held, level, last)
            out.append(self.held[:n])
            self.held = self.held[n:]
            self.left -= n
            if len(self.held):
                break
        return np.concatenate(out)


def _merged(runs: list[_Run]) -> Iterator[np.ndarray]:
    """The rows of several runs in order, some at a time."""
    heads = [(r.head(), i) for i, r in enumerate(runs) if r.left]
    heapq.heapify(heads)
    while heads:
        _, i = heapq.heappop(heads)
        rows = runs[i].take()
        level, last = int(rows["level"][-1]), int(rows["node"][-1])
        others = [runs[j].pop(level, last) for _, j in heads]
        yield _added(np.concatenate([rows, *others]))
        heads = [(runs[j].head(), j) for j in {i, *(j for _, j in heads)} if runs[j].left]
        heapq.heapify(heads)


def forward(batches: Iterator[pa.RecordBatch], most: int = QUEUE_ROWS) -> Iterator[pa.RecordBatch]:
    """depth, conv_id, parent, leaves, saved with subtree totals.

    The rows come in reverse level order, and hold each node's own values; a parent
    outside the rows receives nothing here.
    """
    queue = SpillingQueue(most)
    for batch in released(batches):
        depth, conv, parent, leaves, saved = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        leaves, saved = leaves.astype(np.int64), saved.astype(np.int64)
        cuts = np.flatnonzero(np.diff(depth)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(depth)]):
            if a == b:
                continue
            sent = queue.pop(int(depth[a]), int(conv[b - 1]))
            # What was sent to nodes that are not among the rows finds no place.
            at = np.searchsorted(conv[a:b], sent["node"])
            mine = (sent["level"] == depth[a]) & (at < b - a)
            mine[mine] = conv[a:b][at[mine]] == sent["node"][mine]
            leaves[a:b][at[mine]] += sent["leaves"][mine]
            saved[a:b][at[mine]] += sent["saved"][mine]
            up = np.zeros(b - a, SpillingQueue.KIND)
            up["level"], up["node"], up["leaves"], up["saved"] = depth[a:b] - 1, parent[a:b], leaves[a:b], saved[a:b]
            queue.push(up)
        yield pa.RecordBatch.from_arrays(
            [pa.array(depth), pa.array(conv), pa.array(parent), pa.array(leaves), pa.array(saved)],
            ["depth", "conv_id", "parent", "leaves", "saved"])


_TOTALS = "depth long, conv_id long, parent long, leaves long, saved long"


def _forwarded(nodes: DataFrame, most: int) -> DataFrame:
    """Totals of nodes whose partitions hold whole trees (a missing parent: -1)."""
    rows = nodes.select("depth", "conv_id", "parent", "leaves", "saved").sortWithinPartitions(
        F.col("depth").desc(), "conv_id")
    return rows.mapInArrow(lambda b: forward(b, most), _TOTALS)


# --------------------------------------------------------------------------

def _digests(ends: DataFrame) -> DataFrame:
    """The prefix, and the hash of the joined ids of the conversations that end there."""
    part = F.floor(F.col("conv_id") / STRETCH)
    texts = ends.groupBy(*_NODE, F.floor(part).cast("long").alias("part")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        done: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*done))
            done.clear()
            return pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.string())],
                [*_NODE, "ends_sha256"])

        for batch in released(batches):
            columns = [batch.column(c).to_pylist() for c in (*_NODE, "ids")]
            for *own, ids in zip(*columns):
                if own != key:
                    if state is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if len(done) > 20_000:
                yield out()
        if state is not None:
            done.append((*key, state.hexdigest()))
        if done:
            yield out()

    dealt = texts.repartition(*_NODE).sortWithinPartitions(*_NODE, "part")
    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in _NODE) + ", ends_sha256 string")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """parent (its smallest member), n_children and how many of the children have one member."""
    own = F.col("depth") > 0
    above = [(F.col("depth") - 1).alias("depth"), *[(F.col(p) - F.col(f"e{i}")).alias(p) for i, p in enumerate(_WORDS)]]
    children = nodes.where(own).select(*above, "n_convs").groupBy(*_NODE).agg(
        F.count(F.lit(1)).alias("n_children"), F.sum((F.col("n_convs") == 1).cast("long")).alias("n_single"))
    none = F.lit(0).cast("long")
    joined = keep(nodes.join(children, _NODE, "left").withColumns({
        "n_children": F.coalesce("n_children", none), "n_single": F.coalesce("n_single", none)}), "nodes")
    # More than so many children: at most HOT_PARENTS nodes can have them.
    limit = max(LEAST, joined.count() // HOT_PARENTS)
    up = {c: f"_{c}" for c in _NODE}
    named = joined.where("n_children > 0").select(*_NODE, F.col("conv_id").alias("parent"), "n_children")
    parents = named.withColumnsRenamed(up | {"n_children": "_children"})
    same = F.col("_depth") == F.col("depth") - 1
    for i, p in enumerate(_WORDS):
        same = same & (F.col(f"_{p}") == F.col(p) - F.col(f"e{i}"))
    many = F.broadcast(parents.where(F.col("_children") > limit))
    few = parents.where(F.col("_children") <= limit)
    child = joined.where(own)
    linked = child.join(many, same).unionByName(child.join(many, same, "left_anti").join(few, same))
    root = joined.where(~own).withColumn("parent", F.lit(None).cast("long"))
    return keep(root.unionByName(linked.drop(*up.values(), "_children")), "nodes")


def _totals(nodes: DataFrame, path: DataFrame, pairs: int, crown: int, least: int, most: int) -> DataFrame:
    """depth, conv_id, leaves, saved of every node with more than one member, and of the root."""
    own = {"leaves": (F.col("n_children") == 0).cast("long") + F.col("n_single"),
           "saved": (F.col("n_convs") - 1) * F.col("size")}
    limit = max(least, pairs // crown)
    top = (F.col("depth") == 0) | (F.col("n_convs") > limit)
    shared = nodes.where((F.col("n_convs") > 1) | (F.col("depth") == 0)).withColumns(own)
    crowned = keep(shared.where(top), "crown")
    low = shared.where(~top)
    # The row of each conversation in its shard root: the first one outside the crown.
    heads = F.broadcast(crowned.select(*_NODE))
    above = [(F.col(p) - F.col(f"e{i}")).alias(p) for i, p in enumerate(_WORDS)]
    under = path.withColumns({"_depth": F.col("depth"), **{f"_{p}": F.col(p) for p in _WORDS}})
    under = under.join(heads, _NODE, "left_anti").select(
        "conv_id", "_depth", *[f"_{p}" for p in _WORDS], (F.col("depth") - 1).alias("depth"), *above)
    shards = under.join(heads, _NODE, "left_semi").select(
        "conv_id", F.xxhash64("_depth", *[f"_{p}" for p in _WORDS]).alias("shard"))
    dealt = low.join(shards, "conv_id").select("shard", "depth", "conv_id", "parent", "leaves", "saved")
    done = keep(_forwarded(dealt.repartition("shard"), most), "shards")
    arrived = done.join(F.broadcast(crowned.select((F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent"))),
                        ["depth", "parent"]).groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("conv_id")).agg(
        F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
    ready = crowned.join(arrived, ["depth", "conv_id"], "left").select(
        "depth", "conv_id", F.coalesce("parent", F.lit(-1)).alias("parent"),
        (F.col("leaves") + F.coalesce("_leaves", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("_saved", F.lit(0))).alias("saved"))
    crown_done = keep(_forwarded(ready.coalesce(1), most), "crown")  # at most CROWN rows
    return done.unionByName(crown_done).drop("parent")


def nodes(conversations: DataFrame, crown: int = CROWN, least: int = LEAST, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    rows, convs = rebuilt(ordered_turns(conversations))
    path = paths(rows)
    convs = keep(convs, "conversations")
    zeros = [F.lit(0).cast("long").alias(p) for p in (*_WORDS, "e0", "e1", "e2", "e3")]
    start = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("size"), *zeros)
    e = [f"e{i}" for i in range(4)]
    every = path.unionByName(start)
    trie = every.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"),
                                     F.max("size").alias("size"), *[F.max(c).alias(c) for c in e])
    trie = _with_parents(trie)
    totals = _totals(trie, path, path.count() + convs.count(), crown, least, queue_rows)
    turnless = convs.where("last = 0").select("conv_id", *[F.lit(0).cast("long").alias(c) for c in _NODE])
    last = path.join(convs.withColumnRenamed("last", "depth"), ["conv_id", "depth"]).select("conv_id", *_NODE)
    ends = _digests(last.unionByName(turnless))
    out = trie.join(totals, ["depth", "conv_id"], "left").join(ends, _NODE, "left")
    return out.select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


ORACLE_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
           list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
           lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
m AS (SELECT h.conv_id, base, h, least(h, count(t.pos)) AS m FROM h LEFT JOIN t ON t.conv_id = base
      GROUP BY h.conv_id, base, h),
r AS (
  SELECT m.conv_id, pos + 1 AS depth, role, text FROM m JOIN t ON t.conv_id = base WHERE pos < h
  UNION ALL
  SELECT m.conv_id, pos + 1 - h + m, role, text FROM m JOIN t USING (conv_id) WHERE pos >= h),
p AS (
  SELECT conv_id, 0 AS depth, '' AS prefix, 0 AS size FROM m
  UNION ALL
  SELECT conv_id, depth, string_agg(length(role) || ':' || length(text) || ':' || role || text, '')
           OVER (PARTITION BY conv_id ORDER BY depth), length(text) FROM r),
k AS (SELECT conv_id, max(depth) AS last FROM p GROUP BY conv_id),
n AS (
  SELECT depth, prefix, min(p.conv_id) AS node, count(*) AS n_convs, max(size) AS size,
         sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (WHERE depth = last), '')) AS ends
  FROM p JOIN k USING (conv_id) GROUP BY depth, prefix),
a AS (
  SELECT p.conv_id, p.depth, n.node FROM p JOIN n ON p.depth = n.depth AND p.prefix = n.prefix),
u AS (SELECT n.*, a.node AS parent FROM n LEFT JOIN a ON a.conv_id = n.node AND a.depth = n.depth - 1),
c AS (SELECT u.*, (SELECT count(*) FROM u v WHERE v.depth = u.depth + 1 AND v.parent = u.node) AS n_children FROM u),
s AS (
  SELECT a.depth, a.node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * size) AS saved
  FROM c JOIN a ON a.conv_id = c.node AND a.depth <= c.depth GROUP BY a.depth, a.node)
SELECT c.node AS conv_id, c.depth::BIGINT AS depth, c.parent AS parent_conv_id, n_convs, n_children, n_leaves,
       saved::BIGINT AS saved_tokens, ends AS ends_sha256
FROM c JOIN s ON s.depth = c.depth AND s.node = c.node
"""
