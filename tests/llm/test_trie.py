import hashlib
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(turns):
    own = {}
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    members, ends = {}, {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(np.fmod(c, 100))
        seq = tuple(own.get(c - base, [])[:h] + mine[h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = (len(members[node]) - 1) * len(node[-1][1] if node else "") + sum(saved[x] for x in below)
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children.get(n, [])), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest())
                  for n, m in members.items())


def rows(df):
    return sorted(map(tuple, df.select(*NAMES).collect()))


def conversations(seed, n=260):
    r = np.random.default_rng(seed)
    out = []
    for c in range(n):
        for t in range(int(r.integers(1, 9))):
            out.append((c, t, "user" if t % 2 == 0 else "bot", f"{'hi' if c % 3 else 'yo'} {r.integers(0, 2)}"))
    return out


ODD = [(0, None, None, None), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 1, "bot", "ä😀"), (7, None, "u", ""), (7, 0, None, "x"),
       (250, 0, "u", "x"), (-5, 0, "user", "neg"), (-5, 3, "user", "neg"), (None, 0, "user", "lost"), (301, 5, "u", "t" * 100_000),
       (2**62, 0, "u", "x"), (12, 0, "", "u1:x"), (13, 0, "u1", ":x")]


@pytest.mark.parametrize("turns", [conversations(1), ODD, ODD + conversations(2, 120)], ids=["random", "odd", "both"])
def test_equals_brute_force(spark, turns):
    got = trie.nodes(spark.createDataFrame(turns, SCHEMA).repartition(3), crown=10, least=3, queue_rows=20)
    assert rows(got) == brute(turns)


def test_one_conversation_with_most_turns(spark):
    """A long chain, alone and twice; and many copies of one conversation."""
    turns = [(1, i, "u", f"t{i}") for i in range(3000)] + [(2, i, "u", f"t{i % 7}") for i in range(20)]
    turns += [(c, i, "u", f"copy {i}") for c in range(500, 900) for i in range(4)]
    turns += [(c, i, "u", f"same {i}") for c in (8, 9) for i in range(1500)]
    got = trie.nodes(spark.createDataFrame(turns, SCHEMA))
    assert rows(got) == brute(turns)


def test_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.1/conversations.parquet'")
    want = sorted(con.execute(f"SELECT {', '.join(NAMES)} FROM ({trie.ORACLE_SQL})").fetchall())
    assert rows(trie.nodes(spark.read.parquet("/root/testdata/sf0.1/conversations.parquet"))) == want


def test_odd_tables(spark):
    turns = spark.createDataFrame(ODD, SCHEMA)
    assert rows(trie.nodes(turns.withColumn("depth", F.lit("x")).withColumn("size", F.lit(3)))) == brute(ODD)
    assert rows(trie.nodes(turns.limit(0))) == []
    twice = [r for r in ODD for _ in range(2)]
    assert rows(trie.nodes(spark.createDataFrame(twice, SCHEMA))) == brute(twice)


@pytest.mark.parametrize("most", [5, 40, 10_000])
def test_queue_spills(most):
    r = np.random.default_rng(most)
    queue, held, want = trie.SpillingQueue(most), {}, 0
    for level in range(30, 0, -1):
        for _ in range(4):
            rows = np.zeros(25, trie.SpillingQueue.KIND)
            rows["level"], rows["node"] = r.integers(max(0, level - 3), level, 25), r.integers(0, 40, 25)
            rows["leaves"], rows["saved"] = 1, r.integers(0, 9, 25)
            queue.push(rows)
            for x in rows.tolist():
                n, s = held.get(x[:2], (0, 0))
                held[x[:2]] = n + 1, s + x[3]
        for last in (10, 25, 40):
            got = queue.pop(level - 1, last)
            due = sorted(k for k in held if (-k[0], k[1]) <= (1 - level, last))
            assert sorted((*x[:2],) for x in got.tolist()) == due
            assert all(held.pop(x[:2]) == x[2:] for x in got.tolist())
            want += len(due)
    assert want and (queue.spilled > 0) == (most < 1000)


def test_forward_adds_up_a_tree():
    """A binary tree in small batches through a small queue."""
    depth, conv, parent = [], [], []
    for d in range(9, -1, -1):
        for c in range(2**d):
            depth.append(d)
            conv.append(c)
            parent.append(c // 2 if d else -1)
    n = len(depth)
    table = pa.RecordBatch.from_arrays([pa.array(depth), pa.array(conv), pa.array(parent),
                                        pa.array([int(d == 9) for d in depth]), pa.array([1] * n)], ["a", "b", "c", "d", "e"])
    out = pa.Table.from_batches(trie.forward((table.slice(i, 7) for i in range(0, n, 7)), 16)).to_pydict()
    assert out["leaves"] == [2 ** (9 - d) for d in depth]
    assert out["saved"] == [2 ** (10 - d) - 1 for d in depth]
