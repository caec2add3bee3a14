import math
import re
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from ledgerspark.llm import search


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 100 - 25 + 25 * sum(b.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m))
                    for t in terms(text) if t in b)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


DOCS = [(i, " ".join(f"w{j}" for j in range(i % 7, 40, 1 + i % 5)) + " W3" * (i % 4)) for i in range(300)]
DOCS += [(300, None), (301, ""), (302, " .,\n"), (303, "w3 " * 5000), (304, "ÄÖ\u0080x äö ÄÖ"), (304, "ÄÖ\u0080x äö ÄÖ"), (None, "W9 w9 zebra")]
ITEMS = [(1, "w3 w9 W9 zebra"), (2, "nothing known"), (3, None), (4, ""), (5, "ÄÖ äö, x"), (5, "w11"), (None, "w20-w21_w22"), (7, "w0 w1 w2 w3")]


def frames(spark):
    return (spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string"))


def test_equals_brute_force(spark):
    docs, items = frames(spark)
    assert rows(search.searched(docs.repartition(3), items)) == brute(DOCS, ITEMS)
    assert rows(search.searched(docs, items, k=3, block_terms=4)) == brute(DOCS, ITEMS, 3)


def test_blocks_of_documents(spark, monkeypatch):
    """A threshold from earlier blocks loses nothing."""
    bags = [Counter(terms(t)) for _, t in DOCS[:300]]
    names = {t: i for i, t in enumerate(sorted({t for b in bags for t in b}))}
    query = [(names["w39"], 7), (names["w11"], 5), (names["w3"], 1)]
    n = np.array([sum(b.values()) for b in bags])

    def block(part):
        pairs = [sorted((names[t], c) for t, c in b.items()) for b in bags[part]]
        return search.Block(n[part], np.array([len(p) for p in pairs]), np.array([t for p in pairs for t, _ in p]),
                            np.array([c for p in pairs for _, c in p]), 300, int(n.sum()))

    def best(found, scores, at):
        return sorted(((int(s), -int(i) - at) for i, s in zip(found, scores)), reverse=True)[:20]

    whole = best(*block(slice(0, 300)).best(query, 20, 0), 0)
    first = best(*block(slice(0, 150)).best(query, 20, 0), 0)
    second = best(*block(slice(150, 300)).best(query, 20, first[-1][0]), 150)
    assert sorted(first + second, reverse=True)[:20] == whole


def test_accumulators_are_limited(spark):
    """Documents that hold only the frequent term get no accumulator once twenty beat it."""
    n, term, tf = np.full(1000, 100), [], []
    sizes = []
    for i in range(1000):
        own = [0, 1] if i < 30 else [1]
        term += own
        tf += [1] * len(own)
        sizes.append(len(own))
    block = search.Block(n, np.array(sizes), np.array(term), np.array(tf), 1000, 100_000)
    found, scores = block.best([(0, search.weight(1000, 30)), (1, search.weight(1000, 1000) + 1)], 20, 0)
    assert block.opened == 30 and len(found) == 30
    value = int(search.impact(np.array([1]), np.array([100]), 1000, 100_000)[0])
    assert scores.tolist() == [value * (search.weight(1000, 30) + search.weight(1000, 1000) + 1)] * 30


def test_sql(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{d}/{name}.parquet'")
    got = search.searched(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet"))
    assert rows(got) == sorted(con.execute(search.ORACLE_SQL).fetchall(), key=str)


def test_odd_tables(spark):
    docs, items = frames(spark)
    extra = docs.withColumn("score", F.lit("x")).withColumn("terms", F.lit(1))
    assert rows(search.searched(extra, items.withColumn("rank", F.lit("x")))) == brute(DOCS, ITEMS)
    assert rows(search.searched(docs.limit(0), items)) == [] and rows(search.searched(docs, items.limit(0))) == []


def test_very_long_text(spark):
    text = "needle " + "hay " * 700_000 + "needle"
    assert [len(p) for p in search.terms(text)] != [] and sum(map(len, search.terms(text))) == 700_002
    docs = [(1, text), (2, "needle in hay"), (3, "x" * 3_000_000)]
    got = search.searched(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame([(1, "needle")], "item_id long, text string"))
    assert rows(got) == brute(docs, [(1, "needle")])
