import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import components, ngram_join


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0d]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    """(doc_id, n, component) by comparing every two different sets."""
    sets = [shingles(t) for _, t in rows]
    by_set, where = {}, {}
    for i, s in enumerate(sets):
        by_set.setdefault(s, []).append(i)
    distinct = [s for s in by_set if s]
    for i, s in enumerate(distinct):
        for g in s:
            where.setdefault(g, []).append(i)
    pairs = {(a, b) for w in where.values() for a in w for b in w if a < b}
    good = [(a, b) for a, b in pairs if 100 * len(distinct[a] & distinct[b]) >= 75 * len(distinct[a] | distinct[b])]
    tops = components.forest(good)
    least = {}
    for i, s in enumerate(distinct):
        t = tops.get(i, i)
        ids = [rows[k][0] for k in by_set[s] if rows[k][0] is not None]
        least[t] = min([*ids, *([least[t]] if least.get(t) is not None else [])], default=None)
    place = {s: i for i, s in enumerate(distinct)}
    return sorted((d, len(s), least[tops.get(place[s], place[s])] if s else d) for (d, _), s in zip(rows, sets))


def made(seed=5):
    """Bases with copies, near copies around the threshold, and a passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=40)
    texts = []
    for base in range(25):
        words = rng.choices(vocabulary, k=rng.choice([3, 5, 6, 8, 12, 30, 60, 150]))
        for copy in range(rng.choice([1, 2, 3, 12])):
            own = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    for _ in range(30):
        texts.append(" ".join([*rng.choices(vocabulary, k=rng.randrange(12)), *passage, *rng.choices(vocabulary, k=rng.randrange(12))]))
    texts += texts[:10] + [None, "", " \n", "one", "ONE", "one  two", "A b C d e f", "a B c D e F", "é É ü", "é é ü", "z " * 30_000]
    rng.shuffle(texts)
    return [(i * 3 % 1009, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return made()


@pytest.mark.parametrize("rounds,limit", [(2, None), (0, 0.0), (0, 1e9), (1, 25.0)])
def test_equals_brute_force(spark, rows, rounds, limit):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.components(docs, rounds, limit).collect())) == brute(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = brute([tuple(r) for r in docs.collect()])
    assert sorted(map(tuple, ngram_join.components(docs).collect())) == want
    assert any(d != c for d, _, c in want)


def test_odd_rows(spark):
    a = "a b c d e f g h"
    rows = [(5, a), (5, a), (7, a), (None, a), (None, "x y z"), (9, None), (9, None), (3, "x q")]
    docs = spark.createDataFrame([(t, d, "k") for d, t in rows], "text string, doc_id long, n string")
    got = sorted(map(tuple, ngram_join.components(docs).collect()), key=str)
    assert got == sorted([(5, 4, 5), (5, 4, 5), (7, 4, 5), (None, 4, 5), (None, 1, None), (9, 0, 9), (9, 0, 9), (3, 1, 3)], key=str)
    kept = ngram_join.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 5, 9, None, None]
    assert ngram_join.components(docs.limit(0)).count() == 0 and ngram_join.representatives(docs.limit(0)).count() == 0


def test_boundary_is_between_cheap_and_dear_subsets():
    costs = [(10, 5, 100), (20, 5, 100), (60, 10_000, 50)]
    limit = ngram_join.boundary(costs)
    assert ngram_join.SIZE_STEP ** 11 <= limit < ngram_join.SIZE_STEP ** 61
    assert ngram_join.boundary([]) == 0


@pytest.mark.parametrize("pairs", [[], [(1, 1)], [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 100)] + [(500, 501)]])
@pytest.mark.parametrize("how", ["one task", "rounds", "carried"])
def test_components(spark, pairs, how):
    t = spark.createDataFrame(pairs, "a long, b long").repartition(7)
    got = {}
    if how == "carried":
        half = F.col("a") % 2 == 0
        roots = components.joined(components.joined(None, t.where(half)), t.where(~half))
    else:
        roots = components.connected(t, 200_000 if how == "one task" else 5)
    for r in roots.collect():
        got.setdefault(r.root, set()).add(r.id)
    want = {}
    for x, t in components.forest(p for p in pairs if p[0] != p[1]).items():
        want.setdefault(t, set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


LONG = ["a" * 64, "b" * 64, "c" * 63, "é" * 40]


@pytest.mark.parametrize("words", [
    [(0, 1, 1, 0), (1, 0, 0, 1)],  # the stretches' places add up alike
    [(0, 1, 0), (0, 0, 1)], [(0,) * 20 + (1,), (1,) + (0,) * 20], [(3, 2, 3), (2, 3, 3)],
    [(0, 1) * 15, (1, 0) * 15], [(0, 1, 1, 0) * 7, (1, 0, 0, 1) * 7]])
def test_long_words_are_told_apart(spark, words):
    one, two = ("".join(LONG[i] for i in w) for w in words)
    rows = [(1, one), (2, two), (3, one.upper() if one.isascii() else one), (4, f"x {one} y z w v"), (5, f"x {two} y z w v"), (6, two)]
    got = ngram_join.components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect())) == brute(rows)


def test_hashes_of_words_of_any_length():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("ab") * 32 for _ in range(n)) for n in range(1, 62) for _ in range(20)})
    words += ["q" * n for n in range(65, 2001)]
    h, n = ngram_join.word_hashes([w.encode() for w in words])
    alone = [int(ngram_join.word_hashes([w.encode()])[0][0]) for w in words]
    assert n.tolist() == [1] * len(words) and len(set(h.tolist())) == len(set(words)) and h.tolist() == alone
