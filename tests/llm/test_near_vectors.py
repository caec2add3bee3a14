import numpy as np
import pytest

from ledgerspark.llm import near_vectors
from ledgerspark.llm.components import forest


def brute(rows, cosine=near_vectors.COSINE):
    ids = [r[0] for r in rows]
    links = []
    use = []
    for i, (v, x, label) in enumerate(rows):
        ok = v is not None and label is not None and x is not None and len(x) and all(c is not None and np.isfinite(c) for c in x) and any(x)
        use.append(np.array(x, float) / np.linalg.norm(np.array(x, float)) if ok else None)
    for i in range(len(rows)):
        for j in range(i):
            if use[i] is not None and use[j] is not None and rows[i][2] == rows[j][2] and len(use[i]) == len(use[j]):
                if use[i] @ use[j] >= cosine:
                    links.append((i, j))
    n = np.zeros(len(rows), int)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    tops = forest(links)
    least = {}
    for i in range(len(rows)):
        t = tops.get(i, i)
        least[t] = min(least.get(t, ids[i]), ids[i]) if ids[i] is not None else ids[i]
    return sorted(((ids[i], int(n[i]), least[tops.get(i, i)], ids[i] == least[tops.get(i, i)]) for i in range(len(rows))), key=str)


def made():
    rng = np.random.default_rng(7)
    rows = []
    for base in range(40):
        x = rng.normal(size=64)
        for _ in range(int(rng.choice([1, 1, 2, 5]))):
            y = x + rng.normal(size=64) * np.linalg.norm(x) / 8 * rng.choice([0.0, 0.05, 0.2])
            rows.append((len(rows), [float(np.float32(c)) for c in y], base % 3))
    x = rng.normal(size=64)
    for _ in range(150):
        rows.append((len(rows), [float(np.float32(c)) for c in x + rng.normal(size=64) * 0.1], 1))
    rows += [(len(rows) + i, rows[0][1], 0) for i in range(30)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * 64, 1), (n + 3, [1.0, None], 1), (n + 4, [float("nan")] * 64, 1), (n + 5, [float("inf")] * 64, 1),
             (n + 6, rows[0][1], None), (None, rows[0][1], 0), (n + 7, [1.0, 2.0], 1), (n + 8, [2.0, 4.0], 1), (n + 9, [1.0], 1), (n + 10, [3.0], 1), (n + 11, [2.0 * c for c in rows[0][1]], 0)]
    return rows


@pytest.mark.parametrize("block,entries", [(1024, None), (16, None), (32, 8)])
def test_equals_brute_force(spark, block, entries):
    rows = made()
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(map(tuple, near_vectors.near_duplicates(t, block=block, entries=entries).collect()), key=str)
    assert got == brute(rows)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(8)
    x = near_vectors.unit(rng.normal(size=(2000, 64)))
    y = rng.normal(size=(2000, 64))
    y = near_vectors.unit(y - (y * x).sum(1, keepdims=True) * x)
    z = 0.931 * x + np.sqrt(1 - 0.931**2) * y
    code = near_vectors.ProductCodes(64, 128)
    share = [np.intersect1d(a, b).size > 0 for a, b in zip(code.decode(x), code.decode(z))]
    assert np.mean(share) > 0.99


def test_decoded_filters_are_the_best():
    rng = np.random.default_rng(9)
    code = near_vectors.ProductCodes(6, 16, codes=1, passes=5)
    x = rng.normal(size=(20, 6))
    turn, left, right = code.codes[0]
    y = x @ turn
    for v, got in zip(y, code.decode(x)):
        total = ((left @ v[:3])[:, None] + (right @ v[3:])[None]).ravel()
        assert got.tolist() == sorted(np.argsort(-total)[:5].tolist())


def test_given_vectors_and_empty_table(spark):
    t = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in t.collect()]
    assert sorted(map(tuple, near_vectors.near_duplicates(t).collect()), key=str) == brute(rows)
    assert near_vectors.near_duplicates(t.limit(0)).count() == 0


@pytest.mark.parametrize("entries", [32, 64, 256, 512, 1024, 2048, 4096])
def test_recall_at_the_threshold_stays_as_the_table_grows(entries):
    rng = np.random.default_rng(8)
    x = near_vectors.unit(rng.normal(size=(2000, 64)))
    y = rng.normal(size=(2000, 64))
    y = near_vectors.unit(y - (y * x).sum(1, keepdims=True) * x)
    z = 0.931 * x + np.sqrt(1 - 0.931**2) * y
    code = near_vectors.ProductCodes(64, entries)
    share = [np.intersect1d(a, b).size > 0 for a, b in zip(code.decode(x), code.decode(z))]
    assert np.mean(share) >= 0.998
