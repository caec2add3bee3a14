import numpy as np
import pytest

from ledgerspark.llm import ann


def brute(rows, k=ann.NEAREST):
    ok = [(v, np.array(x, float)) for v, x in rows
          if v is not None and x is not None and len(x) and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    out = {}
    for v, q in ok:
        if v % ann.EVERY == 0:
            near = sorted((-(x @ q), w) for w, x in ok if w != v and len(x) == len(q))[:k]
            out[v] = [(r + 1, w, -s) for r, (s, w) in enumerate(near)]
    return out


def recall(got, want):
    hit = n = 0
    for v, near in want.items():
        mine = {r.vec_id for r in got if r.query_id == v}
        hit += sum(w in mine for _, w, _ in near)
        n += len(near)
    return hit / max(1, n)


def test_probing_finds_every_code_within_the_distance():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2, (8, ann.BITS))
    bits = centre[rng.integers(0, 8, 1500)] ^ (rng.random((1500, ann.BITS)) < rng.choice([0.02, 0.1, 0.3], (1500, 1)))
    codes = np.packbits(bits, axis=1).view(np.uint16)
    index = ann.SubstringIndex(codes)
    for q in codes[:40]:
        distance = np.bitwise_count(codes ^ q).sum(1)
        for wanted in (1, 20, 300):
            radius = np.sort(distance)[wanted - 1]
            assert index.within(q, wanted).tolist() == np.flatnonzero(distance <= radius).tolist()
    assert len(index.within(codes[0], 5000)) == 1500


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=8) * rng.choice([0.1, 1, 30])]) for i in range(150)]
    rows += [(500 + i, rows[0][1]) for i in range(30)]  # ties
    rows += [(20, None), (40, []), (60, [0.0] * 8), (80, [1.0, None]), (100, [float("nan")] * 8), (None, rows[0][1]), (600, [1.0, 2.0]), (601, [3.0, 1.0]), (640, [1.0])]
    rows += [(700, rows[5][1]), (700, rows[5][1])]
    rows = [r for r in rows if r[0] not in (20, 40, 60, 80, 100) or r[1] is None or len(r[1]) != 8 or not any(r[1])]
    t = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    want = brute(rows)
    got = ann.searched(t).collect()
    assert got and all(np.isfinite(r.score) for r in got)
    for v, near in want.items():
        mine = sorted((r.rank, r.vec_id) for r in got if r.query_id == v)
        assert mine == [(r, w) for r, w, _ in near]
    for r in got:
        assert r.score == pytest.approx(dict((w, s) for _, w, s in want[r.query_id])[r.vec_id])


@pytest.mark.parametrize("blocks", [(16_384, 2048), (300, 40)])
def test_recall(spark, blocks):
    t = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in t.collect()]
    got = ann.nearest(t, t.where(t.vec_id % 20 == 0), index_block=blocks[0], query_block=blocks[1]).collect()
    want = brute(rows)
    assert len(got) == sum(map(len, want.values()))
    assert recall(got, want) >= 0.93, recall(got, want)


def test_recall_with_uneven_lengths_and_groups(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(20, 32)) + 2
    x = base[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 32)) * 0.7
    x *= rng.lognormal(0, 0.5, (3000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert recall(ann.searched(t).collect(), brute(rows)) >= 0.9


def test_empty_table(spark):
    assert ann.searched(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("length", [64, 128, 256])
def test_recall_on_vectors_of_any_length(spark, length):
    x = np.random.default_rng(4).normal(size=(6000, length))
    codes = ann.fitted(x[:ann.TRAIN_ROWS], np.sqrt((x * x).sum(1)).max(), len(x))
    ids, q = np.arange(len(x)), x[::60]
    place, found, _ = ann.search_block(codes, ids, x, ids[::60], q, ann.NEAREST)
    score = q @ x.T
    score[np.arange(len(q)), ids[::60]] = -np.inf
    want = np.argsort(-score, 1)[:, :ann.NEAREST]
    assert np.mean([len(set(want[i]) & set(found[place == i])) / ann.NEAREST for i in range(len(q))]) >= 0.9


def test_few_rows_are_touched_among_clusters():
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(24, 64))[:, None] + rng.normal(size=(24, 600, 64)) * 0.1).reshape(-1, 64)
    codes = ann.fitted(x[::4], np.sqrt((x * x).sum(1)).max(), len(x))
    index = ann.SubstringIndex(codes.rows(x))
    for code in codes.queries(x[::300]):
        index.within(code, codes.wanted + ann.NEAREST)
    assert index.touched / (len(x[::300]) * len(x)) < 0.25


def test_rows_with_the_query_s_own_id_hide_no_others(spark):
    rng = np.random.default_rng(6)
    rows = [(20, (v + 5).tolist()) for v in rng.normal(size=(1500, 8))] + [(21 + i, v.tolist()) for i, v in enumerate(rng.normal(size=(30, 8)))]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(t, t.where("vec_id = 40")).collect()
    assert [r.rank for r in got] == list(range(1, 21))
    own = ann.nearest(t, t.where("vec_id = 20").limit(3)).collect()
    assert len(own) == 60 and all(r.vec_id != 20 for r in own)


def test_dealing_does_not_depend_on_the_order_of_rows(spark):
    rng = np.random.default_rng(7)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(900, 8)))]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    a, b = (sorted(map(tuple, ann.nearest(f, f.where("vec_id % 20 = 0"), index_block=200, query_block=20).collect()))
            for f in (t, t.repartition(7, "vec_id")))
    assert a == b
