import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerspark.llm import lm


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0d]+", low), None]


def brute(rows):
    held = {i: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for i, (d, _) in enumerate(rows)}
    c = Counter(w for i, (_, t) in enumerate(rows) if not held[i] for w in words_of(t))
    n, v = sum(c.values()), len(c)
    return sorted(((d, held[i], len(w := words_of(t)), sum(c[x] > 0 for x in w), n,
                    round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 4)) for i, (d, t) in enumerate(rows)), key=str)


def short(got):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got), key=str)


@pytest.mark.parametrize("share", [lm.SHARE, 1e-4])
def test_base_and_gain(spark, share):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = lm.scored(docs, share).collect()
    want = brute([tuple(r) for r in docs.collect()])
    assert [r[:5] for r in short(got)] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in short(got)], [r[5] for r in want], atol=2e-4)
    held = [r for r in got if r.held_out]
    assert all(r.score < 0 for r in got)
    assert sum(r.score for r in held) / sum(r.n_tokens for r in held) > sum(r.base_score for r in held) / sum(r.n_tokens for r in held) + 0.05


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(1)
    h = lm.mixed(np.arange(1, 400, dtype=np.uint64))
    words = lm.Vocabulary(h, np.arange(1, 400), 90_000, 600)
    weights = rng.normal(size=(5 * lm.ROWS, 32)).astype(np.float32)
    total = 0.0
    for x in h:
        text = np.array([h[3], h[7], x], np.uint64)
        c, place = words.look_up(text)
        assert place[2] >= 0
        total += 10 ** lm.log_probabilities(weights, words, text, np.array([3]), place)[2]
    other = np.array([h[3], h[7], 5], np.uint64)
    total += 10 ** lm.log_probabilities(weights, words, other, np.array([3]), words.look_up(other)[1])[2]
    assert total == pytest.approx(1, abs=1e-4)


def test_steps_raise_the_likelihood():
    rng = np.random.default_rng(2)
    h = lm.mixed(np.arange(1, 41, dtype=np.uint64))
    at = np.cumsum(rng.integers(1, 3, 60_000)) % 40  # the word before tells much
    text = h[at]
    words = lm.Vocabulary(h, np.bincount(at, minlength=40), len(at), 40)
    sizes = np.full(600, 100)
    zero = np.zeros((5 * lm.ROWS, 32), np.float32)
    place = words.look_up(text)[1]
    before = lm.log_probabilities(zero, words, text, sizes, place).mean()
    climber = lm.Climber(zero)
    for _ in range(10):
        climber.learn(words, text, sizes)
    after = lm.log_probabilities(climber.weights, words, text, sizes, place).mean()
    assert before == pytest.approx(-math.log10(40), abs=0.05) and after > before + 0.5


def test_contexts_end_at_documents():
    h = np.arange(1, 7, dtype=np.uint64)
    _, one, two = lm.features(h, np.array([1, 2, 3]))
    assert one.tolist() == [lm.START, lm.START, 2, lm.START, 4, 5]
    assert two.tolist() == [lm.START, lm.START, lm.START, lm.START, lm.START, 4]


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "A a b"), (3, "A a b"), (None, "x a"), (5, "É é a"), (9, "w " * 100_000), (10, "a unheard")]
    docs = spark.createDataFrame([(t, d, "x") for d, t in rows], "text string, doc_id long, score string")
    got = lm.scored(docs).collect()
    assert [r[:5] for r in short(got)] == [r[:5] for r in brute(rows)]
    assert np.allclose([r[5] for r in short(got)], [r[5] for r in brute(rows)], rtol=1e-9, atol=1e-3)
    assert lm.scored(docs.limit(0)).count() == 0
    only = lm.scored(docs.where("doc_id = 10")).collect() if zlib.crc32(b"10") % 7 == 2 else []
    assert all(r.base_score == 0 and r.score == 0 for r in only)


def test_every_word_is_scored_in_context():
    """Words far beyond the most frequent, and those dealt to a leaf by hash, follow the word before."""
    n = 5000
    h = lm.mixed(np.arange(1, n + 1, dtype=np.uint64))
    words = lm.Vocabulary(h[:3000], np.arange(n, n - 3000, -1), 3 * n * n, n, np.full(125, 4 * n))
    text = np.stack([h[:100], h[2900:3000], np.roll(h[:100], 1), h[4900:]], 1).ravel()  # frequent, listed, frequent, unlisted
    sizes, place = np.full(100, 4), words.look_up(text)[1]
    assert (place[1::4] >= 0).all() and (place[3::4] < 0).all() and len(set(place[3::4].tolist())) > 1
    climber = lm.Climber(np.zeros((5 * lm.ROWS, lm.WIDTH), np.float32))
    before = lm.log_probabilities(climber.weights, words, text, sizes, place)
    for _ in range(40):
        climber.learn(words, text, sizes)
    own = lm.log_probabilities(climber.weights, words, text, sizes, place)
    for k in (1, 3):
        mixed_up = text.copy()
        mixed_up[k - 1::4] = np.roll(text[k - 1::4], 7)
        mixed_up[max(0, k - 2)::4] = np.roll(text[max(0, k - 2)::4], 7) if k == 3 else mixed_up[0::4]
        other = lm.log_probabilities(climber.weights, words, mixed_up, sizes, place)
        assert own[k::4].mean() > before[k::4].mean() + 0.3
        assert own[k::4].mean() > other[k::4].mean() + 0.1


def test_the_model_grows_with_the_corpus(spark):
    assert lm.rows_for(0) == lm.ROWS and lm.rows_for(5 * 10**9) >= 32 * lm.ROWS
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    counts = lm.counted(docs).cache()
    for share in (lm.SHARE, 1e-4):  # all words listed, or most dealt by hash
        words, rare = lm.vocabulary(counts, share)
        assert words.leaves >= counts.count() / lm.LEAF_WORDS and len(words.h) + rare.count() == words.different
        assert words.others.sum() == pytest.approx(sum(r.c + 1 for r in rare.collect()) + len(words.others))
    counts.unpersist()


def test_long_words_are_counted_apart(spark):
    a, b = "a" * 64, "b" * 64
    texts = [a + b + b + a, b + a + a + b, (a + b + b + a) * 4, (b + a + a + b) * 4, "x" * 1999 + "y", "x" * 2000]
    rows = [(d, f"{texts[d % 6]} word {texts[d * 7 % 6]}") for d in range(40)]
    got = lm.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert short(got) == brute(rows)


def test_words_are_found_by_their_leading_bits():
    edge = np.array([0, 1, 2**64 - 1], np.uint64)
    h = np.concatenate([lm.mixed(np.arange(1, 2000, dtype=np.uint64)), np.arange(40, 90, dtype=np.uint64), edge[:1]])
    words = lm.Vocabulary(h, np.arange(1, len(h) + 1), 10**7, 10**4, np.full(7, 30))
    asked = np.concatenate([h[::3], lm.mixed(np.arange(5000, 6000, dtype=np.uint64)), np.arange(30, 100, dtype=np.uint64), edge, h[:5], h[:5]])
    c, place = words.look_up(asked)
    counts = dict(zip(h.tolist(), range(1, len(h) + 1)))
    assert c.tolist() == [counts.get(x, 0) for x in asked.tolist()]
    assert [(words.h[p] == x) if p >= 0 else x not in counts and -7 <= p for p, x in zip(place, asked)] == [True] * len(asked)
    for few in (h[:1], h[:2]):
        assert (lm.Vocabulary(few, np.ones(len(few), int), 9, 9).look_up(asked)[0] > 0).tolist() == np.isin(asked, few).tolist()


def test_run_sums_and_softmax_of_any_size():
    rng = np.random.default_rng(3)
    p = rng.normal(size=(5000, lm.WIDTH)).astype(np.float32)
    key = np.minimum(rng.geometric(0.01, 5000), 400) * (rng.random(5000) < 0.9)  # one long run, many short ones
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) > 0]))
    n = np.diff(np.append(first, len(key)))
    falling = np.argsort(-n, kind="stable")
    want = np.add.reduceat(p[order].astype(np.float64), first, axis=0)[falling]
    assert np.allclose(lm.run_sums(p, order, first[falling], n[falling]), want, atol=1e-3)
    bias = np.zeros((3, lm.WIDTH), np.float32)
    bias[1, 5:] = -1e4  # no such children
    node, rows = rng.integers(0, 2, 5000), [rng.integers(0, 50, 5000)]
    for scale in (1, 300):  # exponentials of 300 and of -300 are beyond 32 bits
        weights = (scale * rng.normal(size=(50, lm.WIDTH))).astype(np.float32)
        weights[7] -= 5 * scale
        z = bias[node].astype(np.float64) + weights[rows[0]]
        z -= z.max(1, keepdims=True)
        want = z - np.log(np.exp(z).sum(1, keepdims=True))
        child = rng.integers(0, 5, 5000)
        assert np.allclose(lm.log_softmax(weights, bias, node, rows, child), want[np.arange(5000), child] / np.log(10), rtol=1e-5, atol=1e-4)
        assert np.allclose(lm.softmax(weights, bias, node, rows), np.exp(want), atol=1e-4)
