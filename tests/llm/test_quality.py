import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import quality


def brute_marginals(chain, logits):
    """P(line is good) by summing over all labellings."""
    n, total, good = len(logits), 0.0, np.zeros(len(logits))
    for labels in itertools.product((0, 1), repeat=n):
        s = chain.first[labels[0]] + sum(l * e for l, e in zip(labels, logits))
        s += sum(chain.steps[a, b] for a, b in zip(labels, labels[1:]))
        total += np.exp(s)
        good += np.exp(s) * np.array(labels)
    return good / total


def test_marginals():
    rng = np.random.default_rng(3)
    chain = quality.Chain(1)
    chain.weights, chain.steps, chain.first = np.ones(1), rng.normal(size=(2, 2)), rng.normal(size=2)
    lines = np.array([3, 1, 7, 3])
    x = rng.normal(size=(lines.sum(), 1))
    got = chain.marginals(x, lines)
    at = 0
    for n in lines:
        assert got[at:at + n] == pytest.approx(brute_marginals(chain, x[at:at + n, 0]))
        at += n


def test_gradient_leads_uphill_and_labels_are_learned():
    rng = np.random.default_rng(4)
    lines = rng.integers(1, 6, 300)
    y = rng.integers(0, 2, 300)
    x = np.column_stack([np.ones(lines.sum()), np.repeat(y, lines) + 0.5 * rng.normal(size=lines.sum())])
    chain = quality.Chain(2).fit(x, lines, y)
    good = chain.marginals(x, lines)
    doc = np.add.reduceat(good, np.cumsum(lines) - lines) / lines
    assert ((doc > 0.5) == y).mean() > 0.85
    assert chain.steps[0, 0] > chain.steps[0, 1] and chain.steps[1, 1] > chain.steps[1, 0]


def test_lines_are_counted_per_text():
    texts = ["a b\n\nA!", None, "", "x" * 100_000, "same\nsame"]
    x, n, lines = quality.line_features(texts)
    assert lines.tolist() == [3, 1, 1, 1, 2] and n.tolist() == [3, 0, 2, 0, 0, 100_000, 4, 4]
    alone = [quality.line_features([t])[0] for t in texts]
    assert np.allclose(x, np.concatenate(alone))


def test_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = quality.predicted(docs, labels).join(labels, "doc_id").where("held_out and quality is not null")
    rows = got.select("score", "predicted", "quality").collect()
    y, s = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    assert (np.array([r.predicted for r in rows]) == y).mean() > 0.97
    assert (s[y == 1][:, None] > s[y == 0][None]).mean() > 0.98


def test_odd_rows(spark):
    rows = [(i, "Good words. Fine text.\nMore of it." if i % 2 else "### $$$ %%% ***\n@@@ ###", "clash") for i in range(40)]
    docs = spark.createDataFrame([*rows, (100, None, ""), (101, "", ""), (101, "", ""), (None, "x", ""), (102, "a\n" * 20_000, "")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0), (2, None), (100, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.predicted(docs, labels).collect()}
    assert len(got) == 44 and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.predicted == i % 2 for i, r in got.items() if i is not None and i < 40)
    none = quality.predicted(docs, labels.where(F.lit(False))).select("score", "predicted").distinct().collect()
    assert [tuple(r) for r in none] == [(0.5, 1)]
    assert quality.predicted(docs.limit(0), labels).count() == 0
