import zlib

import numpy as np
import pytest

from ledgerspark.llm import langid


def test_trigrams():
    codes, part = langid.trigrams(["ab c", "é"])
    grams = ["".join(chr(int(c) >> s & 0x1FFFFF) for s in (42, 21, 0)) for c in codes]
    assert grams == [" ab", "ab ", " c ", " é "] and part.tolist() == [0, 0, 0, 1]


def test_filters_hold_every_gram_and_few_others():
    rng = np.random.default_rng(2)
    grams = {f"l{i:03d}": rng.integers(0, 2**60, 2000) for i in range(70)}
    f = langid.Filters(grams)
    for i, name in enumerate(f.names):
        assert (f.masks(grams[name])[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).all()
    other = f.masks(rng.integers(0, 2**60, 20_000))
    seen = [(other[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(70)]
    assert np.abs(np.array(seen) - f.mistakes).max() < 0.01


def test_scores_are_counts_per_text():
    codes = langid.trigrams(["abc abd"])[0]
    f = langid.Filters({"x": codes[:3], "y": codes})
    scores, n = f.scores(["abc", "abd abd", None, "zzz"])
    assert n.tolist() == [3, 6, 0, 3]
    assert scores[0].round(1).tolist() == [3, 3] and scores[1, 1].round(1) == 6


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = langid.predicted(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.selectExpr("avg(double(lang = lang_pred))", "count(*)").first()
    assert n > 2000 and right > 0.97, right


def test_odd_rows(spark):
    rows = [(i, "the cat sat on the mat and then", "en") for i in range(20)] + [(100 + i, "der hund und die katze", "de") for i in range(20)]
    rows += [(200, None, "en"), (201, "", "de"), (202, "123 !!", "en"), (203, "the cat", None), (204, "日本", "en"), (205, "the cat " * 200_000, "en"),
             (206, "THE CAT", None), (206, "THE CAT", None)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, score string")
    got = {r.doc_id: r for r in langid.predicted(docs).collect()}
    assert [got[i].lang_pred for i in (200, 201, 202, 203, 206)] == ["und", "und", "und", "en", "en"]
    assert got[204].lang_pred in ("de", "en") and all(0 <= r.score <= 1 for r in got.values())
    kept = langid.with_language(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    assert langid.predicted(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.predicted(docs.withColumn("lang", docs.lang.substr(9, 1)).where("lang is null")).collect()} <= {"und"}


@pytest.mark.parametrize("names", [1, 65])
def test_many_languages(names):
    codes = langid.trigrams(["hello world"])[0]
    f = langid.Filters({f"l{i:02d}": codes for i in range(names)})
    assert f.predict(["hello"])[0] == ["l00"]


def test_equals_exact_sets_of_grams(spark, sf_dir):
    """Against plain sets of the frequent trigrams: the same languages, and like scores."""
    from collections import Counter

    def grams(text):
        low = "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} ")
        return [low[i - 1:i + 2] for i in range(1, len(low) - 1) if low[i] != " "]

    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()]
    docs += [(-1, None, "de"), (-2, "12 34", "en"), (-3, "the and of", None)]
    held = {d: zlib.crc32(str(d).encode()) % 4 == 2 for d, _, _ in docs}
    counts = {}
    for d, text, lang in docs:
        if lang is not None and not held[d]:
            counts.setdefault(lang, Counter()).update(grams(text))
    sets = {g: {x for x, n in c.items() if n >= langid.SHARE * sum(c.values())} for g, c in counts.items()}
    got = langid.predicted(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(docs)
    for r in got:
        own = grams(next(t for d, t, _ in docs if d == r.doc_id))
        hits = {g: sum(x in s for x in own) for g, s in sets.items()}
        best = max(sorted(hits), key=hits.get)
        assert r.held_out == held[r.doc_id]
        if not own:
            assert (r.lang_pred, r.score) == ("und", 0)
        else:
            assert r.lang_pred == best and abs(r.score - hits[best] / sum(hits.values())) < 0.02
