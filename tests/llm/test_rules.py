import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import rules

SCHEMA = "doc_id long, text string, lang string, source string"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(hit), len(lines))


TEXTS = [None, "", "a", "a b", "a b c", "a b c a b c", "x x x x", " \t\n\x0b\x0c\r", "a\nb\na\n\na", "#*$ %&|<>", "ü ß é",
         "to be or not to be or not", "\n".join(["same line"] * 5), "é" * 3000 + " " + "w v u " * 400, "😀 😀\x1c😀", "a b c d a b c e a b c"]


def test_counts_equal_brute_force():
    got = rules.counted_texts(TEXTS * 3)
    assert list(zip(*(got[c].tolist() for c in rules.COUNTS))) == [counts(t) for t in TEXTS * 3]


def test_windows_of_a_very_long_text():
    text = " ".join(f"w{i}" for i in range(2_200_000)) + " w5 w6 w7 z"  # past the packed codes
    got = rules.counted_texts([text, "a b c a b c"])
    assert got["n_repeat_words"].tolist() == [6, 6] and got["n_words"].tolist() == [2_200_004, 6]


def test_bucket_keeps_leading_digits(spark):
    values = [0, 1, 127, 128, 129, 1000, 123_456_789]
    got = [r.b for r in spark.createDataFrame([(v,) for v in values], "v long").select(
        rules.bucket(F.col("v")).alias("b")).collect()]
    assert got == [v >> max(0, v.bit_length() - 7) << max(0, v.bit_length() - 7) for v in values]


def test_sketches_merge(spark, sf_dir):
    c = rules.measured(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    whole = rules.sketches(c)
    halves = rules.sketches(c.where("doc_id < 90")).unionByName(rules.sketches(c.where("doc_id >= 90")))
    assert sorted(map(tuple, rules.merged(halves, "lang", "source").collect()), key=str) == sorted(
        map(tuple, rules.merged(whole, "lang", "source").collect()), key=str)


def same_as_sql(docs, got):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    names = ["doc_id", *rules.COUNTS[:-1], "base_failed", "kept"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({rules.ORACLE_SQL})").fetchall()
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want, key=str)


def test_sql(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    same_as_sql(docs, rules.judged(docs))


def test_odd_rows(spark):
    rows = [(i % 20, t, "de" if i % 2 else None, None if i % 3 else "s") for i, t in enumerate(TEXTS * 2)]
    docs = spark.createDataFrame([*rows, (None, "w " * 60, None, "s")], SCHEMA)
    got = rules.judged(docs.withColumn("n_words", F.lit("clash")).withColumn("rows", F.lit(1)).withColumn("kept", F.lit(2)))
    same_as_sql(docs, got)
    assert rules.judged(docs.limit(0)).count() == 0


def test_cutoffs_follow_the_group(spark):
    """Symbols are usual in one source and stand out in the other; both ways to join agree."""
    def text(i, marks):
        return " ".join(f"w{i}x{j}" + ("#" if j < marks else "") for j in range(100))

    rows = [(i, text(i, 30), "en", "code") for i in range(250)]
    rows += [(1000 + i, text(i, 0), "en", "prose") for i in range(250)]
    rows += [(2000, text(2000, 30), "en", "prose"), (2001, text(2001, 90), "en", "code")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r.kept for r in rules.judged(docs).collect()}
    assert sorted(i for i, k in got.items() if not k) == [2000, 2001]
    shuffled = {r.doc_id: r.kept for r in rules.judged(docs, limit=0).collect()}
    assert shuffled == got


@pytest.mark.parametrize("folder", ["sf0.1"])
def test_clean_documents_stay(spark, folder):
    d = f"/root/testdata/{folder}"
    got = rules.judged(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    row = got.where("not base_failed").agg(F.avg(F.when(F.col("quality") == 1, F.col("kept").cast("int"))).alias("clean"),
                                           F.avg(F.when(F.col("quality") == 0, F.col("kept").cast("int"))).alias("junk")).first()
    assert row.clean > 0.99 and row.junk < 0.05
