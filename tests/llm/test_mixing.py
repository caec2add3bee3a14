import re

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import mixing


def reshared(sizes, weights=(1, 2, 3), most=3):
    """Targets by sharing again and again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


SIZES = [{"a": 10, "b": 1, "c": 1000, None: 5}, {"a": 0, "b": 0}, {"x": 7}, {"a": 100, "b": 100, "c": 100, "d": 1, "ä": 3, None: 50}, {}]


@pytest.mark.parametrize("sizes", SIZES, ids=range(len(SIZES)))
def test_targets(spark, sizes):
    t = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(t).collect()}
    assert got == pytest.approx(reshared(sizes))
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_taken_is_near_target_and_repeats(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = mixing.taken(docs).cache()
    assert got.count() == docs.count()
    assert got.where("taken > 3 * size").count() == 0
    near = got.withColumn("n", F.lit(1)).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("t"), F.first("target").alias("g"))
    assert all(abs(r.t - r.g) < 0.15 * r.g for r in near.collect())
    assert sorted(got.collect()) == sorted(mixing.taken(docs.repartition(7)).collect())


def test_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = sorted(con.execute(mixing.ORACLE_SQL).fetchall())
    assert sorted(map(tuple, mixing.taken(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect())) == want


ODD = [(1, None, "a"), (1, None, "a"), (2, "x y   z\x0bq", None), (3, "", "b"), (None, "word", "a"), (4, "w " * 50_000, "b")]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.taken(docs).collect()
    assert sorted(r["size"] for r in got) == sorted(len(re.findall(r"[^\x20\x09-\x0d]+", t or "")) for _, t, _ in ODD)
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns and {r["size"] for r in mixed.collect()} == {"clash"}
    assert mixing.mixture(docs.limit(0)).count() == 0 and mixing.taken(docs.limit(0)).count() == 0


def test_native_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = mixing.mixture(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
