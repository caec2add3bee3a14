import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ledgerspark.llm import bpe, langid, mixing, ngram_join, queries, secrets


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns on sf0.01, with some planted rows."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first = docs.where("doc_id = 1").first()
    odd = spark.createDataFrame(
        [(90_001, None, "en", None, 0), (90_002, "1234 !!", "en", "src0", 7), (90_003, first.text + " again", first.lang, "src1", 1),
         (90_004, 'the token = "0123456789abcdef01234567" and more words of the text', "en", "src2", 60), (90_005, "", None, "src0", 0)], docs.schema)
    docs = docs.union(odd)
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], "").cache())
    return out


def test_columns(stages):
    assert [s.columns for s in stages[:-1]] == [stages[0].columns] * 5
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_language_drops_texts_without_letters_only(stages):
    gone = stages[0].select("doc_id").subtract(stages[1].select("doc_id"))
    assert sorted(r[0] for r in gone.collect()) == [90_001, 90_002, 90_005]


def test_one_document_of_each_group_stays(stages):
    found = ngram_join.components(stages[1]).collect()
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted({r.component_id for r in found})
    assert 90_003 not in {r.doc_id for r in stages[2].collect()}


def test_secrets_are_gone_and_documents_stay(stages):
    before, after = ({r.doc_id: r.text for r in s.collect()} for s in stages[2:4])
    assert before.keys() == after.keys() and "0123456789abcdef" not in after[90_004]
    assert all(not secrets.base_spans(t) for t in after.values())
    assert all(after[d] == t for d, t in before.items() if not secrets.spans(t))


def test_mixing_gives_whole_copies(stages):
    sized = stages[3].withColumn("size", F.lit(None)).drop("size")
    want = {r.doc_id: r.taken // r.size if r.size else 1 for r in mixing.taken(sized).collect()}
    got = {r.doc_id: r["count"] for r in stages[4].groupBy("doc_id").count().collect()}
    assert got == {d: n for d, n in want.items() if n}


def test_ids_are_those_of_the_texts(stages):
    codec = bpe.default_codec().ready()
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    rows = stages[5].collect()
    assert len(rows) == stages[4].count() and all(r.round_trip for r in rows)
    for r in rows[:200]:
        assert r.ids == codec.encode(texts[r.doc_id]).tolist() and r.n_tokens == len(r.ids)


def test_run_and_registration(spark, sf_dir):
    registered = entry.queries()
    assert registered["pipeline"] is corpus_pipeline.run
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    for name, sql in queries.ORACLES.items():
        assert sorted(con.execute(sql).fetchall()) == sorted(map(tuple, registered[name](spark, sf_dir).collect()))
    assert langid.UNKNOWN == "und"


def test_repeated_rows_and_clashing_columns(spark):
    """Rows that repeat are one document; columns named like results are carried along until the ids."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = docs.union(docs).withColumn("score", F.lit("mine")).withColumn("name", F.lit(1)).withColumn("ids", F.lit(2.5))
    now = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "").cache()
        assert now.columns == odd.columns
        assert {tuple(r) for r in now.select("score", "name", "ids").distinct().collect()} == {("mine", 1, 2.5)}
    plain = docs
    for _, stage in corpus_pipeline.STAGES[:2]:
        plain = stage(spark, plain, "")
    twice = corpus_pipeline.STAGES[1][1](spark, corpus_pipeline.STAGES[0][1](spark, odd, ""), "")
    assert sorted(r[0] for r in twice.select("doc_id").collect()) == sorted(r[0] for r in plain.select("doc_id").collect())
    assert corpus_pipeline.STAGES[-1][1](spark, now, "").where("not round_trip").count() == 0


def test_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
