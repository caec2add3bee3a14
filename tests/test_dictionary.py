import pytest
from pyspark.sql import functions as F

from ledgerspark.operators.dictionary import LabelDictionary
from ledgerspark.sources.scratch import scratch_path


def fitted(spark, df, cols, **more):
    return LabelDictionary.fit(df, cols, scratch_path(spark, "dictionary"), **more)


def frame(spark):
    return spark.createDataFrame(
        [(1, "b", 5.0), (2, "a", None), (3, "b", float("nan")), (4, None, -1.0)], "id long, g string, v double")


@pytest.mark.parametrize("limit", [100, 1])
def test_codes_of_one_frame_on_another(spark, limit):
    d = fitted(spark, frame(spark), ["g", "v"])
    other = spark.createDataFrame(
        [(1, "a", 5.0), (2, "c", -1.0), (3, None, 7.0), (4, "b", None), (5, "b", float("nan"))], "id long, g string, v double")
    got = d.encode(other, local_limit=limit)
    assert got.columns == ["id", "g", "v"]
    assert sorted(map(tuple, got.collect())) == [(1, 0, 1), (2, -1, 0), (3, None, -1), (4, 1, None), (5, 1, None)]
    assert {r.g for r in d.encode(other, ["g"], unseen=None, local_limit=limit).collect()} == {0, 1, None}
    back = d.decode(got, local_limit=limit)
    assert sorted((r.id, r.g or "", r.v or 0.0) for r in back.collect()) == [
        (1, "a", 5.0), (2, "", -1.0), (3, "", 0.0), (4, "b", 0.0), (5, "b", 0.0)]


def test_a_loaded_dictionary_gives_the_same_codes(spark):
    d = fitted(spark, frame(spark), ["g", "v"])
    again = LabelDictionary.load(spark, d.path)
    assert again == d
    assert sorted(map(tuple, again.encode(frame(spark)).select("id", "g").collect())) == [(1, 1), (2, 0), (3, 1), (4, None)]
    assert [tuple(r) for r in again.codes("g").orderBy("code").collect()] == [("a", 0, 1), ("b", 1, 2)]


def test_many_values_with_hot_ones_seen_and_unseen(spark):
    i = F.col("id")
    fit = spark.range(4000).select("id", F.when(i % 3 == 0, 7).otherwise(i * 17 % 1009).alias("v"))
    new = spark.range(3000).select("id", F.when(i % 3 == 0, 7).when(i % 3 == 1, 5000).otherwise(i % 1500).alias("v"))
    d = fitted(spark, fit, ["v"], ranges=8)
    order = {v: n for n, v in enumerate(sorted({r.v for r in fit.collect()}))}
    want = {(r.id, order.get(r.v, -1)) for r in new.collect()}
    assert {(r.id, r.v) for r in d.encode(new, local_limit=50).collect()} == want


@pytest.mark.parametrize("limit", [100_000, 2])
def test_a_stream_is_encoded_like_a_table(spark, limit):
    t = spark.range(200).select("id", (F.col("id") % 9).cast("string").alias("g"))
    d = fitted(spark, t.where("g < '6'"), ["g"])
    folder = scratch_path(spark, "arrived")
    t.repartition(3).write.parquet(folder)
    source = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = f"{folder}-coded"
    d.encode(source, local_limit=limit).writeStream.option("checkpointLocation", f"{folder}-checkpoint") \
        .trigger(availableNow=True).start(out, format="parquet").awaitTermination()
    got, want = spark.read.parquet(out), d.encode(spark.read.parquet(folder))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.where("g = -1").count() > 0


def test_only_the_column_s_own_partition_is_read(spark):
    d = fitted(spark, frame(spark), ["g", "v"])
    plan = d.codes("v")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_i" in plan.split("PartitionFilters")[1][:60]


def test_what_is_refused(spark):
    df = frame(spark)
    d = fitted(spark, df, ["g"])
    with pytest.raises(ValueError, match="fitted as string"):
        d.encode(df.withColumn("g", F.lit(1)))
    with pytest.raises(ValueError, match="no columns"):
        d.encode(df, ["v"])
    with pytest.raises(ValueError, match="Missing columns"):
        fitted(spark, df, ["absent"])
    with pytest.raises(FileNotFoundError, match="label dictionary"):
        LabelDictionary.load(spark, scratch_path(spark, "nothing"))


def test_empty_and_all_null(spark):
    df = frame(spark)
    d = fitted(spark, df.where("id > 9"), ["g", "v"])
    assert [tuple(r) for r in d.encode(df).orderBy("id").collect()] == [
        (1, -1, -1), (2, -1, None), (3, -1, None), (4, None, -1)]
    assert d.encode(df.where("id > 9")).count() == 0
