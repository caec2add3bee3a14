import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerspark.operators import fill, ordered
from ledgerspark.operators.ordered import RANGE, keys_at_ranks, hash_key, with_range


@pytest.fixture(scope="module")
def gaps(spark):
    i = F.col("id")
    return spark.range(3000).repartition(5).select(
        i,
        F.when(i % 3 == 0, 0).otherwise(i % 11).alias("card"),
        F.when((i > 200) & (i % 700 == 3), i.cast("double")).alias("rare"),
        F.when(i % 4 != 0, F.concat(F.lit("v"), i.cast("string"))).alias("often"),
        F.lit(None).cast("string").alias("never"),
    ).cache()


COLS = ["rare", "often", "never"]


def naive(df, parts, forward, backward):
    w = Window.partitionBy(*(parts or [F.lit(0)])).orderBy("id")
    before, after = w.rowsBetween(Window.unboundedPreceding, 0), \
        w.rowsBetween(0, Window.unboundedFollowing)
    for c in COLS:
        if forward:
            df = df.withColumn(c, F.last(c, True).over(before))
    for c in COLS:
        if backward:
            df = df.withColumn(c, F.first(c, True).over(after))
    return df


@pytest.mark.parametrize("parts", [[], ["card"]])
@pytest.mark.parametrize("ranges", [1, 4, 50])
@pytest.mark.parametrize("how", ["forward", "backward", "both"])
def test_equals_the_plain_window(gaps, how, ranges, parts):
    job = {"forward": fill.forward_fill, "backward": fill.backward_fill,
           "both": fill.fill_missing}[how]
    got = job(gaps, COLS, order_by="id", partition_by=parts, ranges=ranges)
    expected = naive(gaps, parts, how != "backward", how != "forward")
    expected = {tuple(r) for r in expected.select(*got.columns).collect()}
    assert {tuple(r) for r in got.collect()} == expected
    assert got.count() == 3000
    assert got.columns == gaps.columns


def test_leading_gaps_and_nan(spark):
    df = spark.createDataFrame(
        [(1, None, None), (2, float("nan"), "x"), (3, 5.0, None), (4, None, None)],
        "k int, v double, s string")
    rows = fill.fill_missing(df, order_by="k").orderBy("k").collect()
    assert [(r.v, r.s) for r in rows] == [(5.0, "x"), (5.0, "x"), (5.0, "x"), (5.0, "x")]
    assert df.where("v IS NULL").count() == 2


def test_order_is_mandatory(spark):
    with pytest.raises(ValueError, match="order_by"):
        fill.fill_missing(spark.range(3), order_by=None)


def test_hot_key_is_spread(gaps):
    ranged = with_range(gaps, ["card", "id"], 16)
    sizes = ranged.groupBy(RANGE).count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert sizes[1] > 8 and sizes[0] < 1000  # a third of the rows share one card


def test_ranges_follow_the_order(gaps):
    ranged = with_range(gaps, ["card", "id"], 16)
    edges = ranged.groupBy(RANGE).agg(
        F.min(F.struct("card", "id")).alias("lo"), F.max(F.struct("card", "id")).alias("hi"))
    rows = edges.orderBy(RANGE).collect()
    assert all(a.hi < b.lo for a, b in zip(rows, rows[1:]))


def test_keys_at_ranks(spark):
    df = spark.range(5000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    keyed = df.withColumn("k", hash_key(9, ["id"]))
    for y, n in ((0, 4500), (1, 500)):
        ordered = [r.k for r in keyed.where(F.col("y") == y).orderBy("k").collect()]
        for rank in (1, 2, n // 3, n - 1, n):
            got = keys_at_ranks(df, "y", hash_key(9, ["id"]), [(y, rank, n)])
            assert got == [ordered[rank - 1]]


def test_keys_at_ranks_without_a_uniform_hash(spark):
    df = spark.range(3000).select("id", F.lit(1).alias("y"))
    key = F.lpad(F.hex("id"), 32, "0")  # all within a sliver of the range
    got = keys_at_ranks(df, "y", key, [(1, 1000, 3000)])
    assert int(got[0], 16) == 999


def test_ties_in_the_order_raise(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None)], "k long, v string")
    with pytest.raises(Exception, match="does not tell the rows apart"):
        fill.fill_missing(df, ["v"], order_by="k").collect()


@pytest.mark.parametrize("total", [10**6, 10**12])
def test_ranges_follow_the_table(spark, total):
    n = ordered.range_count(spark.range(1), total)
    assert total / n <= ordered.ROWS_PER_RANGE


@pytest.mark.parametrize("keys", [["id"], ["card", "id"], ["often", "id"]])
@pytest.mark.parametrize("ranges, size", [(3, None), (300, None), (1500, None), (1500, 0)])
def test_directory_of_ranges(gaps, monkeypatch, keys, ranges, size):
    """Ranges ascend with the key and are of like size, on one level or two, broadcast or not."""
    if size is not None:
        monkeypatch.setattr(ordered, "DIRECTORY_BYTES", size)
    ranged = with_range(gaps, keys, ranges)
    key = F.struct(*keys)
    edges = ranged.groupBy(RANGE).agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n"))
    overlap = F.lag("hi").over(Window.partitionBy(F.lit(0)).orderBy(RANGE)) >= F.col("lo")
    row = edges.withColumn("bad", F.coalesce(overlap, F.lit(False))).agg(
        F.count_if("bad").alias("bad"), F.sum("n").alias("n"), F.max("n").alias("most"), F.count(F.lit(1)).alias("k")).first()
    assert (row.bad, row.n) == (0, 3000) and row.most <= max(40, 4 * 3000 / ranges) and row.k <= ranges + 256


def test_plan_does_not_grow_with_the_ranges(gaps):
    """No cut point is in the plan, and the sample is bounded by the tasks."""
    def plan(n):
        return with_range(gaps, ["id"], n)._jdf.queryExecution().optimizedPlan().toString()

    few, many, most = plan(600), plan(2400), plan(9600)  # one more step of halving each
    assert len(many) - len(few) < 2_000 and len(most) - len(many) < 2_000


def test_sample_of_a_task_is_bounded(spark):
    sample = ordered._sampled(spark.range(0, 200_000, numPartitions=2).select(F.col("id").alias("_key")))
    rows = sample.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.sum("_rows").alias("rows")).collect()
    assert len(rows) == 2 and all(500 < r.n <= 2 * ordered.TASK_SAMPLES and abs(r.rows - 100_000) < 200 for r in rows)


def test_input_is_read_twice(spark, tmp_path, gaps):
    """The keys for the ranges, and the rows; the edges of the ranges come from what was shuffled."""
    path = str(tmp_path / "gaps")
    gaps.write.parquet(path)
    done = fill.fill_missing(spark.read.parquet(path), order_by="id")
    done.collect()
    plan = done._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")
    assert sum(p.count("ReusedExchange") for p in plan) == 1
