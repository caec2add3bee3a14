import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import ordered, split


def test_toy_split(toy):
    marked = split.assign_split(toy, "is_fraud", "id", test_size=0.2, valid_size=0.2)
    got = {(r["split"], r.is_fraud): r["count"]
           for r in marked.groupBy("split", "is_fraud").count().collect()}
    assert got == {("train", 0): 3, ("train", 1): 3, ("valid", 0): 1, ("valid", 1): 1,
                   ("test", 0): 1, ("test", 1): 1}


def test_split_is_complete_and_disjoint(toy):
    train, valid, test = split.split_tables(toy, "is_fraud", "id")
    ids = [r.id for f in (train, valid, test) for r in f.select("id").collect()]
    assert sorted(ids) == list(range(10))
    assert train.columns == toy.columns


def test_two_way(toy):
    train, valid, test = split.split_tables(toy, "is_fraud", "id", test_size=0.4, valid_size=0)
    assert valid is None and train.count() == 6 and test.count() == 4


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.range(5000).select(
        "id", (F.col("id") % 173 == 0).cast("int").alias("y")).repartition(6)


def test_independent_of_partitioning(skewed):
    a = split.assign_split(skewed, "y", "id")
    b = split.assign_split(skewed.repartition(3, "id"), "y", "id")
    assert a.exceptAll(b).isEmpty()
    other = split.assign_split(skewed, "y", "id", seed=1)
    assert not a.exceptAll(other).isEmpty()


def test_unequal_sizes_mean_what_they_say(skewed):
    n = {r["split"]: r["count"] for r in split.assign_split(
        skewed, "y", "id", test_size=0.1, valid_size=0.3).groupBy("split").count().collect()}
    assert (n["train"], n["valid"], n["test"]) == (3000, 1500, 500)


def test_split_itself_has_no_shuffle(skewed):
    plan = split.assign_split(skewed, "y", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("counts, size, expected", [
    ({0: 6, 1: 4}, 5, {0: 3, 1: 2}),
    ({0: 5, 1: 5}, 5, {0: 3, 1: 2}),  # the tie goes to the smaller label
    ({"a": 1, "b": 1, "c": 1}, 2, {"a": 1, "b": 1, "c": 0}),
    ({0: 9942, 1: 58}, 2000, {0: 1988, 1: 12}),
])
def test_quotas(counts, size, expected):
    assert split.quotas(counts, size) == expected


def test_refusals(spark, toy):
    one = toy.where("is_fraud = 0 OR id = 1")
    with pytest.raises(ValueError, match="fewer than 2"):
        split.assign_split(one, "is_fraud", "id")
    with pytest.raises(ValueError, match="cannot hold 2 classes"):
        split.assign_split(toy, "is_fraud", "id", test_size=0.1, valid_size=0)
    with pytest.raises(ValueError, match="missing values"):
        split.assign_split(toy.withColumn("is_fraud", F.expr("nullif(is_fraud, 1)")),
                           "is_fraud", "id")
    with pytest.raises(ValueError, match="Unusable split sizes"):
        split.assign_split(toy, "is_fraud", "id", test_size=0.6, valid_size=0.4)


def test_ids_must_tell_rows_apart(toy):
    with pytest.raises(ValueError, match="do not tell the rows apart"):
        split.assign_split(toy, "is_fraud", "city")


def test_many_classes_equal_few(spark):
    df = spark.range(4_000).selectExpr("id", "if(id % 3 = 0, -1, id % 97) AS y")
    few = split.assign_split(df, "y", "id", test_size=0.2, valid_size=0.1)
    many = split.assign_split(df, "y", "id", test_size=0.2, valid_size=0.1, local_classes=5)
    assert sorted(few.collect()) == sorted(many.collect())


def test_typed_labels(spark):
    df = spark.range(400).selectExpr("id", "id % 4 = 0 AS b", "if(id % 4 = 0, 1e7D, 0.1D) AS d", "date_add(date'2020-01-01', cast(id % 2 AS int)) AS t")
    for label in ("b", "d", "t"):
        got = split.assign_split(df, label, "id", test_size=0.25, valid_size=0.0)
        assert got.where("split = 'test'").count() == 100


def test_a_class_that_is_not_there_raises(spark):
    df = spark.range(100).selectExpr("id", "id % 2 AS y")
    with pytest.raises(ValueError, match="fewer rows"):
        ordered.keys_at_ranks(df, "y", ordered.hash_key(1, ["id"]), [(7, 3, 50)])


def test_ids_are_told_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, ""), ("", None)], "p string, q string")
    assert df.select(ordered.hash_key(1, ["p", "q"])).distinct().count() == 4


@pytest.mark.parametrize("n", [3_000, 300_000])
def test_cells_bracket_a_rank_closely(spark, n):
    """Cells ascend with the keys, and the one at the wanted share holds few rows however many there are."""
    rows = spark.range(n).select(ordered.hash_key(4, ["id"]).alias("key"))
    rows = rows.withColumn("c", ordered.cell(F.col("key"), 0.3))
    cells = rows.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy("c").collect()
    assert len(cells) < 1_600 and all(a.hi < b.lo for a, b in zip(cells, cells[1:]))
    before = 0
    for c in cells:
        if before < 0.3 * n <= before + c.n:
            assert c.n <= 4 + n**0.5
        before += c.n
    assert before == n


def test_two_passes_before_the_rows_are_cut(spark, tmp_path, skewed):
    """One over label and id for the counters, one for the keys; cells and keys are small tables."""
    path = str(tmp_path / "t")
    skewed.withColumn("wide", F.lit("x" * 50)).write.parquet(path)
    from ledgerspark.sources import scratch
    written = []
    real = scratch.materialize

    def watched(df, label="table"):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        out = real(df, label)
        written.append((label, path in df._jdf.queryExecution().executedPlan().toString() or path in text, out.count()))
        return out

    with pytest.MonkeyPatch.context() as m:
        m.setattr(split, "materialize", watched)
        marked = split.assign_split(spark.read.parquet(path), "y", "id")
    assert [w[:2] for w in written] == [("cells", True), ("classes", False), ("cells", False), ("cuts", True)]
    assert [w[2] for w in written][1:] == [2, 4, 2] and written[0][2] < 2 * 3_200
    assert marked.count() == 5000


def test_a_large_share_of_rows_in_small_classes(spark):
    """Classes beyond the planned number are cut by keys as well, wherever their rows are."""
    df = spark.range(6_000).selectExpr("id", "if(id % 2 = 0, -1, id % 1500) AS y")
    got = split.assign_split(df, "y", "id", test_size=0.5, valid_size=0.0, local_classes=3)
    n = {(r.y, r["split"]): r["count"] for r in got.groupBy("y", "split").count().collect()}
    assert n[(-1, "test")] == 1500 and all(n[(y, "test")] == 2 for y in range(1, 1500, 2))


def test_a_key_is_hashed_once_for_its_cells(spark):
    """No test for missing cells, which would hash the key anew for each step, stands before the join."""
    df = spark.range(200).select("id", (F.col("id") % 2).alias("label"))
    keyed = df.select("label", ordered.hash_key(1, ["id"]).alias("key"))
    keyed = keyed.select("label", "key", ordered.cell(F.col("key"), 0.3).alias("c0"))
    assert not keyed.schema["c0"].nullable
    wanted = keyed.groupBy("label", "c0").agg(F.lit(0).alias("slot"), F.lit(1).alias("rest"))
    plan = ordered.keys_in_cells(keyed, F.broadcast(wanted), ["label", "c0"])._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter " in line]
    assert filters and not any("md5(" in line for line in filters)
