import datetime
import math

import pytest
from pyspark.sql import functions as F

from ledgerspark.config import default_conf
from ledgerspark.operators import prep, project


def frame(spark):
    return spark.createDataFrame(
        [(1.0, 10, "b", "x"), (2.0, 10, "a", "x"), (None, 10, "b", "y"), (4.0, 10, "c", "x"),
         (5.0, 10, None, None)],
        "num1 double, num2 long, g string, pass string")


@pytest.mark.parametrize("limit", [100, 2])
def test_label_encode(spark, limit):
    df = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3), ("C", 4), (None, 5)],
                               "category string, value long")
    got = prep.label_encode(df, ["category", "absent"], local_limit=limit)
    assert got.columns == ["category", "value"]
    assert {(r.category, r.value) for r in got.collect()} == {
        (0, 1), (1, 2), (0, 3), (2, 4), (None, 5)}


def test_label_encode_many_values_with_a_hot_one(spark):
    df = spark.range(4000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 17 % 1009).alias("v"))
    got = prep.label_encode(df, ["v"], local_limit=50, ranges=8)
    order = {v: i for i, v in enumerate(sorted({r.v for r in df.collect()}))}
    expected = {(r.id, order[r.v]) for r in df.collect()}
    assert {(r.id, r.v) for r in got.collect()} == expected


def test_scaling_of_its_own_per_column(spark):
    df = frame(spark)
    conf = {"preprocessing": {"numeric": ["num1", "num2"], "num1": {"normalization": "minmax"}, "num2": {"other": 1}}}
    model = prep.TabularPrep.from_conf(conf).fit(df)
    assert (model.scaling, model.scalings) == ("standard", {"num1": "minmax"})
    again = prep.TabularPrepModel.from_json(model.to_json())
    assert [tuple(r) for r in again.transform(df).collect()] == [(0.0, 0.0), (0.25, 0.0), (0.5, 0.0), (0.75, 0.0), (1.0, 0.0)]
    assert [r.num1 for r in prep.scale(df, ["num1"], own={"num1": "none"}).collect()] == [1.0, 2.0, 3.0, 4.0, 5.0]
    with pytest.raises(ValueError, match="Unknown scaling: log"):
        prep.TabularPrep(["num1"], scalings={"num1": "log"}).fit(df)


def test_a_model_saved_without_scalings_still_loads():
    old = '{"numeric": {}, "categorical": {}, "scaling": "minmax"}'
    assert prep.TabularPrepModel.from_json(old).scalings == {}


def test_mean_impute_and_population_scale(spark):
    df = frame(spark)
    got = [r.num1 for r in prep.impute_mean(df, ["num1"]).collect()]
    assert got == [1.0, 2.0, 3.0, 4.0, 5.0]
    scaled = [r.num1 for r in prep.scale(df, ["num1"]).collect()]
    assert scaled == pytest.approx([x / math.sqrt(2) for x in (-2, -1, 0, 1, 2)])
    row = prep.scale(df, ["num1"]).agg(F.avg("num1"), F.stddev_pop("num1")).first()
    assert tuple(row) == pytest.approx((0, 1), abs=1e-12)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(0.1,)] * 10, "x double")
    assert {r.x for r in prep.scale(df, ["x"]).collect()} == {0.0}
    assert {r.x for r in prep.scale(df, ["x"], "minmax").collect()} == {0.0}


def test_routing_drops_the_rest(spark):
    model = prep.TabularPrep(numeric=["num1"]).fit(frame(spark))
    out = model.transform(frame(spark))
    assert out.columns == ["num1"] == model.output_names and out.count() == 5


def test_onehot_names_modes_and_strangers(spark):
    model = prep.TabularPrep(categorical=["g"]).fit(frame(spark))
    assert model.output_names == ["g_a", "g_b", "g_c"]
    new = spark.createDataFrame([("a",), ("zzz",), (None,)], "g string")
    assert [tuple(r) for r in model.transform(new).collect()] == [
        (1, 0, 0), (0, 0, 0), (0, 1, 0)]


def test_mode_tie_goes_to_the_smaller(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "g string")
    assert prep.TabularPrep(categorical=["g"]).fit(df).categorical["g"].mode == "a"


def test_both_branches(spark):
    df = spark.createDataFrame([("A", 1.0)], "category string, num1 double")
    model = prep.TabularPrep(["num1"], ["category"]).fit(df)
    assert model.output_names == ["num1", "category_A"]
    assert tuple(model.transform(df).first()) == (0.0, 1.0)


def test_fit_on_train_only(spark):
    train = spark.createDataFrame([(0.0,), (2.0,)], "x double")
    other = spark.createDataFrame([(10.0,), (None,)], "x double")
    conf = {"preprocessing": {"numeric": ["x"]}}
    fitted, applied, none, model = prep.fit_apply(train, [other, None], conf)
    assert [r.x for r in applied.collect()] == [9.0, 0.0] and none is None
    assert model.numeric["x"].mean == 1.0


def test_column_without_values_is_refused(spark):
    df = spark.createDataFrame([(None, None)], "x double, g string")
    with pytest.raises(ValueError, match="no value to fit on"):
        prep.TabularPrep(numeric=["x"]).fit(df)
    with pytest.raises(ValueError, match="no value to fit on"):
        prep.TabularPrep(categorical=["g"]).fit(df)


def test_missing_columns_are_named(spark):
    model = prep.TabularPrep(numeric=["num1"]).fit(frame(spark))
    with pytest.raises(ValueError, match="num1"):
        model.transform(frame(spark).drop("num1"))


def test_statistics_survive_json(spark):
    model = prep.TabularPrep(["num1"], ["g"]).fit(frame(spark))
    assert prep.TabularPrepModel.from_json(model.to_json()) == model


def test_vector_keeps_the_row(spark):
    model = prep.TabularPrep(["num1", "num2"], ["g"]).fit(frame(spark))
    out = model.append_vector(frame(spark), "features", ["g_b", "num1"])
    assert out.columns == [*frame(spark).columns, "features"]
    assert list(out.first().features) == pytest.approx([1.0, -math.sqrt(2)])


def test_preprocess_table(toy):
    conf = default_conf(preprocessing={"label_encode": ["category", "gender"],
                                       "numeric": ["amt", "city_pop", "category"]})
    table, model = prep.preprocess(toy, conf, keep=["id"])
    assert table.columns == ["id", "is_fraud", "amt", "city_pop", "category"]
    assert {r.city_pop for r in table.collect()} == {0.0}


def test_column_choices(toy):
    conf = default_conf()
    assert project.drop_target(toy.drop("is_fraud"), "is_fraud").columns == \
        toy.drop("is_fraud").columns
    assert project.input_features(["gender", "amt", "x"], conf) == ["amt", "gender"]
    assert project.input_features(["x", "y"], conf) == ["x", "y"]
    with pytest.raises(ValueError, match="No configured input feature"):
        project.input_features(["x"], conf, on_empty="error")
    with pytest.raises(ValueError, match=r"required but absent: \['zip'\]"):
        project.select_raw_features(toy.drop("zip"), conf)
    assert "zip" not in project.select_raw_features(toy.drop("zip"), conf, strict=False).columns
    renamed = project.rename_columns(toy, {"preprocessing": {"rename_columns": {"dob": "born"}}})
    assert "born" in renamed.columns


def test_encoded_frame_reads_its_source_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(500).selectExpr("id", "id % 90 AS a", "cast(id % 70 AS string) AS b", "id / 7.0D AS c").write.parquet(path)
    t = spark.read.parquet(path)
    out = prep.label_encode(t, ["a", "b", "c"], local_limit=10)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert sum("parquet" in line and "id#" in line for line in plan.splitlines()) == 1
    for r in out.join(t.select("id", F.col("a").alias("x"), F.col("b").alias("y")), "id").collect():
        assert r.a == r.x and r.b == sorted(map(str, range(70))).index(r.y) and r.c == r.id


def test_mode_of_many_values(spark):
    t = spark.range(12_000).selectExpr("if(id < 2, 'zz', concat('v', id)) AS v").union(spark.range(3).selectExpr("cast(null AS string)"))
    assert prep.impute_mode(t, ["v"]).where("v = 'zz'").count() == 5


def test_too_many_named_categories_blame_their_column(spark):
    t = spark.range(6_000).selectExpr("'x' AS a", "cast(id AS string) AS b")
    with pytest.raises(ValueError, match="'b'"):
        prep.TabularPrep(categorical=["a", "b"]).fit(t)
    hot = prep.onehot_sparse(t, ["b"]).first()["b_onehot"]
    assert hot.size == 6_000 and hot.values.tolist() == [1.0]


def test_names_that_differ_by_case(spark):
    t = spark.createDataFrame([("x", 0), ("X", 1), ("x", 1)], "g string, y int")
    conf = {"target": "y", "preprocessing": {"categorical": ["g"]}, "features": {"engineered": []}}
    table, model = prep.preprocess(t, conf)
    assert model.output_names == ["g_X", "g_x_2"]
    assert sorted(map(tuple, table.collect())) == [(0, 0.0, 1.0), (1, 0.0, 1.0), (1, 1.0, 0.0)]


def test_places_of_ones_are_read_from_sparse_vectors(spark, tmp_path):
    """onehot_sparse on many cards: the place of a value is found without a vector of all places."""
    import __spark_entry__ as entry

    users = [(7 * i) % 400 for i in range(600)]
    rows = [(i, datetime.datetime(2024, 1, 1), u, "view", 1.0, "{}") for i, u in enumerate(users)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).write.parquet(f"{tmp_path}/events.parquet")
    out = entry.onehot_sparse(spark, str(tmp_path))
    places = {u: i for i, u in enumerate(sorted({str(u) for u in users}))}
    assert {r.row_id: r.card_at for r in out.collect()} == {i: places[str(u)] for i, u in enumerate(users)}
    assert dict(out.dtypes)["card_at"] == "bigint"
    assert "array_position" not in out._jdf.queryExecution().optimizedPlan().toString()
