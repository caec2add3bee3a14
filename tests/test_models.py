import pytest
from pyspark.errors import StreamingQueryException
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ledgerspark import testbed
from ledgerspark.config import DECISION_TREE_PARAMS, RANDOM_FOREST_PARAMS, default_conf
from ledgerspark.operators import models, prep, tune
from ledgerspark.plans import train as training
from ledgerspark.plans.score import score, score_path
from ledgerspark.sources import artifacts, datasets, records, tables
from ledgerspark.sources.scratch import scratch_path
from ledgerspark.streaming import scoring as streaming
from ledgerspark.streaming.scoring import start_scoring


def tree_conf(valid=0.2, **more):
    return default_conf(
        data_split={"test_size": 0.2, "valid_size": valid, "random_state": 42},
        model={"name": "decision_tree", "params": dict(DECISION_TREE_PARAMS),
               "bayesian_optimization": {"enabled": False}}, **more)


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return testbed.records(spark, sf_dir).cache()


@pytest.fixture(scope="module")
def trained(table):
    return training.train(table, tree_conf(), "row_id")


def test_registry_holds_callables():
    assert set(models.MODEL_REGISTRY) == {"decision_tree", "random_forest", "xgboost"}
    assert all(callable(c) for c in models.MODEL_REGISTRY.values())


def test_unknown_model(spark):
    with pytest.raises(ValueError, match="No learner is called 'svm'"):
        models.train_model(spark.range(1), "svm", {}, label="id")


def test_parameter_names():
    got = models.spark_params("xgboost", default_conf()["model"]["params"])
    assert got == {"maxDepth": 6, "stepSize": 0.1, "maxIter": 200, "subsamplingRate": 0.8,
                   "featureSubsetStrategy": "0.8", "minInfoGain": 0.0, "seed": 42}
    assert models.spark_params("random_forest", RANDOM_FOREST_PARAMS)["numTrees"] == 100
    assert models.spark_params("random_forest", {"colsample_bytree": 1.0}) == {
        "featureSubsetStrategy": "all"}


def test_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    rows = {r.label: r.weight for r in models.class_weights(df, "y").collect()}
    assert rows == pytest.approx({0: 8 / 12, 1: 2.0})
    column = models.weight_column(df, "y", {"class_weight": "balanced", "scale_pos_weight": 10})
    got = {r.y: r.w for r in df.select("y", column.alias("w")).distinct().collect()}
    assert got == pytest.approx({0: 8 / 12, 1: 20.0})
    assert models.weight_column(df, "y", {}) is None


def test_toy_training(toy):
    conf = tree_conf(preprocessing={"numeric": ["amt", "city_pop"], "label_encode": []})
    result = training.train(toy, conf, "id")
    assert result.splits.count() == 10
    assert {r["split"]: r.n for r in result.metrics.collect()} == {"valid": 2, "test": 2}


def test_quality_and_determinism(trained, table):
    rows = {r["split"]: r for r in trained.metrics.collect()}
    assert set(rows) == {"valid", "test"}
    assert all(r.accuracy > 0.8 and r.recall > 0.2 for r in rows.values())
    again = training.train(table, tree_conf(), "row_id").metrics.collect()
    assert sorted(again) == sorted(rows.values())


@pytest.mark.parametrize("kind, params", [
    ("random_forest", {**RANDOM_FOREST_PARAMS, "n_estimators": 5}),
    ("xgboost", {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3,
                 "scale_pos_weight": 10, "random_state": 1}),
])
def test_other_learners(table, kind, params):
    conf = tree_conf()
    conf["model"].update(name=kind, params=params)
    result = training.train(table, conf, "row_id")
    scored = score(table, conf, result.model)
    row = scored.agg(F.min("prediction_proba"), F.max("prediction_proba"),
                     F.count("prediction")).first()
    assert 0 <= row[0] <= row[1] <= 1 and row[2] == 1000


def test_score_keeps_the_input(trained, table):
    scored = score(table, tree_conf(), trained.model)
    assert scored.columns == [*table.columns, "prediction", "prediction_proba"]
    assert scored.select(*table.columns).exceptAll(table).isEmpty()
    assert scored.schema["trans_date_trans_time"].dataType.simpleString() == "string"
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_scoring_again_replaces_the_results(trained, table):
    once = score(table, tree_conf(), trained.model)
    assert score(once, tree_conf(), trained.model).columns == once.columns


def test_score_without_probabilities(trained, table):
    class Plain:
        def hasParam(self, name):
            return False

        def transform(self, df):
            return df.withColumn("prediction", F.lit(1.0))

    model = artifacts.ScoringModel(trained.model.prep, trained.model.features, Plain(), "x", {})
    scored = score(table, tree_conf(), model)
    assert scored.columns[-1] == "prediction" and "prediction_proba" not in scored.columns


def test_score_names_missing_columns(trained, table):
    with pytest.raises(ValueError, match=r"required but absent: \['zip'\]"):
        score(table.drop("zip"), tree_conf(), trained.model)


def test_threshold(table):
    conf = tree_conf(inference={"threshold": 0.9})
    result = training.train(table, conf, "row_id")
    scored = score(table, conf, result.model)
    assert scored.where(
        F.col("prediction") != (F.col("prediction_proba") > 0.9).cast("int")).isEmpty()


def test_save_and_load(spark, trained, table):
    path = scratch_path(spark, "model")
    conf = tree_conf(artifacts={"model_path": path})
    trained.model.save(spark, path)
    a = score(table, conf, trained.model)
    assert a.exceptAll(score(table, conf)).isEmpty()
    with pytest.raises(FileNotFoundError, match="no preprocessing pipeline at"):
        artifacts.load_model(spark, path + "-absent")
    artifacts.save_prep(spark, trained.model.prep, path + "-prep")
    assert artifacts.load_prep(spark, path + "-prep") == trained.model.prep


def test_artifact_root(spark, toy):
    root = scratch_path(spark, "root")
    conf = tree_conf(preprocessing={"numeric": ["amt"], "label_encode": []},
                     artifacts={"root": root})
    training.train(toy, conf, "id")
    stored = datasets.read_version(spark, root, "preprocessed_data")
    assert stored.count() == 10 and set(stored.columns) == {"id", "is_fraud", "split", "amt"}
    assert score(toy, conf).count() == 10


def test_search(spark, table):
    vectors = prep.TabularPrep(["amt", "lat"]).fit(table).append_vector(table, "features")
    vectors = vectors.select("features", "is_fraud").cache()
    search = {"init_points": 1, "n_iter": 2, "random_state": 3,
              "search_space": {"max_depth": [1, 4], "gamma": [0, 0.1]}}
    found = tune.random_search(vectors, vectors, "decision_tree", {"class_weight": "balanced"},
                               search, label="is_fraud")
    trials = found.trials.collect()
    assert len(trials) == 3 and isinstance(found.best["max_depth"], int)
    assert 0 < found.best["gamma"] < 0.1
    best = max(t.recall for t in trials)
    first = min(t.trial for t in trials if t.recall == best)
    assert tune.draw_trials(search["search_space"], 3, 3)[first] == found.best


def test_halving_goes_on_with_the_best(spark, table):
    rows = prep.TabularPrep(["amt", "lat"]).fit(table).append_vector(table, "features")
    rows = rows.select("features", "is_fraud", F.col("row_id").alias("row")).cache()
    search = {"init_points": 3, "n_iter": 6, "random_state": 3, "search_space": {"max_depth": [1, 5]}}
    found = tune.halving_search(rows, rows, "random_forest", {"n_estimators": 9, "random_state": 1}, search,
                                label="is_fraud", id_col="row")
    turns = {}
    for r in found.trials.orderBy("rung", "trial").collect():
        turns.setdefault(r.rung, []).append(r)
    assert [len(t) for t in turns.values()] == [9, 3, 1]
    assert [t[0].share for t in turns.values()] == pytest.approx([1 / 9, 1 / 3, 1])
    for rung in (0, 1):
        best = sorted(turns[rung], key=lambda r: (-r.recall, r.trial))[:len(turns[rung + 1])]
        assert sorted(r.trial for r in best) == [r.trial for r in turns[rung + 1]]
    assert tune.draw_trials(search["search_space"], 9, 3)[turns[2][0].trial] == found.best
    assert [tune._with_trees({"n_estimators": 9}, s)["n_estimators"] for s in (1 / 9, 0.5, 1)] == [1, 5, 9]


def test_search_runs_only_with_validation_rows(toy):
    search = {"enabled": True, "init_points": 1, "n_iter": 0, "random_state": 1,
              "search_space": {"max_depth": [2, 3]}}
    for valid, ran in ((0.2, True), (0.0, False)):
        conf = tree_conf(valid, preprocessing={"numeric": ["amt"], "label_encode": []})
        conf["model"]["bayesian_optimization"] = search
        assert (training.train(toy, conf, "id").trials is not None) is ran


def test_evaluate_saved(trained):
    row = training.evaluate_saved(
        trained.splits.where("split = 'test'"), trained.model, tree_conf()).first()
    expected = trained.metrics.where("split = 'test'").first()
    assert row.accuracy == expected.accuracy and 0.5 < row.auc_roc_proba <= 1


def test_score_file(spark, trained, table):
    source, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    tables.write_table(table, source, "csv")
    conf = tree_conf()
    conf["data_validation"]["schema"]["columns"] += [{"name": "row_id", "dtype": "int"}]
    score_path(spark, source, out, conf, trained.model)
    back = tables.read_csv(spark, out, [{"name": "row_id", "dtype": "int"},
                                        {"name": "prediction", "dtype": "int"}])
    direct = score(table, conf, trained.model).select("row_id", "prediction")
    assert back.select("row_id", "prediction").exceptAll(
        direct.withColumn("prediction", F.col("prediction").cast("long"))).isEmpty()
    assert back.count() == 1000


def test_stream_equals_table(spark, sf_dir, trained, monkeypatch):
    lines = testbed.json_lines(spark, sf_dir).select("value")
    folder, out = scratch_path(spark, "json"), scratch_path(spark, "out")
    lines.repartition(3).write.text(folder)

    def run():
        start_scoring(spark, folder, out + "/scored", out + "/checkpoint", tree_conf(),
                      trained.model, rejected=out + "/rejected").awaitTermination()

    def fail(*_):
        raise OSError("no space")

    with monkeypatch.context() as m:
        m.setattr(streaming, "rejected_records", fail)  # after the scored half was written
        with pytest.raises(StreamingQueryException):
            run()
    run()  # replays that batch
    run()  # finds nothing new
    streamed = spark.read.parquet(out + "/scored")
    assert [r.batch for r in streamed.select("batch").distinct().collect()] == [0]
    streamed = streamed.drop("source_file", "batch")
    batch = score(records.read_records(spark, folder), tree_conf(), trained.model)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()
    assert spark.read.parquet(out + "/rejected").count() == 1000 - batch.count()


def test_the_block_of_the_named_model_goes_first():
    shared = {"name": "decision_tree", "params": {"max_depth": 6}, "bayesian_optimization": {"enabled": False}}
    assert training.model_settings({"model": shared}) == shared
    own = {**shared, "decision_tree": {"params": {"max_depth": 2}, "save_path": "there"}, "xgboost": {"params": {"gamma": 1}}}
    got = training.model_settings({"model": own})
    assert (got["params"], got["save_path"], got["bayesian_optimization"]) == ({"max_depth": 2}, "there", {"enabled": False})


def test_training_by_the_block_of_a_model(toy, spark):
    path = scratch_path(spark, "own-model")
    conf = default_conf(
        metrics=["Recall"], data_split={"test_size": 0.4, "valid_size": 0.0, "random_state": 1},
        preprocessing={"numeric": ["amt"], "categorical": [], "label_encode": []},
        model={"name": "decision_tree", "params": {"max_depth": 9},
               "decision_tree": {"params": {"max_depth": 1, "random_state": 3}, "save_path": path}})
    result = training.train(toy, conf, "id")
    assert result.metrics.columns == ["split", "n", "tn", "fp", "fn", "tp", "recall"]
    assert result.model.params == {"max_depth": 1, "random_state": 3}
    assert artifacts.load_model(spark, path).classifier.depth <= 1


def test_boosting_spreads_its_rows_and_keeps_no_node_ids(spark, monkeypatch):
    seen = {}

    class Recorder:
        def __init__(self, **settings):
            seen.update(settings)

        def fit(self, df):
            seen.update(parts=df.rdd.getNumPartitions(), rows=df.count())

    monkeypatch.setitem(models.MODEL_REGISTRY, "xgboost", Recorder)
    monkeypatch.setattr(models, "TASK_ROWS", 100)
    df = spark.range(0, 350, numPartitions=1).selectExpr("id % 2 AS label", "id AS features")
    models.train_model(df, "xgboost", {"n_estimators": 2}, label="label")
    assert seen["parts"] == 4 and seen["rows"] == 350 and seen["cacheNodeIds"] is False
    models.train_model(df.limit(90), "xgboost", {"n_estimators": 2}, label="label")
    assert seen["parts"] == 1 and seen["rows"] == 90


def test_records_lie_over_all_cores(spark, tmp_path):
    """One row group in a file of several splits is one task's work, however many tasks there are."""
    n = 3 * models.TASK_ROWS
    spark.range(n, numPartitions=1).selectExpr(
        "id AS event_id", "id % 1500 AS user_id", "if(id % 3 = 0, 'view', 'error') AS event_type", "CAST(id % 400 AS DOUBLE) AS value",
        "timestamp_seconds(1700000000 + id) AS ts", "'x' AS props").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    got = testbed.records(spark, str(tmp_path))
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n and max(sizes) < n * 0.6
    plain = testbed.txn(spark, str(tmp_path)).select("row_id", "amt", "dob")
    assert plain.exceptAll(got.select("row_id", "amt", "dob")).count() == 0 and got.select("row_id").distinct().count() == n


def test_a_search_counts_the_classes_once(spark, monkeypatch):
    counted, plain = [], tune.class_counts
    monkeypatch.setattr(tune, "class_counts", lambda *a: counted.append(1) or plain(*a))
    monkeypatch.setattr(models, "class_counts", lambda *a: counted.append(1) or plain(*a))
    rows = [(Vectors.dense([float(i % 17), float(i % 5)]), int(i % 17 > 12)) for i in range(400)]
    df = spark.createDataFrame(rows, ["features", "y"])
    search = {"init_points": 2, "n_iter": 2, "random_state": 1, "search_space": {"max_depth": [2, 5]}}
    found = tune.random_search(df, df, "decision_tree", {"class_weight": "balanced", "random_state": 1}, search, label="y")
    assert len(counted) == 1 and found.trials.agg(F.max("recall")).first()[0] == 1.0
