import pytest
from pyspark.errors import PySparkException

from ledgerspark.operators import evaluate


def pairs(spark, labels, predictions, kind="int"):
    return spark.createDataFrame(list(zip(labels, predictions)),
                                 f"label int, prediction {kind}")


def test_mixed(spark):
    got = evaluate.evaluate(pairs(spark, [0, 1, 1, 0, 1, 0], [0, 1, 0, 0, 1, 1]))
    assert round(got["accuracy"], 2) == 0.67
    assert got["confusion_matrix"] == [[2, 1], [1, 2]]
    assert got["auc_roc"] == pytest.approx(2 / 3)


def test_all_wrong(spark):
    got = evaluate.evaluate(pairs(spark, [0, 0, 1, 1], [1, 1, 0, 0]))
    assert [got[k] for k in evaluate.METRICS] == [0, 0, 0, 0, 0]


def test_no_class_labels(spark):
    df = pairs(spark, [0, 1, 1], [0.1, 0.3, 0.9], "double")
    with pytest.raises(ValueError, match="no class"):
        evaluate.evaluate(df)
    with pytest.raises(PySparkException):
        evaluate.metrics(df).collect()


def test_one_class(spark):
    got = evaluate.evaluate(pairs(spark, [0, 0, 0], [0, 0, 0]))
    assert got["accuracy"] == 1 and got["auc_roc"] is None
    assert got["precision"] == got["recall"] == got["f1_score"] == 0


def test_lazy_form_agrees(spark):
    df = pairs(spark, [0, 1, 1, 0, 1, 0], [0, 1, 0, 0, 1, 1])
    row, one = evaluate.metrics(df).first(), evaluate.evaluate(df)
    assert all(row[k] == pytest.approx(one[k]) for k in evaluate.METRICS)


def test_groups(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 0, 0), ("b", 1, 0)],
                               "split string, label int, prediction int")
    rows = {r["split"]: r for r in evaluate.metrics(df, by="split").collect()}
    assert rows["a"].accuracy == 1 and rows["b"].recall == 0 and rows["b"].auc_roc is None


def test_auc_of_probabilities(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "y int, p double")
    assert evaluate.auc_from_probability(df, "y", "p").first()[0] == pytest.approx(0.75)
    tied = spark.createDataFrame([(0, 0.5), (1, 0.5)], "y int, p double")
    assert evaluate.auc_from_probability(tied, "y", "p").first()[0] == pytest.approx(0.5)
    single = df.where("y = 1")
    assert evaluate.auc_from_probability(single, "y", "p").first()[0] is None


def test_listed_metrics(spark):
    table = evaluate.metrics(pairs(spark, [0, 1, 1, 0], [0, 1, 0, 0]))
    assert evaluate.configured_metrics(table, {}) is table
    got = evaluate.configured_metrics(table, {"metrics": ["ROC AUC", "F1 Score", "accuracy", "Accuracy", "f1"]})
    assert got.columns == ["n", "tn", "fp", "fn", "tp", "auc_roc", "f1_score", "accuracy"]
    assert got.first()["accuracy"] == 0.75
    with pytest.raises(ValueError, match="log loss"):
        evaluate.configured_metrics(table, {"metrics": ["log loss"]})
