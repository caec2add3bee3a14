import json

import pytest
from pyspark.sql import functions as F

from ledgerspark.config import RECORD_FIELDS, default_conf, rules_of
from ledgerspark.operators.validate import DataValidationError
from ledgerspark.plans import stages
from ledgerspark.sources import datasets, exports, records, tables
from ledgerspark.sources.scratch import scratch_path

GOOD = {
    "trans_date_trans_time": "2021-07-14 09:15:30", "category": "travel", "amt": 64.25,
    "gender": "F", "city": "Lisbon", "state": "LX", "zip": 20450, "lat": 38.72,
    "long": -9.14, "city_pop": 545000, "job": "Baker", "dob": "1972-11-05",
    "merch_lat": 38.8, "merch_long": -9.3,
}


def write(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_text(text, encoding=encoding)
    return str(path)


def test_bad_paths(spark):
    for path in (None, "", 5):
        with pytest.raises(ValueError, match="must be a text"):
            tables.read_csv(spark, path)
    with pytest.raises(FileNotFoundError, match="no table at /no/such"):
        tables.read_csv(spark, "/no/such/file.csv")


def test_csv_types_gaps_and_extra_columns(spark, tmp_path):
    path = write(tmp_path, "t.csv", ',id,amt,name\n7,4457732997086323466,1.5,"a, ""b"""\n'
                                    "8,12.5,NA,\n9,3,nan,null\n")
    rules = [{"name": "id", "dtype": "int"}, {"name": "amt", "dtype": "float"}]
    df = tables.read_csv(spark, path, rules)
    assert df.columns == ["Unnamed: 0", "id", "amt", "name"]
    assert [tuple(r) for r in df.collect()] == [
        ("7", 4457732997086323466, 1.5, 'a, "b"'), ("8", None, None, None),
        ("9", 3, None, None)]


def test_csv_delimiter_encoding_header(spark, tmp_path):
    path = write(tmp_path, "t.csv", "a;b\nä;1\n", "latin-1")
    row = tables.read_csv(spark, path, delimiter=";", encoding="latin1").first()
    assert tuple(row) == ("ä", "1")
    with pytest.raises(ValueError, match="heading"):
        tables.read_csv(spark, path, header=2)


def test_stage_paths(spark, tmp_path):
    write(tmp_path, "raw.csv", "amt\n1\n")
    conf = default_conf(data_source={"raw_path": "raw.csv"})
    assert tables.read_dataset(spark, conf, "raw", str(tmp_path)).first().amt == 1.0
    with pytest.raises(ValueError, match="no stage called 'other'"):
        tables.read_dataset(spark, conf, "other")
    with pytest.raises(ValueError, match="no path for the stage 'processed'"):
        tables.read_dataset(spark, conf, "processed")


def test_versions(spark):
    root = scratch_path(spark, "d")
    with pytest.raises(FileNotFoundError, match="raw_data"):
        datasets.read_version(spark, root, "raw_data")
    for n in range(11):
        datasets.write_dataset(spark.range(n), root, "raw_data")
    assert datasets.versions(spark, root, "raw_data") == list(range(1, 12))
    assert datasets.read_version(spark, root, "raw_data").count() == 10
    assert datasets.read_version(spark, root, "raw_data", 3).count() == 2


def test_schema_and_sample(spark):
    df = spark.createDataFrame([(3, "c", None), (1, "a", 1.5), (2, "b", 2.5)],
                               "k int, s string, x float")
    rows = exports.schema_export(df, counts=True).collect()
    assert [(r.column, r.dtype, r.n_values) for r in rows] == [
        ("k", "int", 3), ("s", "str", 3), ("x", "float", 2)]
    assert exports.schema_dict(df) == {"k": "int", "s": "str", "x": "float"}
    assert [r.k for r in exports.sample_head(df, 2, "k").collect()] == [1, 2]
    with pytest.raises(ValueError, match="order_by"):
        exports.sample_head(df, 2, None)


@pytest.mark.parametrize("change, reason", [
    ({}, None), ({"amt": "12.5"}, None), ({"zip": "10001"}, None), ({"zip": 10001.0}, None),
    ({"amt": 5}, None), ({"more": 1}, None), ({"job": ""}, None),
    ({"zip": 5.5}, "zip: not int"), ({"city": 5}, "city: not str"),
    ({"amt": None}, "amt: missing"), ({"lat": [1]}, "lat: not float"),
    ({"city_pop": 2**70}, "city_pop: not int"), ({"amt": "much"}, "amt: not float"),
])
def test_record_fields(spark, change, reason):
    df = spark.createDataFrame([(json.dumps({**GOOD, **change}),)], "value string")
    assert records.parse_records(df).first().reason == reason


@pytest.mark.parametrize("text", ["", "{bad", "[1, 2]", "null", "5", '"x"'])
def test_no_record(spark, text):
    df = spark.createDataFrame([(text,)], "value string")
    assert records.parse_records(df).first().reason == "not a JSON object"


def test_all_reasons_are_given(spark):
    short = {k: v for k, v in GOOD.items() if k not in ("amt", "dob")}
    df = spark.createDataFrame([(json.dumps({**short, "zip": "x"}),)], "value string")
    assert records.parse_records(df).first().reason == "amt: missing; zip: not int; dob: missing"


def test_read_records(spark, tmp_path):
    path = write(tmp_path, "r.json", json.dumps(GOOD) + "\n{}\n" + json.dumps(GOOD) + "\n")
    df = records.read_records(spark, path)
    assert df.columns == [n for n, _ in RECORD_FIELDS] and df.count() == 2
    with pytest.raises(records.RecordError, match="missing"):
        records.read_records(spark, path, mode="FAILFAST")


def raw_file(folder):
    names = [r["name"] for r in rules_of(default_conf())]
    rows = []
    for i in range(60):
        rows.append(
            f"2020-01-{i % 28 + 1:02d} 10:00:00,{4000 + i},m,grocery,{i + 0.5},A,B,F,street,city,"
            f"ST,{10000 + i},40.0,-75.0,1000,job,1980-01-01,t{i},{1371816865 + i},39.9,-75.1,"
            f"{int(i % 5 == 0)}")
    return write(folder, "raw.csv", ",".join(names) + "\n" + "\n".join(rows) + "\n")


@pytest.fixture
def job_conf(spark, tmp_path):
    conf = default_conf(
        data_source={"raw_path": raw_file(tmp_path)},
        artifacts={"root": scratch_path(spark, "artifacts")},
        model={"name": "decision_tree", "params": {"max_depth": 3, "random_state": 1}})
    conf["inference"] = {"input_path": conf["data_source"]["raw_path"],
                         "output_path": scratch_path(spark, "out"), "threshold": 0.5}
    return conf


def test_all_stages(spark, job_conf):
    result = stages.run(spark, job_conf, "all")
    assert result.metrics.first().n == 12
    scored = stages.run(spark, job_conf, "infer")
    assert scored.count() == 60
    back = tables.read_csv(spark, job_conf["inference"]["output_path"])
    assert back.columns[-2:] == ["prediction", "prediction_proba"] and back.count() == 60


def test_steps_hand_on_stored_tables(spark, job_conf):
    got = stages.run_steps(spark, job_conf, "trans_num", ["unix_time"])
    assert got["predictions"].count() == 60 and "prediction" in got["predictions"].columns
    assert got["validated"].schema["amt"].dataType.simpleString() == "double"
    root = job_conf["artifacts"]["root"]
    for name in ("raw_data", "validated_data", "engineered_splits", "preprocessed_data",
                 "inference_predictions"):
        assert datasets.versions(spark, root, name) == [1]


def test_stage_names_and_failures(spark, job_conf):
    assert stages.run(spark, job_conf, "load").count() == 60
    assert stages.run(spark, job_conf, "validate").count() == 60
    with pytest.raises(ValueError, match="Unknown stage"):
        stages.run(spark, job_conf, "deploy")
    job_conf["data_validation"]["schema"]["columns"][4]["min"] = 5
    with pytest.raises(DataValidationError, match="below minimum"):
        stages.run(spark, job_conf, "all")
    job_conf["data_validation"]["action_on_error"] = "warn"
    job_conf["data_validation"]["report_path"] = scratch_path(spark, "report")
    report = stages.run(spark, job_conf, "validate")
    broken = report.where("status = 'error'").collect()
    assert [(r["column"], r["check"]) for r in broken] == [("amt", "minimum")]
    assert spark.read.json(job_conf["data_validation"]["report_path"]).count() == report.count()


def test_load_and_profile(spark, job_conf):
    got = stages.load_and_profile(spark, job_conf, order_by="unix_time")
    assert got["sample"].first().trans_num == "t0"
    assert got["shape"].first().n_rows == 60 and got["duplicates"].first().n_duplicates == 0
    assert got["describe"].count() == 22


def test_validate_then_fill(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None)], "k long, s string")
    rules = [{"name": "s", "dtype": "str", "required": False}]
    got = stages.validate_and_fill(df, rules, order_by="k").orderBy("k").collect()
    assert [r.s for r in got] == ["a", "a", "a"]
    rules[0]["required"] = True
    with pytest.raises(DataValidationError):
        stages.validate_and_fill(df, rules, order_by="k")


def test_featurize_and_preprocess(spark, job_conf):
    df = stages.run(spark, job_conf, "load")
    out = stages.featurize(df, job_conf, "trans_num", rows=5)
    assert out.sample.count() == 5 and out.schema["age"] == "int"
    assert datasets.versions(spark, job_conf["artifacts"]["root"], "engineered_data") == [1]
    job_conf["data_split"]["valid_size"] = 0.2
    got = stages.preprocess(out.data, job_conf, "trans_num")
    sizes = {r["split"]: r["count"] for r in got["data"].groupBy("split").count().collect()}
    assert sizes == {"train": 36, "valid": 12, "test": 12}
    assert got["data"].columns[:2] == ["trans_num", "is_fraud"]


def test_records_that_do_not_fit(spark, tmp_path):
    path = write(tmp_path, "t.csv", 'a,b\n1,2\n3,4,5\n6\n7,"x,""y"""\n')
    with pytest.raises(Exception, match="does not fit"):
        tables.read_csv(spark, path).collect()
    with pytest.raises(Exception, match="does not fit"):
        tables.read_csv(spark, path).count()
    good = tables.read_csv(spark, path, on_bad="skip")
    assert [tuple(r) for r in good.collect()] == [("1", "2"), ("6", None), ("7", 'x,"y"')] and good.count() == 3
    assert [r.record for r in tables.rejected_rows(spark, path).collect()] == ["3,4,5"]
    with pytest.raises(ValueError, match="bad records"):
        tables.read_csv(spark, path, on_bad="guess")


def test_line_breaks_in_quotes(spark, tmp_path):
    path = write(tmp_path, "t.csv", 'a,b\n1,"x\ny"\n2, \n')
    with pytest.raises(Exception, match="does not fit"):
        tables.read_csv(spark, path).collect()
    rows = tables.read_csv(spark, path, multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("1", "x\ny"), ("2", " ")]


def test_versions_keep_types(spark, tmp_path):
    t = spark.createDataFrame([("007", 1), ("08", 2), (None, 3)], "code string, n int")
    datasets.write_dataset(t, str(tmp_path / "d"), "x", ["code"])
    back = datasets.read_version(spark, str(tmp_path / "d"), "x")
    assert back.schema == t.schema and sorted(back.collect(), key=str) == sorted(t.collect(), key=str)


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    """Both chose version 1; each table comes back whole, with its own types."""
    root = str(tmp_path / "d")
    one, two = spark.createDataFrame([("007", 1)], "code string, n int"), spark.range(5).selectExpr("id", "id * 0.5D AS x")
    real = datasets._taken
    seen = real(spark, f"{root}/x")
    monkeypatch.setattr(datasets, "_taken", lambda spark, folder: seen)
    first, second = (datasets.write_dataset(t, root, "x") for t in (one, two))
    monkeypatch.setattr(datasets, "_taken", real)
    assert (first, second) == (f"{root}/x/v=1", f"{root}/x/v=2") and datasets.versions(spark, root, "x") == [1, 2]
    for t, v in ((one, 1), (two, 2)):
        back = datasets.read_version(spark, root, "x", v)
        assert back.dtypes == t.dtypes and sorted(back.collect()) == sorted(t.collect())
        assert datasets.manifest(spark, root, "x", v)["rows"] == t.count()


def test_a_writer_that_fails_leaves_no_version(spark, tmp_path):
    root = str(tmp_path / "d")
    broken = spark.range(5).select(F.raise_error(F.lit("stop")).cast("long").alias("n"))
    with pytest.raises(Exception, match="stop"):
        datasets.write_dataset(broken, root, "x")
    assert datasets.versions(spark, root, "x") == []
    datasets.write_dataset(spark.range(2), root, "x")
    assert datasets.read_version(spark, root, "x").count() == 2


def test_profile_parses_text_once(spark, job_conf):
    data = stages.load_and_profile(spark, job_conf)["data"]
    plan = data._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" in plan and "csv" not in plan
