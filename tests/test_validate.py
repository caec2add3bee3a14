import pytest

from ledgerspark.config import TXN_COLUMNS, default_conf, rules_of
from ledgerspark.operators.validate import (
    DataValidationError,
    validate_schema,
    validation_report,
    violating_rows,
)
from ledgerspark.schema import TXN_SCHEMA, struct_of

ROW = ("2021-03-09", 9876501234, "corner shop", "food", 17.5, "Ada", "Moreau", "F",
       "7 Mill Lane", "Bristol", "BS", 40211, 51.45, -2.59, 463000, "Surveyor",
       "1969-08-21", "tx-0007", 1615248000, 51.5, -2.6, 0)


def changed(spark, **values):
    names = TXN_SCHEMA.names
    row = [values.get(n, v) for n, v in zip(names, ROW)]
    return spark.createDataFrame([tuple(row)], TXN_SCHEMA)


def rules(**changes):
    out = rules_of(default_conf())
    for r in out:
        r.update(changes.get(r["name"], {}))
    return out


def test_valid_row_passes(spark):
    validate_schema(changed(spark), rules())


def test_declared_schema():
    assert struct_of(rules()) == TXN_SCHEMA
    assert len(TXN_COLUMNS) == 22


def test_missing_required_column(spark):
    with pytest.raises(DataValidationError, match="Missing required column: cc_num"):
        validate_schema(changed(spark).drop("cc_num"), rules())


def test_missing_value_in_required_column(spark):
    with pytest.raises(DataValidationError, match=r"has 1 missing values \(required\)"):
        validate_schema(changed(spark, amt=None), rules())


def test_nan_is_missing(spark):
    with pytest.raises(DataValidationError, match=r"has 1 missing values \(required\)"):
        validate_schema(changed(spark, amt=float("nan")), rules())


@pytest.mark.parametrize("dtype, good, bad", [
    ("int", "10", "'string'"), ("float", "10.0D", "'string'"), ("str", "'text'", "123"),
    ("int", "true", "1.5D"), ("float", "cast(1 as float)", "1"),
])
def test_types(spark, dtype, good, bad):
    extra = [{"name": "test_col", "dtype": dtype, "required": True}]
    df = changed(spark)
    with pytest.raises(DataValidationError, match="incorrect type"):
        validate_schema(df.selectExpr("*", f"{bad} AS test_col"), rules() + extra)
    validate_schema(df.selectExpr("*", f"{good} AS test_col"), rules() + extra)


def test_column_without_values_passes_as_any_type(spark):
    extra = [{"name": "test_col", "dtype": "int", "required": False}]
    df = changed(spark).selectExpr("*", "cast(NULL AS double) AS test_col")
    validate_schema(df, rules() + extra)


def test_unknown_type_name_is_ignored(spark):
    validate_schema(changed(spark), [{"name": "amt", "dtype": "money", "required": True}])


@pytest.mark.parametrize("values, fails", [
    (["M", "F", "X"], True), (["M", "F"], False), (["M", None], True)])
def test_allowed_values(spark, values, fails):
    df = spark.createDataFrame([(v,) for v in values], "gender string")
    rule = [{"name": "gender", "dtype": "str", "allowed_values": ["M", "F"]}]
    if fails:
        with pytest.raises(DataValidationError, match="outside of allowed set"):
            validate_schema(df, rule)
    else:
        validate_schema(df, rule)


def test_empty_allowed_list_means_no_check(spark):
    validate_schema(changed(spark), [{"name": "gender", "allowed_values": []}])


@pytest.mark.parametrize("amt, fails", [(0.0, False), (-0.01, True)])
def test_minimum(spark, amt, fails):
    df, low = changed(spark, amt=amt), rules(amt={"min": 0})
    if fails:
        with pytest.raises(DataValidationError, match="below minimum of 0"):
            validate_schema(df, low)
    else:
        validate_schema(df, low)


def test_no_rules(spark):
    validate_schema(changed(spark), [])
    assert validation_report(changed(spark), []).count() == 0


def test_empty_table(spark):
    with pytest.raises(DataValidationError, match="Missing required column"):
        validate_schema(spark.createDataFrame([], "x int"), rules())


def test_only_the_first_violation_raises(spark):
    df = changed(spark, amt=-10.0).drop("cc_num")
    with pytest.raises(DataValidationError, match="Missing required column: cc_num"):
        validate_schema(df, rules(amt={"min": 0}))
    with pytest.raises(DataValidationError, match="has 1 missing values"):
        validate_schema(changed(spark, cc_num=None, amt=-10.0).drop("is_fraud"),
                        rules(amt={"min": 0}))


def test_optional_gap_only_warns(spark):
    validate_schema(changed(spark, job=None), rules(job={"required": False}))
    report = validation_report(changed(spark, job=None), rules(job={"required": False}))
    assert report.where("status = 'warning'").first().column == "job"


def test_text_types(spark):
    df = spark.createDataFrame(
        [("1", "2"), ("1.5", "x"), (None, "nan"), ("+7", "1e3"), ("99999999999999999999", "")],
        "i string, f string")
    got = {(r.column, r.check): r.violations for r in validation_report(
        df, [{"name": "i", "dtype": "int"}, {"name": "f", "dtype": "float"}], text=True).collect()}
    assert got["i", "type"] == 2 and got["i", "missing"] == 1
    assert got["f", "type"] == 2


def test_violating_rows(spark):
    df = spark.createDataFrame([(1, 5.0), (None, -1.0), (3, 0.0)], "k int, v double")
    rule = [{"name": "k", "dtype": "int", "required": True},
            {"name": "v", "dtype": "float", "min": 0}]
    rows = violating_rows(df, rule).collect()
    assert [r.violations for r in rows] == ["k:missing,v:minimum"]


def test_minimum_of_text_is_refused(spark):
    with pytest.raises(TypeError):
        validate_schema(changed(spark), [{"name": "city", "dtype": "str", "min": 1}])


def test_report_is_one_aggregation(spark):
    plan = validation_report(changed(spark), rules())._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange") == 1
