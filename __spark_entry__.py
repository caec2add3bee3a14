"""

``queries()`` maps a name to ``(spark, sf_dir) -> DataFrame`` and ``oracle_sql()``
gives the same result as SQL where SQL can say it.  Every query reads whole
tables; the SQL lives in ``ledgerspark/oracles.py``.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark import oracles, testbed
from ledgerspark.config import default_conf
from ledgerspark.functions.calendar import parse_time
from ledgerspark.operators import (
    dictionary,
    evaluate,
    features,
    fill,
    models,
    prep,
    profile,
    project,
    split,
    tune,
    validate,
)
from ledgerspark.plans import score as scoring
from ledgerspark.plans import stages
from ledgerspark.plans import train as training
from ledgerspark.schema import RECORD_SCHEMA
from ledgerspark.sources import artifacts, datasets, exports, records, tables
from ledgerspark.sources.scratch import materialize, scratch_path
from ledgerspark.sources.small import small_table
from ledgerspark.streaming import scoring as streaming

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

RULES = [
    {"name": "cc_num", "dtype": "int", "required": True, "min": 5},
    {"name": "category", "dtype": "str", "required": True,
     "allowed_values": ["view", "click", "purchase", "signup"]},
    {"name": "amt", "dtype": "float", "required": True, "min": 1},
    {"name": "job", "dtype": "str", "required": True,
     "allowed_values": ["job_0", "job_1", "job_2", "job_3"]},
    {"name": "city_pop", "dtype": "int", "required": False, "min": 5000},
    {"name": "gender", "dtype": "int", "required": False},
    {"name": "nickname", "dtype": "str", "required": False},
    {"name": "street", "dtype": "str", "required": True},
]
RECORD_RULES = [{"name": n, "dtype": t, "required": True}
                for n, t in zip(RECORD_SCHEMA.names, (
                    {"bigint": "int", "double": "float", "string": "str"}[f.dataType.simpleString()]
                    for f in RECORD_SCHEMA))]
PREP_CONF = default_conf(
    preprocessing={"numeric": ["amt", "city_pop", "lat"], "categorical": ["job", "gender"],
                   "label_encode": ["category"]})
LINE_ID = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def r(c: Column | str, digits: int = 4) -> Column:
    name = c if isinstance(c, str) else None
    rounded = F.round(F.col(c) if name else c, digits)
    return rounded.alias(name) if name else rounded


def big(name: str) -> Column:
    return F.col(name).cast("long").alias(name)


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.table(spark, sf_dir, "lineitem")


# ------------------------------------------------------------------ features

TIME_COLUMNS = ["hour", "day", "month", "day_of_week", "is_weekend"]


@query
def feat_time(spark, d):
    t = features.add_time_features(testbed.txn(spark, d))
    return t.select("row_id", *map(big, TIME_COLUMNS))


@query
def feat_age(spark, d):
    return features.add_age(testbed.txn(spark, d)).select("row_id", big("age"))


@query
def feat_geo_distance(spark, d):
    return features.add_distance(testbed.txn(spark, d)).select("row_id", r("geo_distance"))


@query
def feat_geo_bad_input(spark, d):
    """Text that is no number, gaps and latitudes beyond 90 degrees give 0.0."""
    t = testbed.txn(spark, d)
    i = F.col("row_id")
    t = t.withColumns({
        "lat": F.when(i % 5 == 0, "north").otherwise(F.col("lat").cast("string")),
        "merch_lat": F.when(i % 7 == 0, F.lit(91.0)).otherwise(F.col("merch_lat")),
        "long": F.when(i % 11 == 0, F.lit(float("nan"))).when(i % 13 == 0, F.lit(None))
        .otherwise(F.col("long") + 360),
    })
    return features.add_distance(t).select("row_id", r("geo_distance"))


@query
def feat_all(spark, d):
    t = features.add_features(testbed.txn(spark, d))
    return t.select("row_id", "amt", *map(big, TIME_COLUMNS), big("age"), r("geo_distance"))


@query
def feat_splits(spark, d):
    """The same features derived for each split on its own."""
    parts = split.split_tables(testbed.txn(spark, d), "is_fraud", "row_id")
    done = features.add_features_to_splits(*parts)
    t = done[0].unionByName(done[1]).unionByName(done[2])
    return t.select("row_id", "amt", *map(big, TIME_COLUMNS), big("age"), r("geo_distance"))


@query
def featurize_table(spark, d):
    """The stored table of the feature step."""
    out = stages.featurize(testbed.records(spark, d), default_conf(), "row_id")
    return out.data.select("row_id", "amt", *map(big, TIME_COLUMNS), big("age"),
                           r("geo_distance"))


@query
def parse_layouts(spark, d):
    """Year-first, month-first, month-first without a time, and text that is no time."""
    text = """CASE row_id % 4
        WHEN 0 THEN left(CAST(trans_date_trans_time AS STRING), 19)
        WHEN 1 THEN concat(month(trans_date_trans_time), '/', day(trans_date_trans_time), '/',
            year(trans_date_trans_time), ' ', hour(trans_date_trans_time), ':',
            lpad(CAST(minute(trans_date_trans_time) AS STRING), 2, '0'))
        WHEN 2 THEN concat(month(trans_date_trans_time), '/', day(trans_date_trans_time), '/',
            year(trans_date_trans_time))
        ELSE 'soon' END AS text"""
    df = testbed.txn(spark, d).selectExpr("row_id", text)
    parsed = df.withColumn("at", parse_time(df, "text", on_error="null"))
    return parsed.select("row_id", F.left(F.col("at").cast("string"), F.lit(19)).alias("at"))


# ------------------------------------------------------------------- profile

@query
def profile_shape(spark, d):
    return profile.shape(testbed.txn(spark, d))


@query
def profile_duplicates(spark, d):
    t = testbed.txn(spark, d).select("cc_num", "category", "gender", "job", "dob")
    return profile.duplicates(t)


def _described(df: DataFrame) -> DataFrame:
    numbers = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return df.select(*[c for c in df.columns if c not in numbers],
                     *[r(c) for c in numbers if c in df.columns])


@query
def profile_describe_numeric(spark, d):
    t = testbed.txn(spark, d).select("cc_num", "amt", "city_pop", "lat", "merch_long", "is_fraud")
    return _described(profile.describe_numeric(t))


@query
def profile_describe_string(spark, d):
    return profile.describe_text(testbed.txn(spark, d))


@query
def profile_describe_all(spark, d):
    t = testbed.txn(spark, d).select("amt", "category", "city_pop", "job")
    return _described(profile.describe(t))


@query
def profile_describe_typed(spark, d):
    """Every column of the table, whatever its type."""
    t = testbed.txn(spark, d).withColumn("weekend", F.weekday("dob") >= 5)
    return _described(profile.describe(t))


@query
def fingerprint_separators(spark, d):
    """Texts that hold separators and the mark of a gap, cut in two ways."""
    t = testbed.txn(spark, d)
    job = F.when(F.col("row_id") % 5 == 0, "<null>").otherwise(F.col("job"))
    one = t.select(F.concat_ws("|", "category", "gender").alias("a"), job.alias("b"))
    two = t.select(F.col("category").alias("a"), F.concat_ws("|", F.col("gender"), job).alias("b"))
    both = [profile.fingerprint(f).withColumn("cut", F.lit(i)) for i, f in enumerate((one, two))]
    return both[0].unionByName(both[1])


@query
def profile_fingerprint(spark, d):
    t = testbed.txn(spark, d)
    return profile.fingerprint(
        t.select("row_id", "cc_num", "category", "gender", "job", "city_pop", "is_fraud"))


@query
def schema_export(spark, d):
    return exports.schema_export(testbed.txn(spark, d), counts=True)


@query
def sample_head(spark, d):
    t = testbed.txn(spark, d).select("row_id", "cc_num", "category", "amt")
    return exports.sample_head(t, 100, ["amt", "row_id"])


# ------------------------------------------------------------------ validate

@query
def validate_report(spark, d):
    return validate.validation_report(testbed.txn(spark, d), RULES)


@query
def validate_first_failure(spark, d):
    """What a raising check reports: the first breach in rule order."""
    report = validate.validation_report(testbed.txn(spark, d), RULES)
    return report.where("status = 'error'").orderBy("check_order").limit(1)


@query
def validate_violations(spark, d):
    rows = validate.violating_rows(testbed.txn(spark, d), RULES)
    return rows.select("row_id", "violations")


@query
def validate_allowed_nulls(spark, d):
    rule = [{"name": "job", "allowed_values": [f"job_{i}" for i in range(11)]}]
    return validate.validation_report(testbed.txn(spark, d), rule)


@query
def validate_min(spark, d):
    rule = [{"name": "city_pop", "dtype": "int", "min": 500000}]
    return validate.validation_report(testbed.txn(spark, d), rule)


@query
def validate_text(spark, d):
    """Types of unparsed text: values that do not read as declared are counted."""
    i = F.col("row_id")
    t = testbed.txn(spark, d).select(
        F.when(i % 6 == 0, "12.5").when(i % 10 == 0, None)
        .otherwise(F.col("cc_num").cast("string")).alias("cc_num"),
        F.when(i % 9 == 0, "n.a.").otherwise(F.col("amt").cast("string")).alias("amt"),
        "gender")
    rules = [{"name": "cc_num", "dtype": "int", "required": False, "min": 5},
             {"name": "amt", "dtype": "float", "required": True, "min": 1},
             {"name": "gender", "dtype": "str", "required": True}]
    return validate.validation_report(t, rules, text=True)


@query
def validate_text_allowed(spark, d):
    """Allowed numbers, fractions and texts over unparsed text; a gap is a stranger."""
    i = F.col("row_id")
    t = testbed.txn(spark, d).select(
        F.when(i % 10 == 0, None).otherwise(F.col("is_fraud").cast("string")).alias("is_fraud"),
        F.when(i % 4 == 0, "0.5").when(i % 4 == 1, "1.50").otherwise("x").alias("share"),
        "gender")
    rules = [{"name": "is_fraud", "dtype": "int", "allowed_values": [0, 1]},
             {"name": "share", "dtype": "float", "allowed_values": [0.5, 1.5]},
             {"name": "gender", "dtype": "str", "allowed_values": ["F", 7]}]
    return validate.validation_report(t, rules, text=True)


# ---------------------------------------------------------------------- fill

GAPS = ["job", "city_pop"]


@query
def fill_ffill(spark, d):
    t = testbed.txn(spark, d).select("row_id", *GAPS)
    return fill.forward_fill(t, GAPS, order_by="row_id")


@query
def fill_bfill(spark, d):
    t = testbed.txn(spark, d).select("row_id", *GAPS)
    return fill.backward_fill(t, GAPS, order_by="row_id")


@query
def fill_missing(spark, d):
    t = testbed.txn(spark, d).select("row_id", "trans_date_trans_time", *GAPS)
    filled = fill.fill_missing(t, GAPS, order_by=["trans_date_trans_time", "row_id"])
    return filled.drop("trans_date_trans_time")


@query
def fill_missing_by_card(spark, d):
    t = testbed.txn(spark, d).select("row_id", "cc_num", *GAPS)
    return fill.fill_missing(t, GAPS, order_by="row_id", partition_by="cc_num")


@query
def fill_missing_hot_key(spark, d):
    """A third of the rows share one key; it is spread over several ranges."""
    t = testbed.txn(spark, d).select("row_id", "cc_num", *GAPS)
    t = t.withColumn("cc_num", F.when(F.col("row_id") % 3 == 0, 0).otherwise(F.col("cc_num")))
    return fill.fill_missing(t, GAPS, order_by="row_id", partition_by="cc_num")


@query
def validate_and_fill(spark, d):
    t = testbed.txn(spark, d).select("row_id", "cc_num", "amt", *GAPS)
    rules = [{"name": "cc_num", "dtype": "int", "required": True},
             {"name": "amt", "dtype": "float", "required": True, "min": 0},
             {"name": "job", "dtype": "str", "required": False}]
    return stages.validate_and_fill(t, rules, order_by="row_id")


# ---------------------------------------------------------------------- prep

@query
def label_encode(spark, d):
    t = testbed.txn(spark, d).select("row_id", "category", "job", "gender")
    return prep.label_encode(t, ["category", "job", "gender", "not_there"])


@query
def label_encode_wide(spark, d):
    """The way for more values than the driver may hold, here above 20."""
    t = testbed.txn(spark, d).select("row_id", "cc_num", "amt", "city_pop")
    return prep.label_encode(t, ["cc_num", "amt", "city_pop"], local_limit=20)


def _dictionary(spark, d, cols):
    """Codes fitted on two thirds of the rows and saved, and the other rows."""
    t = testbed.txn(spark, d).select("row_id", *cols)
    path = scratch_path(spark, "dictionary")
    dictionary.LabelDictionary.fit(t.where("row_id % 3 <> 0"), cols, path)
    return dictionary.LabelDictionary.load(spark, path), t.where("row_id % 3 = 0")


@query
def label_dictionary(spark, d):
    """A saved dictionary on rows it was not fitted on; values it lacks are -1."""
    saved, rest = _dictionary(spark, d, ["category", "job", "cc_num", "amt"])
    return saved.encode(rest)


@query
def label_dictionary_wide(spark, d):
    """The way for more values than are broadcast, here above 20."""
    saved, rest = _dictionary(spark, d, ["cc_num", "city_pop"])
    return saved.encode(rest, local_limit=20)


@query
def label_dictionary_stream(spark, d):
    """Rows that arrive as a stream, encoded by a saved dictionary."""
    saved, rest = _dictionary(spark, d, ["cc_num", "amt"])
    folder = scratch_path(spark, "arrived")
    rest.write.parquet(folder)
    arriving = spark.readStream.schema(rest.schema).option("maxFilesPerTrigger", 1000).parquet(folder)
    saved.encode(arriving).writeStream.option("checkpointLocation", f"{folder}-checkpoint").trigger(
        availableNow=True).start(f"{folder}-coded", format="parquet").awaitTermination()
    return spark.read.parquet(f"{folder}-coded")


@query
def label_dictionary_decoded(spark, d):
    """Codes back to values: what the dictionary lacks is NULL."""
    saved, rest = _dictionary(spark, d, ["job", "cc_num"])
    return saved.decode(saved.encode(rest))


@query
def impute_mean(spark, d):
    t = prep.impute_mean(testbed.txn(spark, d).select("row_id", "city_pop"), ["city_pop"])
    return t.select("row_id", r("city_pop"))


@query
def scale_standard(spark, d):
    t = testbed.txn(spark, d).select("row_id", "amt", "city_pop", F.lit(3.5).alias("fixed"))
    t = prep.scale(t, ["amt", "city_pop", "fixed"])
    return t.select("row_id", r("amt"), r("city_pop"), r("fixed"))


@query
def scale_minmax(spark, d):
    t = testbed.txn(spark, d).select("row_id", "amt", "city_pop")
    t = prep.scale(t, ["amt", "city_pop"], how="minmax")
    return t.select("row_id", r("amt"), r("city_pop"))


@query
def scale_per_column(spark, d):
    """Numbers scaled as their own settings say, the others as usual."""
    t = testbed.txn(spark, d)
    conf = default_conf(preprocessing={
        "numeric": ["amt", "city_pop", "lat"], "categorical": [],
        "amt": {"normalization": "minmax"}, "city_pop": {"normalization": "none"}})
    model = prep.TabularPrepModel.from_json(prep.TabularPrep.from_conf(conf).fit(t).to_json())
    return _rounded(model.transform(t, ["row_id"]), ["row_id"])


@query
def impute_mode(spark, d):
    return prep.impute_mode(testbed.txn(spark, d).select("row_id", "job"), ["job"])


@query
def impute_mode_wide(spark, d):
    """The most frequent of many values, here texts made from the order number."""
    t = lineitem(spark, d).select(*LINE_ID, F.when(
        F.col("l_linenumber") != 2, F.concat(F.lit("o"), F.col("l_orderkey").cast("string"))).alias("order"))
    return prep.impute_mode(t, ["order"])


@query
def onehot_sparse(spark, d):
    """A place per value for any number of values: where the one of each row is."""
    t = testbed.txn(spark, d).select("row_id", "job", F.col("cc_num").cast("string").alias("card"))
    t = prep.onehot_sparse(t, ["job", "card"])
    for c in ("job", "card"):
        t = t.withColumn(f"{c}_at", F.get(F.unwrap_udt(f"{c}_onehot").getField("indices"), 0).cast("long"))
    return t.select("row_id", "job_at", "card_at")


@query
def onehot(spark, d):
    t = testbed.txn(spark, d)
    return prep.TabularPrep(categorical=["gender", "category"]).fit(t).transform(t, ["row_id"])


def _rounded(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*keep, *[r(c) for c in df.columns if c not in keep])


@query
def prep_all(spark, d):
    t = testbed.txn(spark, d)
    model = prep.TabularPrep.from_conf(PREP_CONF).fit(t)
    return _rounded(model.transform(t, ["row_id"]), ["row_id"])


@query
def prep_train_apply(spark, d):
    """Fitted on the first of three parts, applied to another with a new category."""
    t = testbed.txn(spark, d)
    fit_rows = t.where((F.col("row_id") % 3 == 0) & (F.col("category") != "error"))
    other = t.where(F.col("row_id") % 3 == 1)
    model = prep.TabularPrep(["amt", "city_pop"], ["category"]).fit(fit_rows)
    return _rounded(model.transform(other, ["row_id"]), ["row_id"])


@query
def preprocess_table(spark, d):
    t = features.add_time_features(testbed.txn(spark, d))
    conf = default_conf(preprocessing={
        "numeric": ["amt", "hour", "city_pop", "lat", "category"], "categorical": [],
        "label_encode": ["category", "gender"]})
    table, _ = prep.preprocess(t, conf, keep=["row_id"])
    return _rounded(table, ["row_id", "is_fraud"])


# ------------------------------------------------------------------- columns

@query
def rename_columns(spark, d):
    """Old names to new ones; a name given to itself or not there changes nothing."""
    t = testbed.txn(spark, d).select("row_id", "trans_date_trans_time", "dob", "amt")
    conf = default_conf(preprocessing={"rename_columns": {
        "trans_date_trans_time": "happened", "dob": "dob", "amt": "amount", "absent": "other"}})
    return project.rename_columns(t, conf)


@query
def select_engineered(spark, d):
    t = features.add_time_features(testbed.txn(spark, d)).drop("dob")
    return project.select_engineered(t, default_conf()).select(
        "amt", "city_pop", big("hour"), big("day"), big("month"), big("day_of_week"),
        "category", "gender")


@query
def select_raw(spark, d):
    t = testbed.records(spark, d)
    return project.drop_target(project.select_raw_features(t, default_conf()), "is_fraud")


@query
def attach_target(spark, d):
    t = testbed.txn(spark, d)
    return project.attach_target(
        t.select("row_id", "amt"), t.select("row_id", "is_fraud"), "row_id", "is_fraud")


@query
def response_columns(spark, d):
    t = testbed.txn(spark, d)
    scored = t.withColumns({"prediction": F.col("is_fraud"),
                            "prediction_proba": F.col("is_fraud").cast("double") / 2})
    return project.response(scored)


# --------------------------------------------------------------------- split

@query
def split_two_way(spark, d):
    t = split.assign_split(testbed.txn(spark, d), "is_fraud", "row_id",
                           test_size=0.2, valid_size=0.0)
    return t.select("row_id", "is_fraud", "split")


@query
def split_three_way(spark, d):
    t = split.assign_split(testbed.txn(spark, d), "is_fraud", "row_id",
                           test_size=0.2, valid_size=0.1, seed=7)
    return t.select("row_id", "is_fraud", "split")


@query
def split_many_classes(spark, d):
    t = split.assign_split(testbed.txn(spark, d), "category", "row_id",
                           test_size=0.15, valid_size=0.25)
    return t.select("row_id", "category", "split")


@query
def split_boolean_label(spark, d):
    t = testbed.txn(spark, d).withColumn("fraud", F.col("is_fraud") == 1)
    t = split.assign_split(t, "fraud", "row_id", test_size=0.2, valid_size=0.1)
    return t.select("row_id", "fraud", "split")


@query
def split_double_label(spark, d):
    """Labels whose text differs between engines."""
    t = testbed.txn(spark, d).withColumn("label", F.col("row_id") % 3 * 1e7 + 0.1)
    t = split.assign_split(t, "label", "row_id", test_size=0.2, valid_size=0.1)
    return t.select("row_id", "split")


@query
def split_wide_classes(spark, d):
    """A class per order, each line twice: more classes than are planned on the driver."""
    t = lineitem(spark, d).select(*LINE_ID, F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    t = split.assign_split(t, "l_orderkey", [*LINE_ID, "copy"], test_size=0.3, valid_size=0.0)
    return t.select(*LINE_ID, "copy", "split")


@query
def class_weights(spark, d):
    w = models.class_weights(testbed.txn(spark, d), "is_fraud")
    return w.select("label", "n_rows", r("weight"))


# ------------------------------------------------------------------ evaluate

def _guessed(spark, d) -> DataFrame:
    return testbed.txn(spark, d).withColumn("prediction", (F.col("amt") > 100).cast("int"))


_METRICS = [*evaluate.METRICS]


@query
def eval_confusion(spark, d):
    return evaluate.confusion(_guessed(spark, d), "is_fraud").drop("not_a_class")


@query
def eval_not_a_class(spark, d):
    """Predictions that are no class are counted apart, and refused by the metrics."""
    t = testbed.txn(spark, d).withColumn("prediction", F.when(F.col("row_id") % 9 == 0, 0.3).otherwise(
        (F.col("amt") > 100).cast("double")))
    return evaluate.confusion(t, "is_fraud").select("n", "not_a_class")


@query
def eval_metrics(spark, d):
    m = evaluate.metrics(_guessed(spark, d), "is_fraud")
    return m.select("n", "tn", "fp", "fn", "tp", *[r(c) for c in _METRICS])


@query
def eval_by_split(spark, d):
    t = split.assign_split(_guessed(spark, d), "is_fraud", "row_id",
                           test_size=0.2, valid_size=0.2)
    m = evaluate.metrics(t, "is_fraud", by="split")
    return m.select("split", "n", *[r(c) for c in _METRICS])


@query
def eval_by_category(spark, d):
    """Categories without any fraud have no AUC."""
    m = evaluate.metrics(_guessed(spark, d), "is_fraud", by="category")
    return m.select("category", "n", *[r(c) for c in _METRICS])


@query
def eval_listed_metrics(spark, d):
    """Only the measures that the settings list."""
    m = evaluate.metrics(_guessed(spark, d), "is_fraud", by="category")
    m = evaluate.configured_metrics(m, {"metrics": ["F1 Score", "Recall", "ROC AUC"]})
    return m.select("category", "n", *[r(c) for c in ("f1_score", "recall", "auc_roc")])


@query
def eval_auc_probability(spark, d):
    t = testbed.txn(spark, d).withColumn("p", F.round(F.col("amt") / 600, 3))
    return evaluate.auc_from_probability(t, "is_fraud", "p").select(r("auc_roc_proba", 6))


# --------------------------------------------------------- sources and sinks

@query
def csv_round_trip(spark, d):
    path = scratch_path(spark, "csv")
    t = testbed.records(spark, d).drop("is_fraud")
    t = t.withColumn("job", F.when(F.col("row_id") % 7 != 0, F.concat("job", F.lit(', "q"'))))
    tables.write_table(t, path, "csv")
    rules = [{"name": "row_id", "dtype": "int"}, *RECORD_RULES]
    return tables.read_csv(spark, path, rules)


@query
def stage_round_trip(spark, d):
    """Written as the processed stage, found again through the configuration."""
    path = scratch_path(spark, "processed") + ".parquet"
    tables.write_table(testbed.txn(spark, d).select("row_id", "amt", "job"), path)
    conf = default_conf(data_source={"processed_path": path})
    return tables.read_dataset(spark, conf, "processed")


def _under(lines: DataFrame, *first: str) -> DataFrame:
    """Lines of text with the same beginning in every part that is written."""
    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array(first)], ["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays(batch.columns, ["value"])

    return lines.select("value").mapInArrow(run, "value string")


@query
def csv_heading_line(spark, d):
    """Files whose third line is the heading, after a note with a line break in quotes and a blank line."""
    path = scratch_path(spark, "notes")
    lines = testbed.txn(spark, d).select(F.concat_ws(",", "row_id", F.concat(F.lit('"'), "job", F.lit('"'))).alias("value"))
    _under(lines, "a note", '"one more,', 'in two lines",x', "", "row_id,job").write.text(path)
    return tables.read_csv(spark, path, [{"name": "row_id", "dtype": "int"}], header=2, multi_line=True)


@query
def csv_bad_rows(spark, d):
    """A delimited file in which every seventh record has a field too many."""
    path = scratch_path(spark, "bad")
    i = F.col("row_id")
    lines = testbed.txn(spark, d).select(i, F.concat_ws(
        ",", i, "category", F.when(i % 7 == 0, "extra")).alias("value"))
    _under(lines.select("value"), "row_id,category").write.text(path)
    good = tables.read_csv(spark, path, [{"name": "row_id", "dtype": "int"}], on_bad="skip")
    bad = tables.rejected_rows(spark, path)
    return good.select("row_id", "category", F.lit(None).cast("string").alias("record")).unionByName(
        bad.select(F.lit(None).cast("long").alias("row_id"), F.lit(None).cast("string").alias("category"), "record"))


@query
def csv_line_breaks(spark, d):
    """Texts with line breaks, quotes and blanks at their ends, by the configuration."""
    path = scratch_path(spark, "breaks")
    t = testbed.txn(spark, d).select("row_id", F.concat(F.lit(" "), "category", F.lit('\n"'), "gender", F.lit('" ')).alias("text"))
    tables.write_table(t, path, "csv")
    conf = default_conf(data_source={"raw_path": path, "multi_line": True})
    conf["data_validation"]["schema"]["columns"] = [{"name": "row_id", "dtype": "int"}]
    return tables.read_dataset(spark, conf)


@query
def fingerprint_changes(spark, d):
    """A table whose partitions change: one goes, one is replaced.  Only the parts of these are
    subtracted and added; the result is the fingerprint that the new table's parts give."""
    code = F.concat(F.lit("00"), F.col("cc_num") % 9)
    t = testbed.txn(spark, d).select("row_id", "job", code.alias("code"))
    old = materialize(profile.fingerprint_parts(t, ["code"]), "parts")
    gone = old.where(F.col("code").isin("003", "004"))
    new = profile.fingerprint_parts(t.where("code = '004'").withColumn("job", F.concat("job", F.lit("!"))), ["code"])
    parts = profile.merged_parts(old.unionByName(new), gone)
    return profile.fingerprint_of_parts(parts, len(t.columns))


@query
def scoring_columns(spark, d):
    """The columns that scoring needs: which are there, and how many values they miss."""
    return project.column_report(testbed.txn(spark, d), ["category", "job", "nickname", "amt", "street"])


@query
def versioned_dataset(spark, d):
    """Two versions; the latest is partitioned by a text that looks like a number, or is missing."""
    root = scratch_path(spark, "datasets")
    t = testbed.txn(spark, d).select("row_id", F.concat(F.lit("00"), F.col("cc_num") % 9).alias("code"), "job")
    t = t.withColumn("code", F.when(F.col("row_id") % 6 != 0, F.col("code")))
    datasets.write_dataset(t, root, "raw_data")
    datasets.write_dataset(t.where(F.col("job").isNotNull()), root, "raw_data", ["code"])
    return datasets.read_version(spark, root, "raw_data")


def _csv_conf(spark, d) -> dict:
    """A configuration whose raw table is the records as delimited text."""
    path = scratch_path(spark, "raw")
    tables.write_table(testbed.records(spark, d), path, "csv")
    conf = _small_tree()
    conf["data_source"]["raw_path"] = path
    conf["data_validation"]["schema"]["columns"] = [
        {"name": "row_id", "dtype": "int", "required": True}, *RECORD_RULES,
        {"name": "is_fraud", "dtype": "int", "required": True, "allowed_values": [0, 1]}]
    return conf


@query
def load_and_profile(spark, d):
    """The load step: a delimited file under declared types, described."""
    return _described(stages.load_and_profile(spark, _csv_conf(spark, d))["describe"])


@query
def run_stages(spark, d):
    """Load, validate and train from a delimited file: rows held out per split."""
    result = stages.run(spark, _csv_conf(spark, d), "all", id_col="row_id")
    return result.metrics.select("split", "n")


@query
def run_steps(spark, d):
    """Load, validate, fill, train and score with stored tables in between."""
    got = stages.run_steps(spark, _csv_conf(spark, d), "row_id", "row_id")
    return got["predictions"].select("row_id", "amt", "job",
                                     F.col("prediction").isin(0, 1).alias("has_class"))


def _json_file(spark, d) -> str:
    path = scratch_path(spark, "records")
    testbed.json_lines(spark, d).select("value").write.text(path)
    return path


@query
def json_records(spark, d):
    return records.read_records(spark, _json_file(spark, d))


@query
def json_rejected(spark, d):
    lines = testbed.json_lines(spark, d)
    return records.rejected_records(records.parse_records(lines)).select("row_id", "reason")


# -------------------------------------------------------------------- models

def _conf(kind: str, params: dict, **more) -> dict:
    params = {"random_state": 42, **params}
    return default_conf(
        data_split={"test_size": 0.2, "valid_size": 0.2, "random_state": 42},
        model={"name": kind, "params": params,
               "bayesian_optimization": {"enabled": False}}, **more)


def _small_tree() -> dict:
    return _conf("decision_tree", {"max_depth": 5, "criterion": "entropy",
                                   "class_weight": "balanced", "min_samples_leaf": 1})


def _quality(result: training.TrainResult, again: training.TrainResult | None = None) -> DataFrame:
    """Per held-out split what must hold of any model: rows and frauds, counters that add up,
    metrics that follow from the counters; with a second training, that it repeats."""
    c = {k: F.col(k) for k in ("n", "tn", "fp", "fn", "tp")}

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(0.0)

    p, q = ratio(c["tp"], c["tp"] + c["fp"]), ratio(c["tp"], c["tp"] + c["fn"])
    expected = {"accuracy": (c["tp"] + c["tn"]) / c["n"], "precision": p, "recall": q,
                "f1_score": ratio(2 * p * q, p + q),
                "auc_roc": (q + ratio(c["tn"], c["tn"] + c["fp"])) / 2}
    follows = F.lit(True)
    for k, v in expected.items():
        follows = follows & (F.abs(F.col(k) - v) < 1e-9)
    out = result.metrics
    repeats = F.lit(True)
    if again is not None:
        out = out.join(again.metrics.select("split", F.struct("tn", "fp", "fn", "tp").alias("again")), "split")
        repeats = F.struct("tn", "fp", "fn", "tp") == F.col("again")
    return out.select(
        "split", "n", (c["tp"] + c["fn"]).alias("n_frauds"),
        (c["tn"] + c["fp"] + c["fn"] + c["tp"] == c["n"]).alias("adds_up"),
        follows.alias("follows"), repeats.alias("repeats"))


@query
def train_decision_tree(spark, d):
    t, conf = testbed.records(spark, d), _small_tree()
    return _quality(training.train(t, conf, "row_id"), training.train(t, conf, "row_id"))


@query
def train_random_forest(spark, d):
    """The shipped number of trees."""
    conf = _conf("random_forest", {"n_estimators": 100, "max_depth": 5, "criterion": "entropy",
                                   "class_weight": "balanced", "min_samples_leaf": 2})
    return _quality(training.train(testbed.records(spark, d), conf, "row_id"))


@query
def train_gradient_boosting(spark, d):
    """The shipped parameters."""
    conf = _conf("xgboost", default_conf()["model"]["params"])
    return _quality(training.train(testbed.records(spark, d), conf, "row_id"))


@query
def tune_random_search(spark, d):
    """The shipped number of trials: what the search found is the best of what it tried."""
    t = features.add_features(testbed.records(spark, d))
    parts = split.assign_split(t, "is_fraud", "row_id", test_size=0.2, valid_size=0.2)
    fit_rows = parts.where("split = 'train'")
    model = prep.TabularPrep.from_conf(default_conf()).fit(fit_rows)
    vectors = model.append_vector(parts, "features").select(
        "features", "is_fraud", "split").cache()
    search = {"init_points": 5, "n_iter": 20, "random_state": 42,
              "search_space": {"max_depth": [2, 5], "min_samples_leaf": [1, 5]}}
    found = tune.random_search(
        vectors.where("split = 'train'"), vectors.where("split = 'valid'"), "decision_tree",
        {"class_weight": "balanced", "random_state": 42}, search, label="is_fraud")
    sizes = vectors.where("split = 'valid'").agg(F.count(F.lit(1)).alias("n_valid"), F.sum("is_fraud").alias("n_frauds"))
    best = json.dumps(found.best, sort_keys=True)
    tried = found.trials.agg(
        F.count(F.lit(1)).alias("n_trials"),
        F.bool_and(F.col("recall").between(0, 1)).alias("in_range"),
        (F.max("recall") == F.max_by("recall", F.when(F.col("params") == best, F.lit(1)).otherwise(0))).alias("best_is_highest"))
    rows = [(*sizes.first(), *tried.first())]
    vectors.unpersist()
    return small_table(spark, rows, "n_valid long, n_frauds long, n_trials long, in_range boolean, best_is_highest boolean")


def _by_hour(spark, d) -> DataFrame:
    """Records whose label is a rule that a tree finds exactly: the second half of the day."""
    t = testbed.records(spark, d)
    return t.withColumn("is_fraud", (F.substring("trans_date_trans_time", 12, 2).cast("int") >= 12).cast("int"))


@query
def tune_halving_search(spark, d):
    """The random search's trials in three turns on growing rows, beside the random search itself."""
    t = features.add_features(testbed.records(spark, d))
    parts = split.assign_split(t, "is_fraud", "row_id", test_size=0.2, valid_size=0.2)
    model = prep.TabularPrep.from_conf(default_conf()).fit(parts.where("split = 'train'"))
    vectors = model.append_vector(parts, "features").select("row_id", "features", "is_fraud", "split").cache()
    train, valid = vectors.where("split = 'train'"), vectors.where("split = 'valid'")
    search = {"init_points": 5, "n_iter": 20, "random_state": 42,
              "search_space": {"max_depth": [2, 5], "min_samples_leaf": [1, 5]}}
    base = {"class_weight": "balanced", "random_state": 42}
    halved = tune.halving_search(train, valid, "decision_tree", base, search, label="is_fraud", id_col="row_id")
    blind = tune.random_search(train, valid, "decision_tree", base, search, label="is_fraud")
    turns = halved.trials.agg(
        F.count_if(F.col("rung") == 0).alias("n_first"), F.count_if(F.col("rung") == 1).alias("n_second"),
        F.count_if(F.col("rung") == 2).alias("n_last"), (F.sum("share") * 3 <= 25).alias("third_of_rows"),
        F.max(F.when(F.col("rung") == 2, F.col("recall"))).alias("reached")).first()
    most = blind.trials.agg(F.max("recall")).first()[0]
    n_valid = valid.count()
    vectors.unpersist()
    return small_table(spark, [(n_valid, *turns[:4], turns["reached"] >= most)],
                       "n_valid long, n_first long, n_second long, n_last long, third_of_rows boolean, not_below boolean")


@query
def score_table(spark, d):
    """Scored by a model that was saved and loaded again."""
    t = _by_hour(spark, d)
    conf = _small_tree()
    path = scratch_path(spark, "model")
    training.train(t, conf, "row_id").model.save(spark, path)
    scored = scoring.score(t, conf, artifacts.load_model(spark, path))
    return scored.select("row_id", "amt", "prediction", r("prediction_proba"))


@query
def score_threshold(spark, d):
    """The class follows the configured threshold, whatever the model was fitted with."""
    t = testbed.records(spark, d)
    conf = _small_tree()
    model = training.train(t, conf, "row_id").model
    out = []
    for threshold in (0.05, 0.5, 0.99):
        scored = scoring.score(t, {**conf, "inference": {"threshold": threshold}}, model)
        out.append(scored.agg(
            F.lit(threshold).alias("threshold"), F.count(F.lit(1)).alias("n_rows"),
            F.count_if((F.col("prediction_proba") > threshold) == (F.col("prediction") == 1)).alias("n_consistent")))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def score_properties(spark, d):
    """Scoring keeps every row and its input, gives a class and a probability each,
    and repeats itself after a save: counts that SQL can state."""
    t = testbed.records(spark, d)
    conf = _small_tree()
    path = scratch_path(spark, "model")
    model = training.train(t, conf, "row_id").model
    model.save(spark, path)
    a = scoring.score(t, conf, model)
    b = scoring.score(t, conf, artifacts.load_model(spark, path))
    b = b.select("row_id", F.col("prediction_proba").alias("again"))
    p, q = F.col("prediction_proba"), F.col("prediction")
    return a.join(b, "row_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        r(F.sum("amt"), 2).alias("sum_amt"),
        F.count_if(p.between(0, 1) & (q == (p > 0.5).cast("int"))).alias("n_consistent"),
        F.count_if(p == F.col("again")).alias("n_repeated"),
    )


@query
def score_stream(spark, d):
    """Records scored as a stream and as a table: the same rows, the same results."""
    conf = _small_tree()
    model = training.train(testbed.records(spark, d), conf, "row_id").model
    source, out = _json_file(spark, d), scratch_path(spark, "stream")
    running = streaming.start_scoring(
        spark, source, f"{out}/scored", f"{out}/checkpoint", conf, model,
        rejected=f"{out}/rejected")
    running.awaitTermination()
    streamed = spark.read.parquet(f"{out}/scored").drop("source_file", "batch")
    batch = scoring.score(records.read_records(spark, source), conf, model)
    side = F.lit(1).cast("long")
    both = (
        streamed.withColumn("n", side).unionByName(batch.withColumn("n", -side))
        .groupBy(*batch.columns).agg(F.sum("n").alias("n"))
        .agg(F.sum(F.abs("n")).alias("n_different"))
    )
    counted = streamed.agg(F.count(F.lit(1)).alias("n_scored"))
    refused = spark.read.parquet(f"{out}/rejected").agg(F.count(F.lit(1)).alias("n_rejected"))
    one = [f.withColumn("one", F.lit(1)) for f in (counted, refused, both)]
    return one[0].join(one[1], "one").join(one[2], "one").drop("one")


@query
def score_file(spark, d):
    """A delimited file scored into another; what is read back is whole."""
    t = testbed.records(spark, d)
    conf = _small_tree()
    model = training.train(t, conf, "row_id").model
    source, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    tables.write_table(t.drop("is_fraud"), source, "csv")
    conf["data_validation"]["schema"]["columns"] = [
        {"name": "row_id", "dtype": "int"}, *RECORD_RULES]
    scoring.score_path(spark, source, out, conf, model)
    back = tables.read_csv(spark, out, [
        {"name": "row_id", "dtype": "int"}, *RECORD_RULES,
        {"name": "prediction", "dtype": "int"}, {"name": "prediction_proba", "dtype": "float"}])
    return back.select("row_id", "trans_date_trans_time", "amt", "zip",
                       F.col("prediction").isin(0, 1).alias("has_class"))


@query
def evaluate_saved_model(spark, d):
    conf = _small_tree()
    result = training.train(_by_hour(spark, d), conf, "row_id")
    path = scratch_path(spark, "model")
    result.model.save(spark, path)
    m = training.evaluate_saved(
        result.splits.where("split = 'test'"), artifacts.load_model(spark, path), conf)
    return m.select("n", *[r(c) for c in (*_METRICS, "auc_roc_proba")])


@query
def preprocess_job(spark, d):
    """The stored table of the preprocess step, split included."""
    t = features.add_features(testbed.records(spark, d))
    conf = default_conf(
        preprocessing={"numeric": ["amt", "hour", "city_pop", "lat"], "categorical": [], "label_encode": ["category"]},
        data_split={"test_size": 0.2, "valid_size": 0.2, "random_state": 42})
    got = stages.preprocess(t, conf, "row_id")["data"]
    return _rounded(got, ["row_id", "is_fraud", "split"])


# ------------------------------------------------- the larger table, for scale

@query
def lineitem_describe(spark, d):
    t = lineitem(spark, d).select("l_quantity", "l_extendedprice", "l_discount", "l_returnflag")
    return _described(profile.describe(t))


@query
def lineitem_quartiles_narrowed(spark, d):
    """Quartiles of a column with too many values to sort in a task (here above 1000)."""
    t = lineitem(spark, d).select(F.col("l_extendedprice").alias("c0"))
    n = t.count()
    q = profile.percentiles(t, profile.QUARTILES, {"c0": n}, fetched=1000)["c0"]
    return small_table(spark, [(n, *q)], "n long, p25 double, p50 double, p75 double").select(
        "n", r("p25"), r("p50"), r("p75"))


@query
def lineitem_quartiles_counted(spark, d):
    """Quartiles of columns with few distinct values, found by counting."""
    t = lineitem(spark, d).select(F.col("l_quantity").alias("c0"), F.col("l_tax").alias("c1"))
    n = t.count()
    q = profile.percentiles(t, profile.QUARTILES, {"c0": n, "c1": n}, fetched=1000)
    return small_table(spark, [("l_quantity", *q["c0"]), ("l_tax", *q["c1"])],
                       "column string, p25 double, p50 double, p75 double").select(
        "column", r("p25"), r("p50"), r("p75"))


@query
def lineitem_duplicates(spark, d):
    return profile.duplicates(lineitem(spark, d).select("l_orderkey", "l_linenumber"))


@query
def lineitem_fingerprint(spark, d):
    t = lineitem(spark, d).select(*LINE_ID, "l_returnflag", "l_linestatus")
    return profile.fingerprint(t)


@query
def lineitem_scale(spark, d):
    t = lineitem(spark, d).select(*LINE_ID, "l_quantity", "l_extendedprice")
    t = prep.scale(t, ["l_quantity", "l_extendedprice"])
    return t.select(*LINE_ID, r("l_quantity"), r("l_extendedprice"))


@query
def lineitem_split(spark, d):
    t = split.assign_split(lineitem(spark, d), "l_returnflag", LINE_ID,
                           test_size=0.2, valid_size=0.2)
    return t.select(*LINE_ID, "l_returnflag", "split")


def entry(spark: SparkSession) -> DataFrame:
    """All engineered features of the small transaction table."""
    return feat_all(spark, "/root/testdata/sf0.001")


def _training_data() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the subpackage ``llm`` and its pipeline, where they are installed."""
    try:
        import corpus_pipeline
        from ledgerspark.llm import queries as llm
    except ModuleNotFoundError as e:
        if e.name in ("corpus_pipeline", "ledgerspark.llm", "ledgerspark.llm.queries"):
            return {}, {}
        raise
    sql = {**llm.ORACLES, "pipeline": corpus_pipeline.ORACLE_SQL}
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, {k: v for k, v in sql.items() if v}


def queries() -> dict[str, Query]:
    return {**_QUERIES, **_training_data()[0]}


def oracle_sql() -> dict[str, str]:
    return {**oracles.oracle_sql(), **_training_data()[1]}
