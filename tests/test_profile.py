import functools
import hashlib
import operator
import random

import pytest
from pyspark.sql import functions as F

from ledgerspark import oracles
from ledgerspark.operators import profile
from ledgerspark.sources.scratch import materialize


def test_shape_and_empty(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert tuple(profile.shape(df).first()) == (1, 2, "x,y", False)
    assert profile.shape(df.where("x > 1")).first().is_empty


def test_duplicates_count_later_copies(spark):
    rows = [(1, "a", 0.0), (1, "a", -0.0), (1, None, 0.0), (1, None, 0.0), (2, "a", None),
            (2, "a", float("nan")), (1, "1:a", 0.0)]
    got = profile.duplicates(spark.createDataFrame(rows, "x int, y string, z double")).first()
    assert tuple(got) == (7, 3)


def test_duplicates_of_nothing(spark):
    assert tuple(profile.duplicates(spark.createDataFrame([], "x int")).first()) == (0, 0)


def test_adjacent_fields_do_not_mix(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("a|b", None), (None, "a|b")],
                               "x string, y string")
    assert profile.duplicates(df).first().n_duplicates == 0


def test_describe(spark):
    df = spark.createDataFrame(
        [(1.0, "b"), (2.0, "a"), (4.0, "b"), (None, "a"), (float("nan"), None)],
        "n double, s string")
    n, s = profile.describe(df).collect()
    assert (n.column, n.n, n["min"], n["max"], n.p50) == ("n", 3, 1.0, 4.0, 2.0)
    assert n.p25 == pytest.approx(1.5) and n.p75 == pytest.approx(3.0)
    assert n["mean"] == pytest.approx(7 / 3) and n["std"] == pytest.approx(1.5275252)
    assert (s.n, s.n_unique, s.top, s.freq) == (4, 2, "a", 2)  # the tie goes to the smaller


def test_describe_without_values(spark):
    df = spark.createDataFrame([(None, None)], "n double, s string")
    n, s = profile.describe(df).collect()
    assert (n.n, n.p50, s.n, s.n_unique, s.top) == (0, None, 0, 0, None)


def test_approximate_description(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    row = profile.describe(df, exact=False).first()
    assert row.p50 == pytest.approx(500, abs=2)


@pytest.mark.parametrize("shape", ["uniform", "ties", "two values", "heavy tail", "constant"])
def test_narrowed_percentiles_are_exact(spark, shape):
    dice = random.Random(5)
    draw = {
        "uniform": lambda i: dice.uniform(-5, 5),
        "ties": lambda i: float(dice.choice([0, 0, 0, 0, 1, 2, dice.random()])),
        "two values": lambda i: float(i % 3 == 0),
        "heavy tail": lambda i: dice.random() ** -6,
        "constant": lambda i: 2.5,
    }[shape]
    values = [draw(i) for i in range(3001)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(7)
    probs = (0.0, 0.1, 0.25, 0.3333, 0.5, 0.75, 0.999, 1.0)
    expected = df.agg(F.percentile("x", list(probs))).first()[0]
    for entries, fetched in ((200, 20), (1000, 20), (200, 5000)):
        got = profile.percentiles(df, probs, {"x": 3001}, fetched=fetched, entries=entries)["x"]
        assert got == pytest.approx(expected, rel=1e-12)


def test_description_takes_few_passes(spark, monkeypatch):
    """One pass for moments and sketch, one that counts, one that stores, for all columns at once."""
    df = spark.range(0, 4000, 1, 5).selectExpr(
        "cast(id as double) AS a", "pmod(xxhash64(id), 100003) / 7 AS b", "if(id % 3 = 0, 1.5D, cast(id % 50 as double)) AS c")
    stored = []
    monkeypatch.setattr(profile, "materialize", lambda t, name: stored.append(name) or materialize(t, name))
    monkeypatch.setattr(profile.percentiles, "__kwdefaults__", {**profile.percentiles.__kwdefaults__, "fetched": 500})
    rows = {r["column"]: r for r in profile.describe(df).collect()}
    assert stored == ["stats", "bracket"]
    for c in df.columns:
        want = df.agg(F.percentile(c, [0.25, 0.5, 0.75]), F.avg(c), F.stddev(c), F.min(c), F.max(c)).first()
        got = rows[c]
        assert [got.p25, got.p50, got.p75] == pytest.approx(want[0], rel=1e-12)
        assert [got["mean"], got["std"], got["min"], got["max"]] == pytest.approx(list(want[1:]), rel=1e-12)


def test_fingerprint_ignores_order_only(spark):
    df = spark.createDataFrame([(i, f"v{i % 3}", i / 7) for i in range(50)],
                               "a int, b string, c double")
    one = profile.fingerprint(df).first().fingerprint
    assert profile.fingerprint(df.orderBy(F.desc("a")).repartition(5)).first().fingerprint == one
    changed = df.withColumn("b", F.when(F.col("a") == 7, "other").otherwise(F.col("b")))
    assert profile.fingerprint(changed).first().fingerprint != one
    assert profile.fingerprint(df.where("a < 49")).first().fingerprint != one
    assert profile.fingerprint(df.union(df)).first().fingerprint != one


def test_profile_has_every_part(spark):
    got = profile.profile(spark.createDataFrame([(1, "x")], "a int, b string"))
    assert set(got) == {"shape", "duplicates", "describe", "fingerprint"}


def test_fingerprint_tells_separators_apart(spark):
    a = spark.createDataFrame([("a|b", "c"), (None, "q")], "x string, y string")
    b = spark.createDataFrame([("a", "b|c"), ("<null>", "q")], "x string, y string")
    assert profile.fingerprint(a).first() != profile.fingerprint(b).first()
    assert profile.fingerprint(a).first() == profile.fingerprint(a.orderBy("y")).first()


def test_fingerprint_takes_in_the_whole_digest(spark):
    """Sums and exclusive-ors of all 64 hex digits of every row's digest."""
    rows = [(i, None if i % 4 == 0 else f"v{i}") for i in range(3000)]
    got = profile.fingerprint(spark.createDataFrame(rows, "a int, b string")).first()

    def digest(a, b):
        text = f"{len(str(a))}:{a}" + ("-" if b is None else f"{len(b)}:{b}")
        return hashlib.sha256(text.encode()).hexdigest()

    words = [[int(d[at:at + 13], 16) for d in (digest(*r) for r in rows)] for at in range(0, 64, 13)]
    parts = [str(x) for w in words for x in (sum(w), functools.reduce(operator.xor, w))]
    assert len(words) == 5 and got.n_rows == 3000
    assert got.fingerprint == hashlib.sha256("|".join(["2", "3000", *parts]).encode()).hexdigest()


@pytest.mark.parametrize("name", ["fingerprint_separators", "profile_fingerprint", "lineitem_fingerprint"])
def test_fingerprint_sql_takes_in_the_whole_digest(name):
    sql = oracles.oracle_sql()[name]
    assert all(f"substr(d, {1 + 13 * i}, 13)" in sql and f"bit_xor(w{i})" in sql for i in range(5))


def test_every_kind_of_column_is_described(spark):
    t = spark.sql("SELECT true AS b, date'1970-01-03' AS d, timestamp_ntz'1970-01-01 00:00:05' AS t, array(1) AS a, X'00' AS x, 1.5 AS n")
    rows = {r["column"]: r for r in profile.describe(t).collect()}
    assert list(rows) == t.columns
    assert (rows["b"].top, rows["d"].mean, rows["t"].max, rows["a"].n, rows["x"].freq, rows["n"].p50) == ("true", 172800.0, 5.0, 1, 1, 1.5)
