import duckdb
import pytest

import __spark_entry__ as entry
import check_oracles

# Two hundred trees take a minute here; the comparison script runs them, and the model
# tests fit the same learner with fewer.
SLOW = {"train_gradient_boosting"}


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in check_oracles.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW))
def test_query_equals_sql(spark, con, sf_dir, name):
    verdict, _ = check_oracles.compare(
        spark, con, name, sf_dir, entry.queries()[name], entry.oracle_sql().get(name))
    assert not verdict.startswith("FAIL"), verdict


def test_entry(spark):
    assert entry.entry(spark).count() == 1000


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
