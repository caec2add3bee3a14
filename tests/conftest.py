import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerspark.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def toy(spark):
    """Ten transactions in two classes, as text where a file would have text."""
    rows = [
        (f"{3 + i % 2}/1{i % 9}/2020 7:3{i % 10}", "fuel" if i % 2 == 0 else "books", 40 + 3 * i,
         "M" if i < 5 else "F", "Ghent", "VL", "Tailor", 9000, 2600,
         51.05, 3.72, 51.2, 3.2, "6/15/1975", i % 2, i)
        for i in range(10)
    ]
    return spark.createDataFrame(
        rows,
        "trans_date_trans_time string, category string, amt long, gender string, city string, "
        "state string, job string, zip long, city_pop long, lat double, long double, "
        "merch_lat double, merch_long double, dob string, is_fraud int, id long")
