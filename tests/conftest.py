from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from farelake.schemas import RAW_TRIPS  # noqa: E402
from farelake.session import build_session  # noqa: E402
from farelake.sources import lookups  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("wh")),
        # Plans are compared as text, so they must not be shortened.
        "spark.sql.maxMetadataStringLength": "100000",
        "spark.sql.debug.maxToStringFields": "1000",
    }
    session = build_session("farelake-tests", "local[4]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# A trip that passes every rule; a test changes what it is about.
PLAIN = {
    "vendor_id": "1",
    "pickup_datetime": dt.datetime(2022, 1, 3, 12, 0),
    "dropoff_datetime": dt.datetime(2022, 1, 3, 12, 20),
    "passenger_count": 1,
    "trip_distance": 5.0,
    "pickup_location_id": 10,
    "dropoff_location_id": 20,
    "rate_code": "1",
    "store_and_fwd_flag": "N",
    "payment_type": "1",
    "fare_amount": 10.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "imp_surcharge": 0.3,
    "total_amount": 13.3,
    "_synced": dt.datetime(2022, 4, 1),
    "_deleted": False,
}


@pytest.fixture(scope="session")
def raw(spark):
    """Builds landing rows from changes to the plain trip."""

    def build(*changes: dict):
        rows = [tuple({**PLAIN, **change}[name] for name in RAW_TRIPS.names) for change in changes]
        return lookups.from_rows(spark, RAW_TRIPS, rows)

    return build


@pytest.fixture(scope="session")
def small_tables():
    return SMALL


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
