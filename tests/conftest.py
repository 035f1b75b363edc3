import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from yieldline import schemas  # noqa: E402
from yieldline.session import build_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return DATA


@pytest.fixture(scope="session")
def ideal(spark):
    return schemas.ideal_cycle_times(spark)


@pytest.fixture(scope="session")
def make_bookings(spark):
    """Bookings out of tuples with text timestamps and decimals."""
    import datetime as dt
    from decimal import Decimal

    def make(rows):
        typed = [
            (*r[:4], dt.datetime.fromisoformat(r[4]) if r[4] else None, r[5], Decimal(r[6]), r[7]) for r in rows
        ]
        return spark.createDataFrame(typed, schemas.STATION_RECORDS)

    return make
