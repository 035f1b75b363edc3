"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as driver
from oracle import compare, connect

# The training-data operators have their own tests.
from yieldline.catalog import ORACLES, QUERIES  # noqa: E402

# SURVEY ids that give rows.
IDS = (
    [f"s{i}" for i in range(1, 19)]
    + [f"c{i}" for i in range(1, 7)]
    + [f"p{i}" for i in range(1, 7)]
    + [f"j{i}" for i in range(1, 8)]
    + [f"a{i}" for i in range(1, 14)]
    + ["w1", "w2", "w3", "o1", "m1"]
    + [f"f{i}" for i in range(1, 8)]
    + [f"k{i}" for i in range(1, 12)]
    + [f"t{i}" for i in range(1, 7)]
)


def test_every_inventory_row_has_a_checked_query():
    covered = {name.split("_")[0] for name in QUERIES}
    assert not set(IDS) - covered
    assert set(ORACLES) == set(QUERIES)


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, folder, duck, name):
    rows, differences = compare(QUERIES[name](spark, folder), duck, ORACLES[name])
    assert not differences
    assert rows > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0
