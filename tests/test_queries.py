"""Every registered query on the small tables, against its SQL twin where it has one."""

import duckdb
import pytest

import __spark_entry__ as driver
from tests.oracle_check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
TWINS = driver.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(driver.queries())


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.columns == ["label_id", "label_name", "precision", "recall", "f1", "support", "performance"]
    assert frame.count() == 10


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, connection, name):
    frame = driver.queries()[name](spark, FOLDER)
    if name in TWINS:
        result = compare(frame, connection, TWINS[name])
        assert result.startswith("ok"), result
    else:
        assert frame.count() > 0
