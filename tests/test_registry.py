"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from checks.compare import TABLES, compare
from checks.oracles import ORACLES
from checks.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)
    assert set(REGISTRY) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_entry(spark):
    assert E.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    result, _, _, _ = compare(spark, con, name, REGISTRY[name], ORACLES[name], SF)
    assert result == "ok"
