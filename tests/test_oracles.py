"""Every query against its SQL twin, values and types, at two scales."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as driver
from stratawell.checks.oracles import ORACLES
from stratawell.checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# The SQL type a Spark type must come out as.
SQL_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def _cell(value):
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_cell(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((value is None, str(value)) for value in row),
    )


@pytest.fixture(scope="module")
def connections():
    opened = {}
    for sf in ("sf0.001", "sf0.01"):
        con = duckdb.connect()
        for table in TABLES:
            con.execute(
                f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/{sf}/{table}.parquet'"
            )
        opened[sf] = con
    return opened


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= driver.queries().items()
    assert ORACLES.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connections, name, sf):
    got = QUERIES[name](spark, f"/root/testdata/{sf}")
    want = connections[sf].execute(ORACLES[name])
    want_types = {d[0]: str(d[1]) for d in want.description}
    want_names = [d[0] for d in want.description]
    assert {c: SQL_TYPE[t] for c, t in got.dtypes} == want_types
    assert _rows(got.columns, got.collect()) == _rows(want_names, want.fetchall())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
