"""Every checked query against its DuckDB equivalent."""

import datetime as dt

import pytest

import __spark_entry__ as contract
from checks import catalog
from tests.conftest import SF


def normal(row, order):
    out = []
    for i in order:
        value = row[i]
        if isinstance(value, dt.datetime) and value.time() == dt.time():
            value = value.date()
        out.append(value)
    return out


def ordered(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((normal(r, order) for r in data), key=lambda r: [(v is not None, str(v)) for v in r])


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(contract.queries())
    assert set(catalog.QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, SF)
    expected = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(got.columns) == sorted(columns)
    assert ordered(got.columns, got.collect()) == ordered(columns, expected.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 10
