"""Every registered query of the library against its DuckDB SQL."""

import decimal
import datetime as dt

import duckdb
import pytest

from gazette.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for name in TABLES:
        c.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return c


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v.isoformat() if isinstance(v, dt.date) else v


def rows(found, columns):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in at) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_as_sql(spark, duck, name):
    out = catalogue.QUERIES[name](spark, SF)
    expected = duck.sql(catalogue.ORACLES[name])
    assert sorted(out.columns) == sorted(expected.columns)
    own, other = rows(out.collect(), out.columns), rows(expected.fetchall(), expected.columns)
    assert len(own) == len(other)
    assert own == other
    assert other or name in ("visible_items", "token_missed", "code_candidates")
