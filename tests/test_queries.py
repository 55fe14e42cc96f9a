"""Every registered query of the panel engine against its SQL, as sorted rows."""

import datetime
import decimal
import glob
import math
import os

import duckdb
import pytest

from panelwright.plans import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(x):
    """A value that compares alike from either engine; doubles to nine significant digits."""
    if isinstance(x, float):
        return "nan" if math.isnan(x) else 0.0 if x == 0 else float(f"{x:.9g}")
    if isinstance(x, decimal.Decimal):
        return plain(float(x))
    if isinstance(x, int) and not isinstance(x, bool):
        return plain(float(x))
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(row[i]) for i in order) for row in values), key=repr)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_what_its_sql_gives(spark, con, name):
    got, want = QUERIES[name](spark, SF_DIR), con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, got.collect()) == rows(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    assert got.count() > 0 and len(set(got.columns)) == len(got.columns)
