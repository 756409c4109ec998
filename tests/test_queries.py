"""Every registered query with SQL gives the SQL's rows on the smallest data."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
SQL = __spark_entry__.oracle_sql()


def _rows(df) -> list[tuple]:
    columns = sorted(df.columns)
    text = lambda v: "" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)
    return columns, sorted(tuple(text(v) for v in row) for row in df[columns].itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert _rows(__spark_entry__.queries()[name](spark, SF).toPandas()) == _rows(con.execute(SQL[name]).df())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 200
