"""Every catalogued query against its SQL oracle on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from weblathe.plans import catalog, oracle

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(oracle.SQL)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    result = duck.sql(oracle.SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(result.columns)
    own = sorted(map(repr, map(tuple, df.select(*columns).collect())))
    theirs = sorted(map(repr, result.project(", ".join(f'"{c}"' for c in columns)).fetchall()))
    assert own == theirs


def test_entry(spark):
    table = catalog.top_table(spark, DATA)
    assert table.columns[0] == "Date" and table.count() > 0
