"""Every query with SQL beside it, on the smallest tables."""

import os

import duckdb
import pytest

from stratapoint import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    text = lambda v: f"{v:.6g}" if isinstance(v, float) and v == v else "null" if v is None or v != v else str(v)
    return sorted(tuple(map(text, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_matches_sql(spark, duck, name):
    got = catalogue.queries()[name](spark, SF).toPandas()
    want = duck.execute(catalogue.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_others_run(spark, name):
    got = catalogue.queries()[name](spark, SF)
    assert got.count() >= 0
    assert len(set(got.columns)) == len(got.columns)
