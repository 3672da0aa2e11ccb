import os

import duckdb
import pytest

from stratapoint.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(frame):
    frame = frame[sorted(frame.columns)]
    text = lambda v: f"{v:.9g}" if isinstance(v, float) and v == v else "null" if v is None or v != v else str(v)
    return sorted(tuple(map(text, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got, want = queries.queries()[name](spark, SF).toPandas(), con.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_ten_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))
