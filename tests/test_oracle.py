"""Every registered query of the library against DuckDB on the same tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from sensorframe.plans import registered

QUERIES, ORACLE = registered()
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
#: Dates that these ask for need more days than the smallest tables may have.
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/events.parquet"), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return round(float(value), 5)
    return str(value)


def rows_of(frame):
    frame = frame.reindex(sorted(frame.columns), axis=1).astype(object)
    return sorted(([None if str(x) in ("<NA>", "NaT", "nan", "None") else plain(x) for x in r] for r in frame.itertuples(index=False, name=None)), key=str)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
