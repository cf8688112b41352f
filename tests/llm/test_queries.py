"""The registered queries that have SQL, against DuckDB on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from sensorframe.llm import queries
from tests.test_oracle import rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/documents.parquet"), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.queries()[name](spark, SF).toPandas(), duck.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_the_query_of_tool_calls_has_references_ahead(spark):
    out = queries.queries()["op10_tool_call_linking"](spark, SF).toPandas()
    calls = out[out.kind == "call"]
    assert ((calls.ready_turn > calls.turn) & (calls.wait == 1)).sum() > 5 and calls.level.max() >= 2
