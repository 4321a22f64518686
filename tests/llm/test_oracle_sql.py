"""The training-data queries that SQL can state, against DuckDB on whole small tables."""

import duckdb
import pytest

from pulsegrid.llm import secrets
from pulsegrid.llm.oracles import ORACLES
from pulsegrid.llm.queries import QUERIES
from scripts.check_oracles import compare
from tests.conftest import SF001


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    assert name in QUERIES
    res = compare(spark, SF001, {name}, verbose=False)
    assert res[name][0] == "OK", res[name]


def test_secret_sql_on_edge_cases(spark, edge):
    con = duckdb.connect()
    con.register("documents", edge.select("doc_id", "text").toPandas())
    key = lambda r: tuple((x is not None, x) for x in r)
    want = sorted(con.sql(ORACLES["op1_secret_scan"]).fetchall(), key=key)
    got = sorted((tuple(r) for r in secrets.scan_documents(edge).collect()), key=key)
    assert [r[1:] for r in got] == [r[1:] for r in want]
