"""Every registered query against its DuckDB oracle (the driver's correctness gate)."""

import pytest

import __spark_entry__ as entry
from pulsegrid.plans import catalog, model_queries
from scripts.check_oracles import compare
from tests.conftest import SF001, SF01

# The training-data queries have tests of their own.
OWN = {*catalog.QUERIES, *model_queries.QUERIES}
FAST = [k for k in entry.oracle_sql() if k in OWN and not k.startswith(("m1_", "m3_"))]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle_sf0001(spark, name):
    res = compare(spark, SF001, {name}, verbose=False)
    assert res[name][0] == "OK", res[name]


@pytest.mark.parametrize("name", ["m1_lr_score_equations", "m3_svc_separable_counts"])
def test_model_checks_sf001(spark, name):
    res = compare(spark, SF01, {name}, verbose=False)
    assert res[name][0] == "OK", res[name]


def test_every_query_has_rows_and_stable_schema(spark):
    qs = entry.queries()
    assert set(entry.oracle_sql()) <= set(qs)
    df = entry.entry(spark)
    assert df.columns[:2] == ["model", "split"]
    assert df.count() == 6


ROWS_ONLY = sorted(OWN - set(entry.oracle_sql()))


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    df = entry.queries()[name](spark, SF001)
    rows = df.collect()
    assert len(rows) > 0
    assert len(set(df.columns)) == len(df.columns)
